"""Disease-risk expressions.

The rule table has twelve fixed rows, so scoring a row against all of them is
written as one expression: no join, no shuffle, inside whole-stage codegen.
``rule_table`` gives the same rules as rows for the join form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldlake import constants as K


def rule_table(spark: SparkSession) -> DataFrame:
    """The twelve rules as rows: fixed size, so safe to broadcast."""
    rows = [(i, *rule) for i, rule in enumerate(K.DISEASE_RULES)]
    return spark.createDataFrame(
        rows,
        "ordinal int, disease string, temp_lo double, temp_hi double, hum_lo double, hum_hi double, "
        "rain_trigger double, moist_lo double, moist_hi double, progression string",
    )


def crop_matches(disease: Column, crop: Column) -> Column:
    return F.contains(F.lower(disease), F.lower(crop))


def risk_score(temperature, humidity, rainfall, moisture, temp_lo, temp_hi, hum_lo, hum_hi,
               rain_trigger, moist_lo, moist_hi) -> Column:
    """0.3 + 0.3 + 0.2 + 0.2, added in this order; bounds are inclusive."""
    moisture = F.coalesce(moisture, F.lit(K.DEFAULT_SOIL_MOISTURE))
    return (
        F.when(temperature.between(temp_lo, temp_hi), K.WEIGHT_TEMPERATURE).otherwise(0.0)
        + F.when(humidity.between(hum_lo, hum_hi), K.WEIGHT_HUMIDITY).otherwise(0.0)
        + F.when(rainfall >= rain_trigger, K.WEIGHT_RAINFALL).otherwise(0.0)
        + F.when(moisture.between(moist_lo, moist_hi), K.WEIGHT_MOISTURE).otherwise(0.0)
    )


def best_rule(crop: str = "crop_type", temperature: str = "temperature", humidity: str = "humidity",
              rainfall: str = "rainfall", moisture: str = "soil_moisture",
              threshold: float = K.RISK_THRESHOLD) -> Column:
    """Struct (risk, rank, disease, progression) of the winning rule, or null.

    A rule takes part when the crop occurs in its name and its score is over
    the threshold. ``greatest`` orders by risk, then by the negated table
    position, so the earlier rule wins a tie; it skips nulls. Written as SQL
    text: one parse instead of some thousand calls into the JVM.
    """
    def add(weight: float, condition: str) -> str:
        return f"IF({condition}, {weight}D, 0D)"

    candidates = []
    for ordinal, (disease, t0, t1, h0, h1, rain, m0, m1, progression) in enumerate(K.DISEASE_RULES):
        score = " + ".join([
            add(K.WEIGHT_TEMPERATURE, f"{temperature} BETWEEN {t0}D AND {t1}D"),
            add(K.WEIGHT_HUMIDITY, f"{humidity} BETWEEN {h0}D AND {h1}D"),
            add(K.WEIGHT_RAINFALL, f"{rainfall} >= {rain}D"),
            add(K.WEIGHT_MOISTURE, f"coalesce({moisture}, {K.DEFAULT_SOIL_MOISTURE}D) BETWEEN {m0}D AND {m1}D"),
        ])
        candidates.append(
            f"CASE WHEN contains('{disease.lower()}', lower({crop})) AND {score} > {threshold}D THEN named_struct("
            f"'risk', {score}, 'rank', {-ordinal}, 'disease', '{disease}', 'progression', '{progression}') END")
    return F.expr(f"greatest({', '.join(candidates)})")


def severity(base: Column, days: Column, progression: Column) -> Column:
    """Severity after whole days, at most 1; an unknown progression stays at base."""
    grown = base
    for name, factor in K.GROWTH_FACTOR.items():
        grown = F.when(progression == name, F.least(F.lit(1.0), base * F.pow(F.lit(factor), days))).otherwise(grown)
    for name, step in K.GROWTH_STEP.items():
        grown = F.when(progression == name, F.least(F.lit(1.0), base + F.lit(step) * days)).otherwise(grown)
    return grown


def whole_days(start: Column, end: Column) -> Column:
    """Whole days between two timestamps, rounded down."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    return F.floor(micros / F.lit(86_400_000_000)).cast("int")
