"""Hand-worked edges of the column functions."""

import itertools
import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldlake import constants as K
from fieldlake.functions import labels as LB, risk as R, weather as W


def column(df, expr):
    return [row[0] for row in df.select(expr).collect()]


def test_zone_bounds(spark):
    cases = [(0.0, "tropical"), (23.5, "tropical"), (-23.5, "tropical"), (23.51, "subtropical"), (35.0, "subtropical"),
             (-35.01, "temperate"), (55.0, "temperate"), (55.01, "continental"), (-60.0, "continental"),
             (60.01, "polar"), (90.0, "polar"), (-90.0, "polar"), (None, None)]
    df = spark.createDataFrame(cases, "lat double, zone string").coalesce(1)
    assert column(df, W.climate_zone(F.col("lat"))) == [c[1] for c in cases]


def test_season_bands(spark):
    north = {1: "winter", 79: "winter", 80: "spring", 171: "spring", 172: "summer", 263: "summer", 264: "fall",
             354: "fall", 355: "winter", 366: "winter"}
    mirror = {"winter": "summer", "spring": "fall", "summer": "winter", "fall": "spring"}
    cases = [(d, lat, s if lat >= 0 else mirror[s]) for d, s in north.items() for lat in (10.0, 0.0, -10.0)]
    df = spark.createDataFrame(cases, "d int, lat double, s string").coalesce(1)
    assert column(df, W.season(F.col("d"), F.col("lat"))) == [c[2] for c in cases]


WEIGHTS = (0.3, 0.3, 0.2, 0.2)


def brute_force(crop, *observed):
    """The best (disease, score) by plain search; ``sorted`` is stable, so table order breaks ties."""
    scores = []
    for name, t0, t1, h0, h1, wet, m0, m1, _ in K.DISEASE_RULES:
        bounds = ((t0, t1), (h0, h1), (wet, math.inf), (m0, m1))
        filled = [50 if v is None else v for v in observed]
        total = 0.0
        for weight, value, (low, high) in zip(WEIGHTS, filled, bounds):
            total += weight * (low <= value <= high)
        if crop.lower() in name.lower() and total > 0.6:
            scores.append((name, total))
    return sorted(scores, key=lambda s: -s[1])[0] if scores else None


def test_best_rule_on_all_bounds(spark):
    """Every crop with temperatures, humidities, rain and moistures on and off the bounds."""
    cases = list(itertools.product(
        ["tomato", "Potato", "pepper", "mixed"], [14.9, 15.0, 20.0, 22.0, 25.0, 30.0, 32.1], [29.0, 30.0, 70.0, 85.0, 100.0],
        [0.0, 1.9, 2.0, 5.0, 10.0], [None, 30.0, 50.0, 70.0, 90.1]))
    df = spark.createDataFrame(cases, "crop string, t double, h double, r double, m double").coalesce(1)
    best = R.best_rule("crop", "t", "h", "r", "m")
    got = column(df, best)
    for case, row in zip(cases, got):
        wanted = brute_force(*case)
        assert (row and (row["disease"], row["risk"])) == wanted, case


def test_two_weak_matches_do_not_fire(spark):
    df = spark.range(1).select(F.lit("pepper").alias("c"), F.lit(27.0).alias("t"), F.lit(90.0).alias("h"),
                               F.lit(0.0).alias("r"), F.lit(10.0).alias("m"))
    assert column(df, R.best_rule(*"cthrm")) == [None]


def test_tie_goes_to_the_first_rule(spark):
    both = R.best_rule("'potato'", "21D", "90D", "12D", "75D")
    assert column(spark.range(1), both)[0]["disease"] == "Potato___Early_blight"


@pytest.mark.parametrize("kind,grow", [
    ("exponential", lambda b, d: b * 1.1 ** d), ("fast_exponential", lambda b, d: b * 1.2 ** d),
    ("linear", lambda b, d: b + 0.05 * d), ("slow", lambda b, d: b + 0.02 * d), ("other", lambda b, d: b)])
def test_severity(spark, kind, grow):
    df = spark.createDataFrame([(d,) for d in (0, 1, 5, 30)], "d int").coalesce(1)
    got = column(df, R.severity(F.lit(0.7), F.col("d"), F.lit(kind)))
    assert got == pytest.approx([min(1.0, grow(0.7, d)) for d in (0, 1, 5, 30)])
    assert got == sorted(got) and max(got) <= 1


def test_whole_days_round_down(spark):
    start = datetime(2024, 1, 1, 12)
    ends = [datetime(2024, 1, 1, 12), datetime(2024, 1, 3, 11, 59, 59), datetime(2024, 1, 3, 12),
            datetime(2024, 1, 3, 11, 59, 59, 999999)]
    df = spark.createDataFrame([(start, e) for e in ends], "a timestamp, b timestamp").coalesce(1)
    assert column(df, R.whole_days(F.col("a"), F.col("b"))) == [0, 1, 2, 1]


LABELS = [
    ("Pepper__bell___Bacterial_spot", "Pepper", "bell__Bacterial_spot", "diseased"),
    ("Pepper__bell___healthy", "Pepper", "None", "healthy"),
    ("Potato___Early_blight", "Potato", "_Early_blight", "diseased"),
    ("Potato___Late_blight", "Potato", "_Late_blight", "diseased"),
    ("Potato___healthy", "Potato", "None", "healthy"),
    ("Tomato_Bacterial_spot", "Tomato", "Bacterial_spot", "diseased"),
    ("Tomato_Early_blight", "Tomato", "Early_blight", "diseased"),
    ("Tomato_Late_blight", "Tomato", "Late_blight", "diseased"),
    ("Tomato_Leaf_Mold", "Tomato", "Leaf_Mold", "diseased"),
    ("Tomato_Septoria_leaf_spot", "Tomato", "Septoria_leaf_spot", "diseased"),
    ("Tomato_Spider_mites_Two_spotted_spider_mite", "Tomato", "Spider_mites_Two_spotted_spider_mite", "diseased"),
    ("Tomato__Target_Spot", "Tomato", "Target_Spot", "diseased"),
    ("Tomato__Tomato_YellowLeaf__Curl_Virus", "Tomato", "Tomato_YellowLeaf_Curl_Virus", "diseased"),
    ("Tomato__Tomato_mosaic_virus", "Tomato", "Tomato_mosaic_virus", "diseased"),
    ("Tomato_healthy", "Tomato", "None", "healthy"),
    ("Unknownclass", "Unknownclass", "Unknown", "diseased"),
    ("Tomato_HEALTHY", "Tomato", "None", "healthy"),
]


def test_labels(spark):
    df = spark.createDataFrame([(row[0],) for row in LABELS], "c string").coalesce(1)
    c = F.col("c")
    rows = df.select("c", LB.plant_type(c), LB.disease_name(c), LB.health_status(c)).collect()
    assert [tuple(r) for r in rows] == LABELS


def test_wind_direction_is_never_negative(spark):
    df = spark.createDataFrame([(-10,), (0,), (359,), (360,), (725,)], "d int").coalesce(1)
    assert column(df, W.wind_direction_normalised(F.col("d"))) == [350, 0, 359, 0, 5]


def test_seasonal_factor_flips_in_the_south(spark):
    df = spark.createDataFrame([(172, 10.0), (172, -10.0), (80, 0.0)], "d int, lat double").coalesce(1)
    peak = math.sin(2 * math.pi * 92 / 365)
    assert column(df, W.seasonal_factor(F.col("d"), F.col("lat"))) == pytest.approx([peak, -peak, 0.0])


def test_freshness_is_strict(spark):
    now = datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(datetime(2024, 1, 1, 11, 0, 1),), (datetime(2024, 1, 1, 11),),
                                (datetime(2024, 1, 1, 13),)], "ts timestamp").coalesce(1)
    assert column(df, W.freshness(F.col("ts"), F.lit(now))) == [True, False, False]


def test_hash_draws_repeat_and_spread(spark):
    df = spark.range(2000).select(LB.hash_uniform(F.col("id"), F.lit(1)).alias("u"))
    first, again = column(df, "u"), column(df.repartition(7).orderBy("u"), "u")
    assert sorted(first) == again
    assert 0 <= min(first) and max(first) < 1 and abs(sum(first) / 2000 - 0.5) < 0.03


def test_grid_key_rounds_the_binary_value(spark):
    """As Python and C print two decimals: true halves go to even, 1.005 lies below its half."""
    rng = random.Random(1)
    values = [n + f for n in (0, 1, 2, 44, 89, 179) for f in (0.125, 0.375, 0.625, 0.875, 0.005, 0.015, 0.995, 0.9999, 0.285, 0.5)]
    values += [math.nextafter(v, t) for v in values for t in (-1000.0, 1000.0)] + [rng.uniform(0, 180) for _ in range(2000)]
    values += [rng.randrange(10**6) / 1000 for _ in range(2000)] + [1e-300, 0.0049, 2.0**51 + 0.5, 2.0**45 + 0.125, 2.0**52 - 0.5, 1e15]
    values += [-v for v in values] + [0.0, -0.0, math.inf, -math.inf, math.nan]
    df = spark.createDataFrame([(v, -v) for v in values], "lat double, lon double").coalesce(1)
    assert column(df, W.grid_key(F.col("lat"), F.col("lon"))) == [f"{v:.2f},{-v:.2f}" for v in values]
    large = spark.createDataFrame([(1e300, None), (None, 1.0), (1e300, 2.0**60)], "lat double, lon double")
    assert column(large, W.grid_key(F.col("lat"), F.col("lon")))[:2] == [None, None]


def test_geo_grid_key_equals_its_sql_on_halves(spark, tmp_path):
    """An area of 8,192 is an eighth of a degree."""
    import duckdb
    from fieldlake.plans import registry

    jobs, checks = registry.load()
    rows = [(i, f"c{i}", 1, 8192.0 * (i % 9 - 4) if i else None, "M") for i in range(400)]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM read_parquet('{tmp_path}/customer.parquet/*.parquet')")
    assert sorted(map(tuple, jobs["geo_grid_key"](spark, str(tmp_path)).collect())) == sorted(con.execute(checks["geo_grid_key"]).fetchall())
