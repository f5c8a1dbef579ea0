"""Climate, season and expected-value expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fieldlake import constants as K


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def climate_zone(lat: Column) -> Column:
    """Zone by distance from the equator; upper bounds belong to the zone."""
    name, _, _, _ = K.CLIMATE_ZONES[-1]
    zone = F.lit(name)
    for name, bound, _, _ in reversed(K.CLIMATE_ZONES[:-1]):
        zone = F.when(F.abs(lat) <= bound, name).otherwise(zone)
    return F.when(lat.isNotNull(), zone)


def zone_parameter(zone: Column, index: int) -> Column:
    """Base temperature (2) or yearly swing (3) of a zone, as a folded CASE."""
    value = F.lit(None).cast("double")
    for row in reversed(K.CLIMATE_ZONES):
        value = F.when(zone == row[0], F.lit(row[index])).otherwise(value)
    return value


def season(day_of_year: Column, lat: Column) -> Column:
    north, south = F.lit(K.SEASON_REST[0]), F.lit(K.SEASON_REST[1])
    for first, end, north_name, south_name in reversed(K.SEASON_BANDS):
        inside = (day_of_year >= first) & (day_of_year < end)
        north = F.when(inside, north_name).otherwise(north)
        south = F.when(inside, south_name).otherwise(south)
    return F.when(lat >= 0, north).when(lat < 0, south)


def seasonal_factor(day_of_year: Column, lat: Column) -> Column:
    """Yearly sine, +1 at midsummer of the hemisphere."""
    wave = F.sin(F.lit(2 * math.pi) * (day_of_year - 80) / 365)
    return F.when(lat < 0, -wave).otherwise(wave)


def temperature_baseline(zone: Column, seasonal: Column, hour: Column) -> Column:
    daily = F.lit(8.0) * (1 - F.abs(12 - hour) / 12) - 4
    return zone_parameter(zone, 2) + zone_parameter(zone, 3) * seasonal + daily


def humidity_baseline(zone: Column, temperature: Column) -> Column:
    base = F.when(zone == "tropical", 70.0).otherwise(60.0)
    return clamp(base - (temperature - 20) * 1.5, 20.0, 95.0)


def rain_probability(zone: Column, seasonal: Column) -> Column:
    base = F.when(zone == "tropical", 0.15).otherwise(0.08)
    return base * (1 + F.lit(0.3) * seasonal)


def soil_temperature_baseline(air: Column) -> Column:
    return air * 0.85


def soil_moisture_baseline(rainfall: Column, humidity: Column, air: Column) -> Column:
    return clamp(45 + rainfall * 5 + (humidity - 50) * 0.2 - (air - 20) * 0.5, 15.0, 95.0)


def soil_ph_baseline(moisture: Column) -> Column:
    return clamp(6.8 - (moisture - 45) * 0.01, 5.5, 8.0)


def soil_ec_baseline(moisture: Column) -> Column:
    return moisture / 50 * 0.5


def light_baseline(hour: Column, clouds: Column) -> Column:
    """Expected daylight; null at night, where only the range 0-100 is known."""
    sun = F.lit(80000.0) * (1 - F.abs(12 - hour) / 6) * (100 - clouds) / 100
    return F.when(hour.between(6, 18), sun)


def light_residual(hour: Column, clouds: Column, light: Column) -> Column:
    """Observed minus expected; at night the distance to the range 0-100."""
    expected = light_baseline(hour, clouds)
    return F.when(expected.isNotNull(), light - expected).otherwise(light - clamp(light, 0.0, 100.0))


def wind_direction_normalised(degrees: Column) -> Column:
    """Degrees in [0, 360): pmod, because % keeps the sign of the left side."""
    return F.pmod(degrees, F.lit(360))


def freshness(ts: Column, reference: Column, seconds: int = K.FRESH_SECONDS) -> Column:
    gap = F.abs(F.unix_micros(reference.cast("timestamp")) - F.unix_micros(ts.cast("timestamp")))
    return gap < seconds * 1_000_000


def two_places(x: Column) -> Column:
    """A double with two decimals as C and Python print it; ``format_string`` rounds its shortest decimal form half up.

    The binary value itself is rounded, a true half to the even digit. The fraction is cut in two so that
    every product is exact; only the last sum is not, and its sign is right. From 2^52 on there is no
    fraction, and the digits are Java's.
    """
    size = F.abs(x)
    fraction = size - F.floor(size)
    high = F.floor(fraction * (1 << 26)) / (1 << 26)
    cents = F.floor(high * 100)
    rest = (high * 100 - cents - 0.5) + (fraction - high) * 100
    total = F.floor(size) * 100 + cents + ((rest > 0) | ((rest == 0) & (cents % 2 == 1))).cast("long")
    sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")
    digits = F.format_string("%d.%02d", F.call_function("div", total, F.lit(100)), total % 100)
    return (F.when(F.isnan(x), "nan").when(size == float("inf"), F.concat(sign, F.lit("inf")))
            .when(size < 1 << 52, F.concat(sign, digits)).when(x.isNotNull(), F.format_string("%.2f", x)))


def grid_key(lat: Column, lon: Column) -> Column:
    """Both degrees with two decimals; none without both."""
    return F.concat(two_places(lat.cast("double")), F.lit(","), two_places(lon.cast("double")))


def is_weather(payload: Column) -> Column:
    """Whether a parsed answer is weather at all: text that is no JSON and error answers are not."""
    return payload["main"].isNotNull() & payload["wind"].isNotNull() & payload["clouds"].isNotNull()


def normalised_payloads(rows: DataFrame, payload: str, schema: T.StructType) -> DataFrame:
    """Rows with their parsed answer ``p``; answers that are no weather are left out.

    The filter works on a list of one parsed value: as a filter on the column Catalyst
    would push it below the projection, with a copy of the parse for each test.
    """
    return rows.withColumn("p", F.explode(F.filter(F.array(F.from_json(payload, schema)), is_weather)))


def payload_columns(payload: Column, lat: Column, day_of_year: Column) -> list[Column]:
    """Flat weather columns of a parsed live payload."""
    rainfall = F.coalesce(payload["rain"]["1h"], F.lit(0.0))
    return [
        payload["main"]["temp"].alias("temperature"),
        payload["main"]["humidity"].alias("humidity"),
        payload["main"]["pressure"].alias("pressure"),
        payload["wind"]["speed"].alias("wind_speed"),
        F.coalesce(payload["wind"]["deg"], F.lit(0)).alias("wind_direction"),
        rainfall.alias("rainfall"),
        F.coalesce(payload["clouds"]["all"], F.lit(0)).alias("clouds"),
        climate_zone(lat).alias("climate_zone"),
        (rainfall > 0).alias("is_raining"),
        season(day_of_year, lat).alias("season"),
        F.lit("openweathermap").alias("source"),
    ]
