"""SQL text of the domain views and chains, for the checking queries.

Written apart from the DataFrame code, in the plainest form: joins and window
functions where the Spark side avoids them.
"""

from __future__ import annotations

from fieldlake import constants as K
from fieldlake.sources.domain import SUFFIXES as SUFFIX_LIST


def _values(rows) -> str:
    def literal(v):
        if v is None:
            return "NULL"
        return "'" + v + "'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)"

    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


RULES = ", ".join(
    f"({i}, " + _values([rule])[1:] for i, rule in enumerate(K.DISEASE_RULES)
)
CLASSES = ", ".join(f"'{c}'" for c in K.EXPECTED_CLASSES)
SUFFIXES = f"({list(SUFFIX_LIST)})"


def _std_sql(condition: str = "TRUE") -> str:
    n, s, q = (f"CAST({x} FILTER (WHERE {condition}) AS DOUBLE)" for x in ("count(*)", "sum(v)", "sum(v * v)"))
    return f"round(sqrt(greatest(0, {q} / {n} - ({s} / {n}) * ({s} / {n}))), 4)"


def _mean_sql(condition: str = "TRUE") -> str:
    return f"round(CAST(sum(v) FILTER (WHERE {condition}) AS DOUBLE) / count(*) FILTER (WHERE {condition}), 4)"


#: Blue, green and red in stored order.
_CHANNELS = ", ".join(f"{_mean_sql(f'i % 3 = {i}')} AS {c}_mean, {_std_sql(f'i % 3 = {i}')} AS {c}_std"
                      for i, c in enumerate(("blue", "green", "red")))

ZONE = ("CASE WHEN abs(lat) <= 23.5 THEN 'tropical' WHEN abs(lat) <= 35 THEN 'subtropical' "
        "WHEN abs(lat) <= 55 THEN 'temperate' WHEN abs(lat) <= 60 THEN 'continental' ELSE 'polar' END")


def season_sql(doy: str) -> str:
    return (f"CASE WHEN {doy} >= 80 AND {doy} < 172 THEN CASE WHEN lat >= 0 THEN 'spring' ELSE 'fall' END "
            f"WHEN {doy} >= 172 AND {doy} < 264 THEN CASE WHEN lat >= 0 THEN 'summer' ELSE 'winter' END "
            f"WHEN {doy} >= 264 AND {doy} < 355 THEN CASE WHEN lat >= 0 THEN 'fall' ELSE 'spring' END "
            f"ELSE CASE WHEN lat >= 0 THEN 'winter' ELSE 'summer' END END")


def uniform_sql(*parts: str) -> str:
    return ("(CAST('0x' || substr(md5(concat_ws('|', " + ", ".join(parts)
            + ")), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE))")


VIEWS = {
    "readings": """SELECT event_id, user_id AS sensor_id, CAST(floor(user_id / 6.0) AS BIGINT) AS field_id,
        CASE WHEN user_id % 6 = 5 THEN 'atmospheric' ELSE 'soil' END AS sensor_type,
        ts AS "timestamp", date_trunc('hour', ts) AS slot, CAST(k AS DOUBLE) AS moisture,
        CAST(10 + event_id % 25 AS DOUBLE) AS temperature, CAST(30 + k % 71 AS DOUBLE) AS humidity,
        CASE WHEN event_id % 3 = 0 THEN value / 10 ELSE 0 END AS rainfall,
        CAST(30 + event_id % 41 AS DOUBLE) AS nitrogen,
        CAST(5 AS DOUBLE) + CAST(event_id % 35 AS DOUBLE) / 10 AS ph,
        CAST(event_id % 800 - 400 AS INTEGER) AS wind_direction, CAST(event_id % 101 AS INTEGER) AS clouds
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)""",
    "repeated": "SELECT * FROM readings UNION ALL SELECT * FROM readings WHERE event_id % 10 = 0",
    "weather": """SELECT field_id, slot, max(temperature) AS temperature, max(humidity) AS humidity,
        max(rainfall) AS rainfall FROM readings GROUP BY field_id, slot""",
    "fields": """SELECT c_custkey AS field_id, c_nationkey AS user_id, c_name AS name,
        CAST((c_custkey * 37) % 181 - 90 AS DOUBLE) AS lat, CAST((c_custkey * 53) % 361 - 180 AS DOUBLE) AS lon,
        c_acctbal AS area_hectares,
        CASE c_custkey % 4 WHEN 0 THEN 'tomato' WHEN 1 THEN 'pepper' WHEN 2 THEN 'potato' ELSE 'mixed' END AS crop_type,
        c_mktsegment AS soil_type, c_custkey % 10 <> 9 AS active FROM customer""",
    "sensors": """SELECT DISTINCT user_id AS sensor_id, CAST(floor(user_id / 6.0) AS BIGINT) AS field_id,
        CASE WHEN user_id % 6 = 5 THEN 'atmospheric' ELSE 'soil' END AS sensor_type,
        CASE WHEN user_id % 7 = 3 THEN 'inactive' ELSE 'active' END AS status FROM events""",
    "field_days": """SELECT o_orderkey AS day_id, o_custkey AS field_id, o_orderdate AS "timestamp",
        o_totalprice AS price, lat, lon FROM orders JOIN fields ON fields.field_id = o_custkey""",
    "users": """SELECT n_nationkey AS user_id, n_name AS name,
        CASE n_regionkey % 3 WHEN 0 THEN 'ADMIN' WHEN 1 THEN 'FARMER' ELSE 'RESEARCHER' END AS role FROM nation""",
    "roles": "SELECT * FROM (VALUES " + ", ".join(
        f"('{r}', '{p}')" for r, ps in K.ROLE_PERMISSIONS.items() for p in ps) + ") AS t(role, permission)",
    "rules": f"""SELECT * FROM (VALUES {RULES}) AS t(ordinal, disease, temp_lo, temp_hi, hum_lo, hum_hi,
        rain_trigger, moist_lo, moist_hi, progression)""",
    "soil": """SELECT field_id, slot, avg(moisture) AS soil_moisture, avg(temperature) AS soil_temperature
        FROM readings WHERE sensor_type = 'soil' GROUP BY field_id, slot""",
    "conditions": """SELECT s.field_id, s.slot, w.temperature, w.humidity, w.rainfall, s.soil_moisture,
        f.crop_type, f.lat FROM soil s JOIN weather w ON w.field_id = s.field_id AND w.slot = s.slot
        JOIN fields f ON f.field_id = s.field_id WHERE f.active""",
    "scored": """SELECT c.*, r.ordinal, r.disease, r.progression,
        CAST(0 AS DOUBLE) + CASE WHEN c.temperature BETWEEN r.temp_lo AND r.temp_hi THEN CAST(0.3 AS DOUBLE) ELSE 0 END
        + CASE WHEN c.humidity BETWEEN r.hum_lo AND r.hum_hi THEN CAST(0.3 AS DOUBLE) ELSE 0 END
        + CASE WHEN c.rainfall >= r.rain_trigger THEN CAST(0.2 AS DOUBLE) ELSE 0 END
        + CASE WHEN coalesce(c.soil_moisture, 50) BETWEEN r.moist_lo AND r.moist_hi THEN CAST(0.2 AS DOUBLE) ELSE 0 END
        AS risk FROM conditions c JOIN rules r ON contains(lower(r.disease), lower(c.crop_type))""",
    "best": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY field_id, slot ORDER BY risk DESC, ordinal)
        AS place FROM scored WHERE risk > CAST(0.6 AS DOUBLE)) WHERE place = 1""",
    "images": f"""SELECT doc_id AS image_id, class_label, n_chars AS file_size_bytes,
        source || '/' || class_label || '/' || filename AS path, filename,
        CAST(200 + doc_id % 57 AS INTEGER) AS width, CAST(200 + doc_id % 31 AS INTEGER) AS height
        FROM (SELECT *, ([{CLASSES}])[doc_id % 15 + 1] AS class_label,
        CAST(doc_id AS VARCHAR) || {SUFFIXES}[(doc_id // 10) % 8 + 1] AS filename FROM documents)""",
    "processed_files": """SELECT image_id, file_size_bytes, CASE WHEN image_id % 10 < 7 THEN 'train'
        WHEN image_id % 10 = 7 THEN 'val' WHEN image_id % 10 = 8 THEN 'test' ELSE 'extra' END AS split,
        class_label, filename, width, height FROM images""",
    "processed": """SELECT * FROM processed_files WHERE split <> 'extra'
        AND (filename LIKE '%.jpg' OR filename LIKE '%.png')""",
    "labelled": """SELECT *, split_part(class_label, '_', 1) AS plant_type,
        CASE WHEN contains(lower(class_label), 'healthy') THEN 'None'
        WHEN contains(replace(class_label, '__', '_'), '_')
        THEN substr(replace(class_label, '__', '_'), strpos(replace(class_label, '__', '_'), '_') + 1)
        ELSE 'Unknown' END AS disease_name,
        CASE WHEN contains(lower(class_label), 'healthy') THEN 'healthy' ELSE 'diseased' END AS health_status,
        split || '/' || class_label || '/' || filename AS filepath,
        round(file_size_bytes / CAST(1024 AS DOUBLE), 2) AS file_size_kb FROM processed""",
    "ranked": """SELECT *, row_number() OVER (PARTITION BY class_label
        ORDER BY md5('42|' || CAST(image_id AS VARCHAR)), image_id) AS class_rank,
        count(*) OVER (PARTITION BY class_label) AS class_size FROM images""",
    "split": """SELECT * EXCLUDE (held, test_size), CASE WHEN class_rank <= class_size - held THEN 'train'
        WHEN class_rank <= class_size - test_size THEN 'val' ELSE 'test' END AS split
        FROM (SELECT *, CAST(ceil(CAST(held AS DOUBLE) / 2) AS BIGINT) AS test_size FROM (SELECT *,
        CASE WHEN class_size = 1 THEN 0 ELSE CAST(ceil(CAST(0.3 AS DOUBLE) * class_size) AS BIGINT) END AS held
        FROM ranked))""",
    "fanned": """SELECT *, CASE WHEN copy = 0 THEN '' ELSE '_aug_' || CAST(copy AS VARCHAR) END AS suffix
        FROM split JOIN (SELECT unnest([0, 1, 2, 3]) AS copy) c ON c.copy = 0 OR split.split = 'train'""",
    "r_fields": """SELECT CAST(field_id AS VARCHAR) AS field_id, name, CAST(lat AS DECIMAL(10,7)) AS location_lat,
        CAST(lon AS DECIMAL(10,7)) AS location_lon, CAST(area_hectares AS DECIMAL(10,2)) AS area_hectares, soil_type,
        TIMESTAMP '1970-01-01' + to_seconds(field_id * 60) AS created_at FROM fields""",
    "r_sensors": """SELECT CAST(sensor_id AS VARCHAR) AS sensor_id, CAST(field_id AS VARCHAR) AS field_id, sensor_type, status,
        DATE '2024-01-01' + CAST(sensor_id % 28 AS INTEGER) AS last_maintenance,
        TIMESTAMP '1970-01-01' + to_seconds(sensor_id * 60) AS created_at FROM sensors""",
    "r_batch_jobs": """SELECT CAST(o_orderkey AS VARCHAR) AS job_id, 'job-' || o_orderpriority AS job_name,
        CAST(o_orderdate AS TIMESTAMP) AS start_time, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 HOUR AS end_time,
        CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'completed' END AS status, CAST(o_orderkey AS BIGINT) AS records_processed,
        CASE WHEN o_orderstatus = 'F' THEN 'stopped' END AS error_message, CAST(o_orderdate AS TIMESTAMP) AS created_at FROM orders""",
    "r_analytics_summary": """SELECT CAST(l_shipdate AS DATE) AS analysis_date, CAST(l_suppkey AS VARCHAR) AS field_id,
        count(*) AS total_readings, CAST(floor(sum(l_quantity) / count(*)) AS DECIMAL(5,2)) AS avg_temperature,
        CAST(floor(sum(round(l_discount * 100) * 10) / count(*)) AS DECIMAL(5,2)) AS avg_moisture,
        count(*) FILTER (WHERE l_returnflag = 'R') AS disease_count, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS created_at
        FROM lineitem GROUP BY 1, 2""",
    "gray": """SELECT vec_id AS image_id, CAST(label AS VARCHAR) AS class_label,
        [CAST(least(255, greatest(0, floor(abs(x) * 512))) AS INTEGER) for x in embedding] AS px FROM embeddings""",
    "colour": "SELECT image_id, class_label, list_resize(px, 72, 0) AS px FROM gray",
    "gray_pixels": """SELECT image_id, class_label, generate_subscripts(px, 1) - 1 AS i, unnest(px) AS v FROM gray""",
    "colour_pixels": "SELECT image_id, class_label, generate_subscripts(px, 1) - 1 AS i, unnest(px) AS v FROM colour",
    "pixel_files": f"""SELECT *, split || '/' || label || '/' || filename AS filepath FROM (
        SELECT image_id, px, CASE WHEN image_id % 10 < 7 THEN 'train' WHEN image_id % 10 = 7 THEN 'val'
        WHEN image_id % 10 = 8 THEN 'test' ELSE 'extra' END AS split, ([{CLASSES}])[image_id % 15 + 1] AS label,
        CAST(image_id AS VARCHAR) || {SUFFIXES}[(image_id // 10) % 8 + 1] AS filename FROM colour)
        WHERE split <> 'extra' AND (filename LIKE '%.jpg' OR filename LIKE '%.png')""",
    "metadata": f"""SELECT filename, filepath, filepath AS absolute_path, CAST(72 AS BIGINT) AS file_size_bytes,
        round(72 / CAST(1024 AS DOUBLE), 2) AS file_size_kb, 6 AS width, 4 AS height, 3 AS channels, 'RGB' AS mode,
        CASE WHEN filename LIKE '%.png' THEN 'PNG' ELSE 'JPEG' END AS format, label AS class_label, split,
        split_part(label, '_', 1) AS plant_type, CASE WHEN contains(lower(label), 'healthy') THEN 'None'
        WHEN contains(replace(label, '__', '_'), '_')
        THEN substr(replace(label, '__', '_'), strpos(replace(label, '__', '_'), '_') + 1) ELSE 'Unknown' END AS disease_name,
        CASE WHEN contains(lower(label), 'healthy') THEN 'healthy' ELSE 'diseased' END AS health_status,
        TIMESTAMP '2023-11-14 22:13:20' + to_seconds(image_id) AS modified_at, s.* EXCLUDE (image_id)
        FROM pixel_files JOIN (SELECT image_id, {_mean_sql()} AS pixel_mean, {_std_sql()} AS pixel_std,
        min(v) AS pixel_min, max(v) AS pixel_max, {_CHANNELS} FROM colour_pixels GROUP BY image_id) s USING (image_id)""",
}


def progress_sql(source: str) -> str:
    """Course of infections over rows (field_id, disease, slot, risk, progression)."""
    return f"""SELECT * EXCLUDE (started, nth), CASE WHEN nth = 1 THEN 'new_infection' ELSE 'active_infection' END AS status,
        round(CASE progression
          WHEN 'exponential' THEN least(1, risk * pow(CAST(1.1 AS DOUBLE), days_active))
          WHEN 'fast_exponential' THEN least(1, risk * pow(CAST(1.2 AS DOUBLE), days_active))
          WHEN 'linear' THEN least(1, risk + CAST(0.05 AS DOUBLE) * days_active)
          WHEN 'slow' THEN least(1, risk + CAST(0.02 AS DOUBLE) * days_active) ELSE risk END, 3) AS severity
        FROM (SELECT *, CAST(floor((epoch(slot) - epoch(started)) / 86400) AS INTEGER) AS days_active
        FROM (SELECT *, min(slot) OVER (PARTITION BY field_id, disease) AS started,
        row_number() OVER (PARTITION BY field_id, disease ORDER BY slot) AS nth FROM {source}))"""


VIEWS["progress"] = progress_sql("best")
VIEWS["noon_best"] = "SELECT * FROM best WHERE hour(slot) = 12"
VIEWS["noon_progress"] = progress_sql("noon_best")
VIEWS["records"] = f"""SELECT field_id, disease, severity, status, slot AS detection_date, temperature, humidity,
    rainfall, soil_moisture, {season_sql('dayofyear(slot)')} AS season, {ZONE} AS climate_zone FROM noon_progress"""

DEPENDS = {
    "r_fields": ["fields"], "r_sensors": ["sensors"],
    "repeated": ["readings"], "weather": ["readings"], "field_days": ["fields"], "soil": ["readings"],
    "conditions": ["soil", "weather", "fields"], "scored": ["conditions", "rules"], "best": ["scored"],
    "progress": ["best"], "noon_best": ["best"], "noon_progress": ["noon_best"], "records": ["noon_progress"],
    "processed_files": ["images"], "processed": ["processed_files"], "labelled": ["processed"],
    "ranked": ["images"], "split": ["ranked"], "fanned": ["split"], "colour": ["gray"],
    "gray_pixels": ["gray"], "colour_pixels": ["colour"], "pixel_files": ["colour"], "metadata": ["pixel_files", "colour_pixels"],
}


def hex_sql(pixels: str) -> str:
    return f"list_aggregate([printf('%02X', v) for v in {pixels}], 'string_agg', '')"


def _lanczos_sql(source: int, target: int) -> str:
    """Normalised weights [target][source] of the three-lobed window; it widens when shrinking."""
    scale = source / target
    stretch = max(scale, 1.0)
    distance = f"(s + 5e-1 - (t + 5e-1) * CAST({scale!r} AS DOUBLE)) / CAST({stretch!r} AS DOUBLE)"
    sinc = lambda x: f"sin(pi() * {x}) / (pi() * {x})"
    weight = f"CASE WHEN abs(d) >= 3 THEN 0e0 WHEN d = 0 THEN 1e0 ELSE {sinc('d')} * {sinc('(d / 3e0)')} END"
    raw = f"[[{weight} for d in [{distance} for s in range({source})]] for t in range({target})]"
    return f"[[w / list_sum(ws) for w in ws] for ws in {raw}]"


def resized_sql(rows: str, height: int, width: int, to_height: int, to_width: int) -> str:
    """``rows`` with the three-channel pixels ``px`` in another size: columns first, then rows, each rounded."""
    level = lambda total: f"CAST(least(255, greatest(0, floor({total} + 5e-1))) AS INTEGER)"
    wide = " + ".join(f"wx[k // 3 % {to_width} + 1][{s + 1}] * px[k // {3 * to_width} * {3 * width} + {3 * s} + k % 3 + 1]" for s in range(width))
    tall = " + ".join(f"wy[k // {3 * to_width} + 1][{s + 1}] * mid[{3 * to_width * s} + k % {3 * to_width} + 1]" for s in range(height))
    return f"""SELECT * EXCLUDE (px, mid, wx, wy), [{level(tall)} for k in range({3 * to_height * to_width})] AS px FROM (
        SELECT *, [{level(wide)} for k in range({3 * height * to_width})] AS mid FROM {rows},
        (SELECT {_lanczos_sql(width, to_width)} AS wx, {_lanczos_sql(height, to_height)} AS wy))"""


def rotated_sql(rows: str, height: int, width: int) -> str:
    """``rows`` with the three-channel pixels ``px`` turned by ``angle`` degrees about the centre, bilinear, black outside."""
    dx, dy = f"(k % {width} + 5e-1 - {width / 2}e0)", f"(k // {width} + 5e-1 - {height / 2}e0)"
    at = "spot[k // 3 + 1]"
    row, col = (lambda plus, axis=axis, most=most: f"CAST(least({most - 1}, greatest(0, floor({at}.{axis} - 5e-1) + {plus})) AS INTEGER)"
                for axis, most in (("y", height), ("x", width)))
    part = lambda axis: f"({at}.{axis} - 5e-1 - floor({at}.{axis} - 5e-1))"
    pick = lambda r, c: f"px[({row(r)} * {width} + {col(c)}) * 3 + k % 3 + 1]"
    line = lambda r: f"({pick(r, 0)} * (1e0 - {part('x')}) + {pick(r, 1)} * {part('x')})"
    mixed = f"floor({line(0)} * (1e0 - {part('y')}) + {line(1)} * {part('y')} + 5e-1)"
    inside = f"{at}.x >= 0 AND {at}.x < {width} AND {at}.y >= 0 AND {at}.y < {height}"
    return f"""SELECT * EXCLUDE (px, spot, turn_cos, turn_sin),
        [CASE WHEN {inside} THEN CAST(least(255, greatest(0, {mixed})) AS INTEGER) ELSE 0 END for k in range({3 * height * width})] AS px
        FROM (SELECT *, [{{'x': turn_cos * {dx} - turn_sin * {dy} + {width / 2}e0, 'y': turn_sin * {dx} + turn_cos * {dy} + {height / 2}e0}}
          for k in range({height * width})] AS spot
        FROM (SELECT *, cos(radians(angle)) AS turn_cos, sin(radians(angle)) AS turn_sin FROM {rows}))"""


# the image split and its copies over the pixel images
VIEWS |= {f"px_{n}": VIEWS[n].replace("FROM images", "FROM colour").replace("FROM ranked", "FROM px_ranked").replace("FROM split", "FROM px_split").replace("split.split", "px_split.split")
          for n in ("ranked", "split", "fanned")}
DEPENDS |= {"px_ranked": ["colour"], "px_split": ["px_ranked"], "px_fanned": ["px_split"]}


def with_views(names: str, body: str) -> str:
    """``body`` preceded by the named views and whatever they build on."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for dependency in DEPENDS.get(name, []):
            need(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        need(name)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered) + "\n" + body
