"""SQL for DuckDB with the same results as the queries."""

from __future__ import annotations

import re

from ..schemas import (
    AQI_ALIASES,
    AQI_BOUNDS,
    AQI_TEXT,
    CITY_LEVELS,
    IMPUTED,
    LAGS,
    ML_COLUMNS,
    POLLUTANTS,
    RAW_COLUMNS,
    ROLLING,
    SEASON_LEVELS,
    SUMMARY_MEASURES,
    TARGETS,
    TEMPERATURES,
    WEATHER,
)
from .queries import NAIVE, NAIVE_MODELS, SEQUENCE_TARGET

READING_COLUMNS = [c for c in RAW_COLUMNS if c not in ("code", "id")]
SHORT = {p: p.replace("pm2_5", "pm25") for p in POLLUTANTS}


def r6(expression: str, digits: int = 6) -> str:
    return f"(round({expression}, {digits}) + 0.0)"


def half_up(expression: str, digits: int) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def listed(items) -> str:
    return ", ".join(items)


# --- Common table expressions, each using the ones before it ---

CTES: dict[str, str] = {}

CTES["base"] = """
    SELECT CAST(floor(user_id / 10) AS BIGINT) AS st, date_trunc('hour', ts) AS date,
           max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k,
           max(CASE WHEN event_type = 'click' THEN value END) AS clicked,
           max(CASE WHEN event_type = 'view' THEN value END) AS seen,
           max(CASE WHEN event_type = 'purchase' THEN value END) AS bought,
           max(CASE WHEN event_type = 'error' THEN value END) AS failed
    FROM events GROUP BY 1, 2"""

CTES["readings"] = """
    SELECT date, CAST(37.0 + st % 5 AS DOUBLE) AS latitude, CAST(13.0 + st % 7 AS DOUBLE) AS longitude,
           'S' || CAST(st AS VARCHAR) AS station_name,
           CAST(k % 21 - 10 AS DOUBLE) AS wind_speed_u, CAST(k % 13 - 6 AS DOUBLE) AS wind_speed_v,
           CAST(k % 25 AS DOUBLE) AS dewpoint_temp,
           CASE WHEN k % 11 <> 0 THEN CAST(k % 17 AS DOUBLE) END AS soil_temp,
           CAST(k % 3 AS DOUBLE) AS total_percipitation, CAST(k % 5 AS DOUBLE) AS vegetation_high,
           CAST(k % 4 AS DOUBLE) AS vegetation_low, CAST(k % 31 AS DOUBLE) AS temp,
           CAST(k AS DOUBLE) AS relative_humidity,
           clicked AS pm10, CASE WHEN st % 3 <> 2 THEN seen END AS pm2_5, bought AS no2, failed AS o3,
           CASE st % 3 WHEN 0 THEN 'athens' WHEN 1 THEN 'ancona' ELSE 'zaragoza' END AS city
    FROM base"""

_VANISHED = ("vegetation_high", "vegetation_low")


def _unified(column: str) -> str:
    if column in TEMPERATURES:
        return f"CASE WHEN city = 'ancona' THEN ({column} - 32.0) * 5.0 / 9.0 ELSE {column} END AS {column}"
    if column in _VANISHED:
        return f"CASE WHEN city <> 'zaragoza' THEN {column} END AS {column}"
    if column == "code":
        return "CASE WHEN city = 'athens' THEN 'C' || substr(station_name, 2) END AS code"
    if column == "id":
        return "CASE WHEN city = 'athens' THEN CAST(substr(station_name, 2) AS INTEGER) END AS id"
    return column


CTES["unified"] = f"SELECT {listed(map(_unified, RAW_COLUMNS))} FROM readings"

RATIO = """SELECT coalesce(avg(pm2_5 / pm10), 0.5) FROM {0}
    WHERE city IN ('athens', 'ancona') AND pm2_5 IS NOT NULL AND pm10 IS NOT NULL AND pm10 > 0"""

CTES["kept"] = f"""
    SELECT * REPLACE (coalesce(pm2_5, pm10 * ({RATIO.format('unified')})) AS pm2_5) FROM unified
    WHERE coalesce(pm10, pm2_5, no2, o3) IS NOT NULL"""

CTES["medians"] = f"SELECT {listed(f'quantile_disc({c}, 0.5) AS {c}' for c in IMPUTED)} FROM kept"

CTES["cleaned"] = (
    "SELECT "
    + listed(f"coalesce(kept.{c}, medians.{c}, 0.0) AS {c}" if c in IMPUTED else f"kept.{c}" for c in RAW_COLUMNS)
    + " FROM kept, medians"
)


def season(month: str) -> str:
    return (
        f"CASE WHEN {month} IN (12, 1, 2) THEN 'winter' WHEN {month} IN (3, 4, 5) THEN 'spring' "
        f"WHEN {month} IN (6, 7, 8) THEN 'summer' ELSE 'fall' END"
    )


CALENDAR = {
    "year": "CAST(year(date) AS INTEGER)",
    "month": "CAST(month(date) AS INTEGER)",
    "day": "CAST(day(date) AS INTEGER)",
    "hour": "CAST(hour(date) AS INTEGER)",
    "day_of_week": "CAST(dayofweek(date) + 1 AS INTEGER)",
    "is_weekend": "CAST(CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER)",
    "season": season("month(date)"),
}
WEATHER_SQL = {
    "wind_speed": "sqrt(wind_speed_u * wind_speed_u + wind_speed_v * wind_speed_v)",
    "wind_direction": "degrees(atan2(wind_speed_v, wind_speed_u))",
    "temp_dewpoint_spread": "temp - dewpoint_temp",
    "temp_soil_diff": "temp - soil_temp",
}
RATIO_SQL = {
    "pm10_pm25_ratio": "CASE WHEN pm2_5 > 0 THEN pm10 / pm2_5 END",
    "no2_o3_balance": "CASE WHEN o3 > 0 THEN no2 / o3 END",
}


def _windows(order: str) -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    w = f"PARTITION BY station_name ORDER BY {order}"
    back, ahead = f"({w} ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)", f"({w} ROWS BETWEEN 1 FOLLOWING AND 24 FOLLOWING)"
    rolling = {f"{s}_roll_24h_mean": f"avg({p}) OVER {back}" for p, s in SHORT.items()}
    rolling["o3_roll_24h_max"] = f"max(o3) OVER {back}"
    lags = {f"{s}_lag{n}": f"lag({p}, {n}) OVER ({w})" for p, s in SHORT.items() for n in (1, 2, 3)}
    targets = {
        "pm10_next_24h_mean": f"avg(pm10) OVER {ahead}",
        "pm25_next_24h_mean": f"avg(pm2_5) OVER {ahead}",
        "o3_next_24h_max": f"max(o3) OVER {ahead}",
    }
    return rolling, lags, targets


ROLLING_SQL, LAG_SQL, TARGET_SQL = _windows("date")


def aliased(columns: dict[str, str], digits: int | None = None) -> str:
    return listed(f"{e if digits is None else r6(e, digits)} AS {c}" for c, e in columns.items())


_ALL_FEATURES = {**CALENDAR, **WEATHER_SQL, **RATIO_SQL, **ROLLING_SQL, **LAG_SQL, **TARGET_SQL}


def _ml(table: str) -> str:
    return f"SELECT {listed(c if c not in _ALL_FEATURES else f'{_ALL_FEATURES[c]} AS {c}' for c in ML_COLUMNS)} FROM {table}"


CTES["features_raw"] = _ml("readings")
CTES["features"] = _ml("cleaned")
CTES["ml"] = "SELECT * FROM features WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in ML_COLUMNS)
CTES["targeted"] = (
    f"SELECT * FROM (SELECT *, {TARGET_SQL[SEQUENCE_TARGET]} AS {SEQUENCE_TARGET} FROM cleaned) "
    f"WHERE {SEQUENCE_TARGET} IS NOT NULL"
)
CTES["numbered"] = """
    SELECT *, row_number() OVER (PARTITION BY station_name ORDER BY date) AS row_number,
           count(*) OVER (PARTITION BY station_name) AS station_rows FROM targeted"""
CTES["starts"] = """
    SELECT *, row_number() OVER (ORDER BY station_name, date) AS position, count(*) OVER () AS all_starts
    FROM numbered WHERE row_number <= station_rows - 23"""
CTES["trained"] = """
    SELECT station_name, max(row_number) AS last_start FROM starts
    WHERE position <= floor(all_starts * CAST(0.70 AS DOUBLE)) GROUP BY station_name"""
CTES["train_rows"] = """
    SELECT numbered.* FROM numbered JOIN trained USING (station_name) WHERE row_number <= last_start + 23"""

_MEANS = {"avg_pm10": "pm10", "avg_pm25": "pm2_5", "avg_no2": "no2", "avg_o3": "o3"}
CTES["summary"] = (
    "SELECT city, "
    + listed(f"{half_up(f'avg({c})', 2)} AS {name}" for name, c in _MEANS.items())
    + ", count(pm10) AS count FROM cleaned GROUP BY city"
)
CTES["long"] = " UNION ALL ".join(f"SELECT city, '{m}' AS measure, {m} AS value FROM summary" for m in _MEANS)
CTES["long_all"] = "SELECT * FROM long UNION ALL SELECT 'all', measure, avg(value) FROM long GROUP BY measure"
FAR_CITY = "CASE WHEN station_name IN ('S1', 'S4', 'S7') THEN 'porto' ELSE city END"
CTES["far_summary"] = (
    f"SELECT {FAR_CITY} AS city, "
    + listed(f"{half_up(f'avg({c})', 2)} AS {name}" for name, c in _MEANS.items())
    + " FROM cleaned GROUP BY 1"
)
CTES["far_long"] = " UNION ALL ".join(f"SELECT city, '{m}' AS measure, {m} AS value FROM far_summary" for m in _MEANS)
CTES["dense"] = """
    SELECT l_shipdate AS date, 'S' || CAST(l_suppkey AS VARCHAR) AS station_name,
           CASE l_returnflag WHEN 'A' THEN 'athens' WHEN 'N' THEN 'ancona' ELSE 'zaragoza' END AS city,
           l_quantity AS pm10,
           CASE WHEN l_returnflag <> 'R' THEN CAST(floor(l_extendedprice / 1000) AS DOUBLE) END AS pm2_5,
           CAST(round(l_discount * 100) AS DOUBLE) AS no2,
           CASE WHEN NOT (l_linestatus = 'F' AND l_tax = 0) THEN CAST(round(l_tax * 100) AS DOUBLE) END AS o3,
           l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
    FROM lineitem"""
CTES["special"] = """
    SELECT station_name, date, temp,
           CASE WHEN temp = 0 THEN CAST('NaN' AS DOUBLE) WHEN temp = 1 THEN CAST('Infinity' AS DOUBLE)
                WHEN temp = 2 THEN CAST('-Infinity' AS DOUBLE) ELSE pm10 END AS x FROM readings"""


def sql(body: str) -> str:
    """``body`` behind the table expressions it names, directly or through others."""
    needed, pending = set(), [body]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words.intersection(CTES).difference(needed):
            needed.add(name)
            pending.append(CTES[name])
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in CTES.items() if name in needed) + f"\n{body}"


def _rounded(columns, digits: int = 6) -> str:
    """Select list with measurements rounded and other columns as they are."""
    plain = {"date", "station_name", "city", "code", "id", "season", *CALENDAR}
    return listed(c if c in plain else f"{r6(c, digits)} AS {c}" for c in columns)


def _level(pollutant: str, value: str) -> str:
    bands = "".join(f" WHEN {value} <= {upper} THEN '{level}'" for level, upper in AQI_BOUNDS[pollutant].items())
    return f"CASE WHEN {value} IS NULL THEN NULL{bands} ELSE 'hazardous' END"


def _level_by_key(key: str, value: str) -> str:
    cases = " ".join(
        f"WHEN {key} IN ({listed(repr(a) for a in names)}) THEN {_level(p, value)}" for p, names in AQI_ALIASES.items()
    )
    return f"CASE {cases} ELSE 'good' END"


def _classified(columns: str, table: str) -> str:
    label = " ".join(f"WHEN '{level}' THEN '{text[0]}'" for level, text in AQI_TEXT.items())
    description = " ".join(f"WHEN '{level}' THEN '{text[1]}'" for level, text in AQI_TEXT.items())
    return f"""
        SELECT *, CASE level {label} END AS label, CASE level {description} END AS description,
               level NOT IN ('good', 'moderate') AS alert
        FROM (SELECT {columns}, {_level_by_key('measure', 'value')} AS level FROM {table}) AS classified"""


def _fit(columns, table: str) -> str:
    stats = [f"{r6(f'avg({c})')} AS {c}_mean" for c in columns]
    stats += [
        f"{r6(f'CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END')} AS {c}_std" for c in columns
    ]
    return f"SELECT {listed(stats)} FROM {table}"


def _metric_rows(name: str, pairs: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{key}' AS {name}, count({y}) AS n, {r6(f'sqrt(avg(pow({y} - {p}, 2)))')} AS rmse,
            {r6(f'1 - sum(pow({y} - {p}, 2)) / (count({y}) * var_pop({y}))')} AS r2 FROM ml"""
        for key, (y, p) in pairs.items()
    )


#: The numeric columns of the model inputs, and the encoded ones.
NUMERIC = [c for c in ML_COLUMNS if c not in ("date", "station_name", "city", "season", *TARGETS)]
FLAGS = {
    **{f"city_{c}": f"CASE WHEN city = '{c}' THEN 1.0 ELSE 0.0 END" for c in CITY_LEVELS},
    **{f"season_{s}": f"CASE WHEN season = '{s}' THEN 1.0 ELSE 0.0 END" for s in SEASON_LEVELS},
}


def f32(expression: str) -> str:
    """As a float32, which all model inputs are, in a double."""
    return f"CAST(CAST({expression} AS FLOAT) AS DOUBLE)"


CTES["labelled"] = f"SELECT * FROM features_raw WHERE {' AND '.join(f'{t} IS NOT NULL' for t in TARGETS)}"
CTES["prepared"] = f"""
    SELECT station_name, date, {aliased({c: f32(f"coalesce(f.{c}, m.{c})") for c in NUMERIC})},
           {aliased({c: f32(e) for c, e in {**FLAGS, **{t: t for t in TARGETS}}.items()})}
    FROM labelled AS f, (SELECT {listed(f'median({c}) AS {c}' for c in NUMERIC)} FROM labelled) AS m"""
PREPARED = [*NUMERIC, *FLAGS, *TARGETS]

STUDIED = [*NUMERIC, *FLAGS]
CTES["studied"] = f"""
    SELECT station_name, date, {aliased({c: f32(FLAGS.get(c, c)) for c in [*STUDIED, SEQUENCE_TARGET]})} FROM features
    WHERE {' AND '.join(f'{c} IS NOT NULL' for c in [*NUMERIC, SEQUENCE_TARGET])}"""
for _name in ("numbered", "starts", "trained", "train_rows"):
    # The same steps over the rows of the sequence study.
    CTES[f"study_{_name}"] = re.sub(r"\b(numbered|starts|trained)\b", r"study_\1", CTES[_name]).replace("targeted", "studied")


def _matrix() -> str:
    return f"SELECT station_name, date, {listed(f'{r6(c, 4)} AS {c}' for c in PREPARED)} FROM prepared"


def _snapshot() -> str:
    kept = {
        "latitude": 38.15, "longitude": 23.55, "wind_speed_u": 0.0, "wind_speed_v": 0.0, "dewpoint_temp": 10.0,
        "soil_temp": 17.0, "total_percipitation": 0.0, "vegetation_high": 1.7, "vegetation_low": 1.5, "temp": 14.0,
        "relative_humidity": 80.0, "pm10": 10.0, "pm2_5": 6.0, "no2": 10.0, "o3": 70.0,
    }
    filled = listed(f"coalesce({c}, {v}) AS {c}" for c, v in kept.items())
    calendar = aliased({c: CALENDAR[c] for c in ("month", "hour", "day_of_week", "is_weekend")})
    columns = {
        "wind_speed": r6(WEATHER_SQL["wind_speed"]),
        "wind_direction": "CAST(0.0 AS DOUBLE)",
        "temp_dewpoint_spread": "temp - dewpoint_temp",
        "temp_soil_diff": "temp - soil_temp",
        "pm10_pm25_ratio": r6("CASE WHEN pm2_5 > 0 THEN pm10 / pm2_5 ELSE 0.0 END"),
        "no2_o3_balance": r6("CASE WHEN o3 > 0 THEN no2 / o3 ELSE 0.0 END"),
    }
    back = {v: k for k, v in SHORT.items()}
    columns |= {c: back[c.split("_")[0]] for c in [*ROLLING, *LAGS]}
    columns |= {f"city_{c}": f"CAST(city = '{c}' AS INTEGER)" for c in CITY_LEVELS}
    columns |= {f"season_{s}": f"CAST({season('month')} = '{s}' AS INTEGER)" for s in SEASON_LEVELS}
    return f"""
        SELECT station_name, date, {listed(kept)}, CAST(2020 AS INTEGER) AS year, month, CAST(15 AS INTEGER) AS day, hour,
               day_of_week, is_weekend, {aliased(columns)}
        FROM (SELECT station_name, date, city, {filled}, {calendar} FROM readings) AS filled"""


def _null_profile() -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM features_raw" for c in ML_COLUMNS
    )
    return f'SELECT * FROM ({counts}) AS profile ORDER BY nulls DESC, "column" LIMIT 20'


def _fill(function: str, columns, table: str, default: str | None = None) -> str:
    stats = listed(f"{function.format(c)} AS {c}" for c in columns)
    tail = "" if default is None else f", {default}"
    filled = listed(f"coalesce(t.{c}, m.{c}{tail}) AS {c}" if c in columns else f"t.{c}" for c in READING_COLUMNS)
    return f"SELECT {filled} FROM readings AS t, (SELECT {stats} FROM readings) AS m"


def _radar(table: str = "long", names=CITY_LEVELS) -> str:
    cities = listed(
        f"{half_up(f'''max(CASE WHEN city = '{c}' THEN value END)''', 1)} AS {c.capitalize()}" for c in names
    )
    label = " ".join(f"WHEN '{m}' THEN '{text}'" for m, text in SUMMARY_MEASURES.items())
    return f"SELECT CASE measure {label} END AS pollutant, {cities} FROM {table} GROUP BY measure"


def _sequences(split: str) -> str:
    """Every sequence's cells, scaled by the training rows, each times the weight of its place (row by row)."""
    numbers, width = [*STUDIED, SEQUENCE_TARGET], len(STUDIED)
    stats = listed(f"avg({c}) AS {c}_m, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS {c}_s" for c in numbers)
    scaled = aliased({c: f32(f"({c} - {c}_m) / {c}_s") for c in numbers})
    cells = listed(f"({j}, {c})" for j, c in enumerate(STUDIED))
    return f"""
        , stats AS (SELECT {stats} FROM study_train_rows),
        scaled AS (SELECT station_name, row_number, {scaled} FROM study_numbered, stats),
        cell AS (SELECT station_name, row_number, j, x FROM scaled, LATERAL (VALUES {cells}) AS c(j, x)),
        digest AS (
            SELECT s.station_name, s.row_number, count(*) AS cells,
                   sum(x * (((c.row_number - s.row_number) * {width} + j + 1) * 7919 % 1009) / 1009.0::DOUBLE) AS digest
            FROM study_starts AS s JOIN cell AS c
            ON c.station_name = s.station_name AND c.row_number BETWEEN s.row_number AND s.row_number + 23 GROUP BY 1, 2)
        SELECT s.station_name, s.date, position, {split} AS split, CAST(cells AS INTEGER) AS cells,
               {r6('digest', 3)} AS digest, {r6(f't.{SEQUENCE_TARGET}', 3)} AS target
        FROM study_starts AS s JOIN digest AS d ON d.station_name = s.station_name AND d.row_number = s.row_number
        JOIN scaled AS t ON t.station_name = s.station_name AND t.row_number = s.row_number + 23"""


def _window_dense() -> str:
    rolling, lags, targets = _windows("date, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice")
    return f"SELECT *, {aliased(rolling, 6)}, {aliased(lags)}, {aliased(targets, 6)} FROM dense"


def _scaled(inverse: bool) -> str:
    if inverse:
        return _matrix()
    stats = listed(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in PREPARED)
    scaled = listed(f"{r6(f'({c} - {c}_m) / CASE WHEN {c}_s = 0 THEN 1.0 ELSE {c}_s END', 4)} AS {c}" for c in PREPARED)
    return f"SELECT station_name, date, {scaled} FROM prepared, (SELECT {stats} FROM prepared) AS s"


def all_sql() -> dict[str, str]:
    all_present = " AND ".join(f"{c} IS NOT NULL" for c in READING_COLUMNS)
    text = "CASE WHEN relative_humidity % 11 = 0 THEN 'not a date' ELSE strftime(date, '%Y-%m-%d %H:%M:%S') END"
    key = "station_name || '|' || strftime(date, '%Y-%m-%d %H:%M:%S')"
    celsius = listed(
        f"{r6(f'CASE WHEN city = {chr(39)}ancona{chr(39)} THEN ({c} - 32.0) * 5.0 / 9.0 ELSE {c} END')} AS {c}"
        for c in TEMPERATURES
    )
    aqi_input = " UNION ALL ".join(
        f"SELECT station_name, date, '{c}' AS measure, {c} AS value FROM readings" for c in [*POLLUTANTS, "temp"]
    )
    split = """CASE WHEN position <= floor(all_starts * CAST(0.70 AS DOUBLE)) THEN 'train'
                    WHEN position <= floor(all_starts * CAST(0.85 AS DOUBLE)) THEN 'val' ELSE 'test' END"""
    flags = [f"CAST(city = '{c}' AS INTEGER) AS city_{c}" for c in CITY_LEVELS]
    flags += [f"CAST({season('month(date)')} = '{s}' AS INTEGER) AS season_{s}" for s in SEASON_LEVELS]
    far_flags = [f"CAST({FAR_CITY} = '{c}' AS INTEGER) AS city_{c}" for c in [*CITY_LEVELS, "porto"]]
    unified = f"SELECT {_rounded(RAW_COLUMNS)} FROM unified"

    bodies = {
        "csv_roundtrip": unified,
        "parquet_roundtrip": "SELECT * FROM readings",
        "catalog_rerun": "SELECT * REPLACE (pm10 + CASE WHEN city = 'ancona' THEN 1 ELSE 0 END AS pm10) FROM readings",
        "read_dataset": "SELECT * FROM readings",
        "rename_columns": f"""
            SELECT {listed(c for c in READING_COLUMNS if c not in (*_VANISHED, 'date'))},
                   {listed(f"CASE WHEN city <> 'zaragoza' THEN {c} END AS {c}" for c in _VANISHED)},
                   strftime(date, '%Y-%m-%d %H:%M:%S') AS date,
                   CASE WHEN city = 'athens' THEN 'C' || substr(station_name, 2) END AS code,
                   CASE WHEN city = 'athens' THEN CAST(substr(station_name, 2) AS INTEGER) END AS id,
                   CASE WHEN city = 'athens' THEN 'unlisted' END AS remark
            FROM readings""",
        "unify_sources": unified,
        "project_canonical": "SELECT * FROM readings",
        "fahrenheit_to_celsius": f"SELECT station_name, date, city, {celsius} FROM readings",
        "parse_timestamp": f"SELECT station_name, {text} AS text, try_cast({text} AS TIMESTAMP) AS date FROM readings",
        "pm25_ratio": f"SELECT {r6('ratio')} AS ratio FROM ({RATIO.format('readings').replace('0.5)', '0.5) AS ratio')}) AS r",
        "impute_pm25": f"""
            SELECT station_name, date, city, pm10,
                   {r6(f'coalesce(pm2_5, pm10 * ({RATIO.format("readings")}))')} AS pm2_5 FROM readings""",
        "drop_all_null": "SELECT * FROM readings WHERE coalesce(pm10, pm2_5, no2, o3) IS NOT NULL",
        "column_medians": f"SELECT {listed(f'quantile_disc({c}, 0.5) AS {c}' for c in IMPUTED)} FROM readings",
        "column_medians_dense": "SELECT "
        + listed(f"quantile_disc({c}, 0.5) AS {c}" for c in [*POLLUTANTS, "l_extendedprice"])
        + " FROM dense",
        "median_impute": _fill("quantile_disc({0}, 0.5)", IMPUTED, "readings", "0.0"),
        "exact_median_fill": _fill("median({0})", ["latitude", "longitude", *WEATHER, *POLLUTANTS], "readings"),
        "load_and_unify": f"SELECT {_rounded(RAW_COLUMNS)} FROM cleaned",
        "temporal_features": f"SELECT station_name, date, {aliased(CALENDAR)} FROM readings",
        "weather_features": f"SELECT station_name, date, {aliased(WEATHER_SQL, 6)} FROM readings",
        "pollutant_ratios": f"SELECT station_name, date, {aliased(RATIO_SQL, 6)} FROM readings",
        "rolling_24": f"SELECT station_name, date, {listed(POLLUTANTS)}, {aliased(ROLLING_SQL, 6)} FROM readings",
        "lag_features": f"SELECT station_name, date, {listed(POLLUTANTS)}, {aliased(LAG_SQL)} FROM readings",
        "targets_24": f"SELECT station_name, date, {listed(POLLUTANTS)}, {aliased(TARGET_SQL, 6)} FROM readings",
        "window_features_dense": _window_dense(),
        "drop_nulls": f"SELECT * FROM readings WHERE {all_present}",
        "drop_accounting": f"""
            SELECT rows_before, rows_after, rows_before - rows_after AS rows_dropped,
                   {r6('CASE WHEN rows_before > 0 THEN (rows_before - rows_after) * 100.0 / rows_before ELSE 0.0 END')}
                   AS percent_dropped
            FROM (SELECT count(*) AS rows_before, count(*) FILTER (WHERE {all_present}) AS rows_after FROM readings) AS c""",
        "build_ml_dataset": f"SELECT {_rounded(ML_COLUMNS)} FROM ml",
        "city_summary": "SELECT * FROM summary",
        "city_summary_added": "SELECT * FROM summary",
        "capitalize_city": "SELECT * REPLACE (upper(substr(city, 1, 1)) || substr(city, 2) AS city) FROM summary",
        "select_measures": "SELECT * FROM long WHERE measure IN ('avg_pm10', 'avg_o3')",
        "cross_city_stats": f"""
            SELECT measure, {r6('avg(value)')} AS mean, {r6('greatest(max(value), 1.0)')} AS max
            FROM long GROUP BY measure""",
        "cross_city_share": f"""
            SELECT a.city, a.measure, {r6('a.value')} AS value, {r6('a.value / m.largest * 100')} AS share
            FROM long_all AS a
            JOIN (SELECT measure, greatest(max(value), 1.0) AS largest FROM long GROUP BY measure) AS m USING (measure)""",
        "summary_aqi": f"SELECT * REPLACE ({r6('value')} AS value) FROM ({_classified('city, measure, value', 'long_all')}) AS a",
        "radar_pivot": _radar(),
        "aqi_classify": _classified("station_name, date, measure, value", f"({aqi_input}) AS v"),
        "null_profile": _null_profile(),
        "dataset_profile": f"""
            SELECT count(*) AS rows, count(DISTINCT station_name) AS stations, min(date) AS first_date,
                   max(date) AS last_date, CAST({len(READING_COLUMNS)} AS INTEGER) AS columns FROM readings""",
        "preview": f"SELECT {_rounded(RAW_COLUMNS)} FROM cleaned ORDER BY station_name, date LIMIT 10",
        "drop_null_targets": f"""
            SELECT * FROM (SELECT station_name, date, {aliased(TARGET_SQL, 6)} FROM readings) AS t
            WHERE {' AND '.join(f'{t} IS NOT NULL' for t in TARGETS)}""",
        "one_hot": f"SELECT station_name, date, {listed(flags)} FROM readings",
        "model_matrix": _matrix(),
        "finite_only": "SELECT station_name, date, temp, CASE WHEN isfinite(x) THEN x END AS x FROM special",
        "drop_accounting_special": f"""
            SELECT rows_before, rows_after, rows_before - rows_after AS rows_dropped,
                   {r6('CASE WHEN rows_before > 0 THEN (rows_before - rows_after) * 100.0 / rows_before ELSE 0.0 END')}
                   AS percent_dropped
            FROM (SELECT count(*) AS rows_before,
                         count(*) FILTER (WHERE x IS NOT NULL AND NOT isnan(x) AND temp IS NOT NULL) AS rows_after
                  FROM special) AS c""",
        "null_counts_special": """
            SELECT count(*) - count(station_name) AS station_name, count(*) - count(date) AS date,
                   count(*) - count(temp) AS temp, count(*) FILTER (WHERE x IS NULL OR isnan(x)) AS x FROM special""",
        "exact_median_fill_special": """
            SELECT station_name, date, coalesce(temp, mt) AS temp,
                   coalesce(CASE WHEN NOT isnan(x) THEN x END, mx) AS x
            FROM special, (SELECT median(temp) AS mt, median(x) FILTER (WHERE NOT isnan(x)) AS mx FROM special) AS m""",
        "radar_pivot_other_city": _radar("far_long", [*CITY_LEVELS, "porto"]),
        "one_hot_other_city": f"SELECT station_name, date, {listed([*far_flags, *flags[len(CITY_LEVELS):]])} FROM readings",
        "column_medians_bracketed": "SELECT "
        + listed(f"quantile_disc({c}, 0.5) AS {c}" for c in [*POLLUTANTS, "l_extendedprice"])
        + " FROM dense",
        "window_features_cut": _window_dense(),
        "finite_check": """
            SELECT bool_and(coalesce(isfinite(temp), false)) AS temp, bool_and(coalesce(isfinite(x), false)) AS x
            FROM special""",
        "scaler_fit": _fit(PREPARED, "prepared"),
        "standard_scale": _scaled(False),
        "inverse_scale": _scaled(True),
        "hash_split": f"""
            SELECT station_name, date, CASE WHEN CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % 5 = 0
                   THEN 'validation' ELSE 'train' END AS split FROM readings""",
        "snapshot_features": _snapshot(),
        "sequence_starts": "SELECT station_name, date, row_number, station_rows FROM starts",
        "sequences": _sequences(split),
        "ordered_split": f"SELECT station_name, date, row_number, station_rows, position, {split} AS split FROM starts",
        "train_rows": "SELECT station_name, date FROM train_rows",
        "scaler_fit_train": _fit([*STUDIED, SEQUENCE_TARGET], "study_train_rows"),
        "regression_metrics": _metric_rows("target", NAIVE),
        "model_comparison": _metric_rows("model", {m: (SEQUENCE_TARGET, p) for m, p in NAIVE_MODELS.items()}),
    }
    return {name: sql(body) for name, body in bodies.items()}
