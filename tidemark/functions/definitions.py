"""Definitions of the dialect's scalar functions as SQL expressions.

Spark inlines them; periods and units are literals, so the CASE folds away and
what is left is a built-in function inside code generation.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# ISO periods with a calendar unit of their own.
_CALENDAR = {"PT1S": "SECOND", "PT1M": "MINUTE", "PT1H": "HOUR", "P1D": "DAY", "P1W": "WEEK", "P1M": "MONTH", "P3M": "QUARTER", "P1Y": "YEAR"}

#: Units of TIME_EXTRACT and Spark's names for them; EPOCH counts seconds, whatever the zone.
EXTRACT_UNITS = {
    "EPOCH": "", "SECOND": "SECOND", "MINUTE": "MINUTE", "HOUR": "HOUR", "DAY": "DAY", "DOW": "DAYOFWEEK_ISO", "DOY": "DOY", "WEEK": "WEEK",
    "MONTH": "MONTH", "QUARTER": "QUARTER", "YEAR": "YEAR",
}


def _period_millis(p: str) -> str:
    """SQL for the milliseconds of a period of days and smaller units."""
    part = lambda pattern, ms: f"coalesce(try_cast(nullif(regexp_extract({p}, '{pattern}', 1), '') AS BIGINT), 0L) * {ms}L"
    return "(" + " + ".join([part(r"([0-9]+)W", 604800000), part(r"([0-9]+)D", 86400000), part(r"([0-9]+)H", 3600000), part(r"T[0-9H]*?([0-9]+)M", 60000), part(r"([0-9]+)S", 1000)]) + ")"


def _period_months(p: str) -> str:
    part = lambda pattern, n: f"coalesce(try_cast(nullif(regexp_extract({p}, '{pattern}', 1), '') AS INT), 0) * {n}"
    return "(" + part(r"^P([0-9]+)Y", 12) + " + " + part(r"^P(?:[0-9]+Y)?([0-9]+)M", 1) + ")"


def definitions() -> dict[str, str]:
    """Name with parameters and type -> SQL body."""
    floor = " ".join(f"WHEN '{p}' THEN date_trunc('{u}', t)" for p, u in _CALENDAR.items())
    months, millis = _period_months("p"), _period_millis("p")
    months_floor = f"timestampadd(MONTH, CAST((year(t) * 12 + month(t) - 1 - 23640) - pmod(year(t) * 12 + month(t) - 1 - 23640, {months}) AS INT), TIMESTAMP '1970-01-01 00:00:00')"
    other = f"CASE WHEN {months} > 0 THEN {months_floor} ELSE timestamp_millis(unix_millis(t) - pmod(unix_millis(t), {millis})) END"
    extract = " ".join(f"WHEN '{u}' THEN CAST(extract({x} FROM t) AS BIGINT)" for u, x in EXTRACT_UNITS.items() if x)
    shifted = f"(t + make_interval(0, CAST(n * {months} AS INT)) + make_dt_interval(0, 0, 0, CAST(n * {millis} AS DECIMAL(18,6)) / 1000))"
    # the same on the clock of a zone, and counted from an origin
    local, start = "from_utc_timestamp(t, tz)", "from_utc_timestamp(o, tz)"
    apart = f"(year({local}) * 12 + month({local}) - year({start}) * 12 - month({start}))"
    # months that are full: the last one is not if the rest of the date comes before the origin's
    full = f"({apart} - CAST(timestampadd(MONTH, {apart}, {start}) > {local} AS INT))"
    months_at = f"timestampadd(MONTH, CAST({full} - pmod({full}, {months}) AS INT), {start})"
    millis_at = f"timestamp_millis(unix_millis({local}) - pmod(unix_millis({local}) - unix_millis({start}), {millis}))"
    floor_at = f"to_utc_timestamp(CASE WHEN o IS NULL THEN time_floor({local}, p) WHEN {months} > 0 THEN {months_at} ELSE {millis_at} END, tz)"
    iso = "coalesce(try_to_timestamp(s), try_to_timestamp(s, 'yyyy-MM-dd''T''HH:mm:ss''Z'''))"
    return {
        "time_floor(t TIMESTAMP, p STRING) RETURNS TIMESTAMP": f"CASE p {floor} ELSE {other} END",
        "time_shift(t TIMESTAMP, p STRING, n INT) RETURNS TIMESTAMP": shifted,
        "time_ceil(t TIMESTAMP, p STRING) RETURNS TIMESTAMP": "CASE WHEN time_floor(t, p) = t THEN t ELSE time_shift(time_floor(t, p), p, 1) END",
        "time_floor_at(t TIMESTAMP, p STRING, o TIMESTAMP, tz STRING) RETURNS TIMESTAMP": floor_at,
        "time_shift_at(t TIMESTAMP, p STRING, n INT, tz STRING) RETURNS TIMESTAMP": f"to_utc_timestamp(time_shift({local}, p, n), tz)",
        "time_ceil_at(t TIMESTAMP, p STRING, o TIMESTAMP, tz STRING) RETURNS TIMESTAMP": "CASE WHEN time_floor_at(t, p, o, tz) = t THEN t ELSE time_shift_at(time_floor_at(t, p, o, tz), p, 1, tz) END",
        "time_extract(t TIMESTAMP, u STRING, tz STRING DEFAULT 'UTC') RETURNS BIGINT": f"CASE upper(u) {extract.replace('FROM t)', 'FROM from_utc_timestamp(t, tz))')} WHEN 'EPOCH' THEN unix_seconds(t) END",
        "time_format(t TIMESTAMP, f STRING DEFAULT 'yyyy-MM-dd''T''HH:mm:ss.SSS''Z''', tz STRING DEFAULT 'UTC') RETURNS STRING": "date_format(from_utc_timestamp(t, tz), f)",
        "time_parse(s STRING, f STRING DEFAULT '', tz STRING DEFAULT 'UTC') RETURNS TIMESTAMP": f"to_utc_timestamp(CASE WHEN f = '' THEN {iso} ELSE try_to_timestamp(s, nullif(f, '')) END, tz)",
        "millis_to_timestamp(ms BIGINT) RETURNS TIMESTAMP": "timestamp_millis(ms)",
        "timestamp_to_millis(t TIMESTAMP) RETURNS BIGINT": "unix_millis(t)",
        "safe_divide(a DOUBLE, b DOUBLE) RETURNS DOUBLE": "try_divide(a, b)",
        "starts_with(s STRING, p STRING) RETURNS BOOLEAN": "startswith(s, p)",
        "mv_contains(v ARRAY<STRING>, x STRING) RETURNS BOOLEAN": "array_contains(v, x)",
        "mv_contains_all(v ARRAY<STRING>, x ARRAY<STRING>) RETURNS BOOLEAN": "size(array_except(x, v)) = 0",
        "mv_overlap(v ARRAY<STRING>, x ARRAY<STRING>) RETURNS BOOLEAN": "arrays_overlap(v, x)",
        "mv_length(v ARRAY<STRING>) RETURNS BIGINT": "CAST(size(v) AS BIGINT)",
        "mv_offset(v ARRAY<STRING>, i INT) RETURNS STRING": "get(v, i)",
        "mv_ordinal(v ARRAY<STRING>, i INT) RETURNS STRING": "get(v, i - 1)",
        "mv_offset_of(v ARRAY<STRING>, x STRING) RETURNS BIGINT": "array_position(v, x) - 1",
        "mv_ordinal_of(v ARRAY<STRING>, x STRING) RETURNS BIGINT": "CASE WHEN array_position(v, x) = 0 THEN -1 ELSE array_position(v, x) END",
        "json_scalar(v VARIANT, path STRING) RETURNS STRING": "CASE schema_of_variant(try_variant_get(v, path, 'variant')) WHEN 'BOOLEAN' THEN CASE try_variant_get(v, path, 'string') WHEN 'true' THEN '1' ELSE '0' END ELSE try_variant_get(v, path, 'string') END",
    }


def install(spark: SparkSession) -> None:
    """Create all functions in the session."""
    for head, body in definitions().items():
        signature, _, kind = head.partition(" RETURNS ")
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
