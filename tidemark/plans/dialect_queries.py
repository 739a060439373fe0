"""Dialect queries over the driver's tables, each with the SQL of its oracle.

A query is (name, dialect SQL, DuckDB SQL); the as-of time is fixed, so that
windows that end now mean the same in any run.
"""

AS_OF = "2024-01-31 00:00:00"
_NOW = f"TIMESTAMP '{AS_OF}'"

#: name -> (dialect, oracle)
SQL: dict[str, tuple[str, str]] = {}


def _add(name: str, dialect: str, oracle: str) -> None:
    SQL[name] = (dialect, oracle)


# time buckets -----------------------------------------------------------------
_add("time_floor_day", """SELECT TIME_FLOOR(__time, 'P1D') AS "day", COUNT(*) AS "record_count" FROM events GROUP BY 1 ORDER BY 1""",
     "SELECT date_trunc('day', ts) AS day, count(*) AS record_count FROM events GROUP BY 1")
for _name, _period, _unit in (("hour", "PT1H", "hour"), ("week", "P1W", "week"), ("month", "P1M", "month"), ("quarter", "P3M", "quarter"), ("year", "P1Y", "year")):
    _add(f"time_floor_{_name}", f"""SELECT TIME_FLOOR(__time, '{_period}') AS "bucket", COUNT(*) AS "n", SUM(o_custkey) AS "keys" FROM orders GROUP BY 1""",
         f"SELECT date_trunc('{_unit}', o_orderdate)::TIMESTAMP AS bucket, count(*) AS n, sum(o_custkey)::BIGINT AS keys FROM orders GROUP BY 1")
for _name, _period, _interval in (("5_minutes", "PT5M", "5 minutes"), ("15_minutes", "PT15M", "15 minutes"), ("6_hours", "PT6H", "6 hours")):
    _add(f"time_floor_{_name}", f"""SELECT TIME_FLOOR(__time, '{_period}') AS "bucket", COUNT(*) AS "n" FROM events GROUP BY 1""",
         f"SELECT time_bucket(INTERVAL '{_interval}', ts, TIMESTAMP '1970-01-01') AS bucket, count(*) AS n FROM events GROUP BY 1")
_add("time_floor_by_dimension", """SELECT TIME_FLOOR(__time, 'P1D') AS "day", event_type AS "kind", COUNT(*) AS "n", MAX("value") AS "top" FROM events WHERE __time >= CURRENT_TIMESTAMP - INTERVAL '14' DAY GROUP BY 1, 2""",
     f"SELECT date_trunc('day', ts) AS day, event_type AS kind, count(*) AS n, max(value) AS top FROM events WHERE ts >= {_NOW} - INTERVAL 14 DAY GROUP BY 1, 2")
_add("time_ceil_hour", """SELECT TIME_CEIL(__time, 'PT1H') AS "hour_ending", COUNT(*) AS "n" FROM events GROUP BY 1""",
     "SELECT CASE WHEN date_trunc('hour', ts) = ts THEN ts ELSE date_trunc('hour', ts) + INTERVAL 1 HOUR END AS hour_ending, count(*) AS n FROM events GROUP BY 1")
_add("time_shift_month", """SELECT TIME_SHIFT(__time, 'P1M', -1) AS "before", COUNT(*) AS "n" FROM orders GROUP BY 1""",
     "SELECT o_orderdate - INTERVAL 1 MONTH AS before, count(*) AS n FROM orders GROUP BY 1")
_add("time_shift_days_window", """SELECT COUNT(*) AS "n" FROM events WHERE __time >= TIME_SHIFT(CURRENT_TIMESTAMP, 'P1D', -7) AND __time < CURRENT_TIMESTAMP""",
     f"SELECT count(*) AS n FROM events WHERE ts >= {_NOW} - INTERVAL 7 DAY AND ts < {_NOW}")
_add("time_extract_hour", """SELECT TIME_EXTRACT(__time, 'HOUR') AS "hour", COUNT(*) AS "n" FROM events GROUP BY 1""", "SELECT extract(hour FROM ts) AS hour, count(*) AS n FROM events GROUP BY 1")
_add("time_extract_weekday", """SELECT TIME_EXTRACT(__time, 'DOW') AS "weekday", TIME_EXTRACT(__time, 'MONTH') AS "month", COUNT(*) AS "n" FROM orders GROUP BY 1, 2""",
     "SELECT isodow(o_orderdate) AS weekday, month(o_orderdate) AS month, count(*) AS n FROM orders GROUP BY 1, 2")
_add("time_extract_zone", """SELECT TIME_EXTRACT(__time, 'HOUR', 'Asia/Tokyo') AS "hour", COUNT(*) AS "n" FROM events GROUP BY 1""", "SELECT extract(hour FROM ts + INTERVAL 9 HOUR) AS hour, count(*) AS n FROM events GROUP BY 1")
_add("time_format_month", """SELECT TIME_FORMAT(__time, 'yyyy-MM') AS "month", COUNT(*) AS "n" FROM orders GROUP BY 1""", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1")
_add("time_format_names", """SELECT TIME_FORMAT(__time, 'EEEE') AS "weekday", TIME_FORMAT(__time, 'MMMM') AS "month", COUNT(*) AS "n" FROM orders GROUP BY 1, 2""",
     "SELECT dayname(o_orderdate) AS weekday, monthname(o_orderdate) AS month, count(*) AS n FROM orders GROUP BY 1, 2")
_add("time_parse_encodings", """SELECT TIME_FLOOR(TIME_PARSE(s_space, 'yyyy-MM-dd HH:mm:ss'), 'P1M') AS "a", TIME_FLOOR(TIME_PARSE(s_iso), 'P1M') AS "b", TIME_FLOOR(TIME_PARSE(s_date, 'yyyy-MM-dd'), 'P1M') AS "c", TIME_FLOOR(TIME_PARSE(s_dmy, 'dd/MM/yyyy'), 'P1M') AS "d", COUNT(*) AS "n" FROM encoded GROUP BY 1, 2, 3, 4""",
     "SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS a, date_trunc('month', o_orderdate)::TIMESTAMP AS b, date_trunc('month', o_orderdate)::TIMESTAMP AS c, date_trunc('month', o_orderdate)::TIMESTAMP AS d, count(*) AS n FROM orders GROUP BY 1")
_add("cast_text_to_timestamp", """SELECT TIME_FLOOR(CAST(s_space AS TIMESTAMP), 'P1Y') AS "y", COUNT(DISTINCT CAST(__time AS DATE)) AS "days" FROM encoded GROUP BY 1""",
     "SELECT date_trunc('year', o_orderdate)::TIMESTAMP AS y, count(DISTINCT o_orderdate::DATE) AS days FROM orders GROUP BY 1")
_add("millis_to_timestamp", """SELECT TIME_FLOOR(MILLIS_TO_TIMESTAMP(e_ms), 'P1D') AS "day", COUNT(*) AS "n" FROM encoded WHERE MILLIS_TO_TIMESTAMP(e_s * 1000) >= TIMESTAMP '2000-01-01' GROUP BY 1""",
     "SELECT date_trunc('day', o_orderdate)::TIMESTAMP AS day, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' GROUP BY 1")
_add("timestamp_to_millis", """SELECT event_type, MAX(TIMESTAMP_TO_MILLIS(__time)) AS "last_ms" FROM events GROUP BY 1""", "SELECT event_type, max(epoch_us(ts) // 1000) AS last_ms FROM events GROUP BY 1")
_add("epoch_pair_duration", """SELECT o_orderpriority, AVG((s_end - e_ms) / 1000.0) AS "secs" FROM encoded WHERE s_end IS NOT NULL GROUP BY 1""",
     "SELECT o_orderpriority, avg(o_orderkey % 100 * 60.0) AS secs FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY 1")
_add("date_trunc_week", """SELECT DATE_TRUNC('week', __time) AS "week", COUNT(*) AS "n" FROM events GROUP BY 1""", "SELECT date_trunc('week', ts)::TIMESTAMP AS week, count(*) AS n FROM events GROUP BY 1")
_add("floor_to_hour", """SELECT FLOOR(__time TO HOUR) AS "hour", COUNT(*) AS "n" FROM events GROUP BY FLOOR(__time TO HOUR)""", "SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1")
_add("extract_year", """SELECT EXTRACT(YEAR FROM __time) AS "y", COUNT(*) AS "n" FROM orders GROUP BY 1""", "SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1")
_add("timestampadd", """SELECT COUNT(*) AS "n" FROM events WHERE __time >= TIMESTAMPADD(DAY, -7, TIMESTAMP '2024-01-20')""", "SELECT count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-13'")
_add("timestampdiff", """SELECT TIMESTAMPDIFF(DAY, o.__time, l.__time) AS "days", COUNT(*) AS "n" FROM lineitem l INNER JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1""",
     "SELECT datesub('day', o_orderdate, l_shipdate) AS days, count(*) AS n FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey GROUP BY 1")
_add("time_in_interval", """SELECT COUNT(*) AS "n" FROM events WHERE TIME_IN_INTERVAL(__time, '2024-01-05/2024-01-12T12:00:00Z')""", "SELECT count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12 12:00:00'")
_add("implicit_text_time", """SELECT COUNT(*) AS "n" FROM events WHERE __time >= '2024-01-15'""", "SELECT count(*) AS n FROM events WHERE ts >= '2024-01-15'")
# scans, filters ------------------------------------------------------------------
_add("scan_by_time", """SELECT __time, event_id, event_type FROM events ORDER BY __time DESC LIMIT 20""", "SELECT ts AS __time, event_id, event_type FROM events ORDER BY ts DESC LIMIT 20")
_add("filter_in_not_in", """SELECT event_type, COUNT(*) AS "n" FROM events WHERE event_type IN ('click', 'view', 'purchase') AND user_id NOT IN (1, 2, 3) GROUP BY 1;""",
     "SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('click', 'view', 'purchase') AND user_id NOT IN (1, 2, 3) GROUP BY 1")
_add("filter_like", """SELECT COUNT(*) AS "n" FROM part WHERE p_name LIKE 'red%' OR p_name LIKE '%ring' OR p_brand LIKE '%#1%'""", "SELECT count(*) AS n FROM part WHERE p_name LIKE 'red%' OR p_name LIKE '%ring' OR p_brand LIKE '%#1%'")
_add("filter_regexp", """SELECT p_brand, COUNT(*) AS "n" FROM part WHERE REGEXP_LIKE(p_brand, '#(1|2)[0-9]$') GROUP BY 1""", "SELECT p_brand, count(*) AS n FROM part WHERE regexp_matches(p_brand, '#(1|2)[0-9]$') GROUP BY 1")
_add("filter_logic_nulls", """SELECT COUNT(*) AS "n", COUNT(s_end) AS "ended" FROM encoded WHERE NOT (o_orderstatus = 'F' AND s_end IS NULL) OR o_totalprice / 100.0 > 2500""",
     "SELECT count(*) AS n, count(CASE WHEN o_orderkey % 7 <> 0 THEN 1 END) AS ended FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderkey % 7 = 0) OR o_totalprice / 100.0 > 2500")
_add("filter_between", """SELECT COUNT(*) AS "n" FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag <> l_linestatus""", "SELECT count(*) AS n FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag <> l_linestatus")
_add("in_subquery", """SELECT COUNT(*) AS "n" FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""", "SELECT count(*) AS n FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
_add("correlated_scalar", """SELECT o_orderkey FROM orders o WHERE o_totalprice > (SELECT 1.9 * AVG(i.o_totalprice) FROM orders i WHERE i.o_orderpriority = o.o_orderpriority)""",
     "SELECT o_orderkey FROM orders o WHERE o_totalprice > (SELECT 1.9 * avg(i.o_totalprice) FROM orders i WHERE i.o_orderpriority = o.o_orderpriority)")
_add("exists_subquery", """SELECT COUNT(*) AS "n" FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')""",
     "SELECT count(*) AS n FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')")
# aggregates ---------------------------------------------------------------------
_add("aggregates_all", """SELECT event_type, COUNT(*) AS "n", COUNT(DISTINCT user_id) AS "users", SUM(event_id) AS "s", MIN("value") AS "lo", MAX("value") AS "hi", MIN(__time) AS "first_at", MAX(__time) AS "last_at" FROM events GROUP BY 1""",
     "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, sum(event_id)::BIGINT AS s, min(value) AS lo, max(value) AS hi, min(ts) AS first_at, max(ts) AS last_at FROM events GROUP BY 1")
_add("avg_rounded", """SELECT l_returnflag, l_linestatus, ROUND(AVG(l_quantity), 4) AS "q", ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS "net" FROM lineitem GROUP BY 1, 2""",
     "SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 4) AS q, round(sum(l_extendedprice * (1 - l_discount)), 2) AS net FROM lineitem GROUP BY 1, 2")
_add("quantile_sketch", """SELECT event_type, APPROX_QUANTILE_DS("value", 0.5) AS "p50", APPROX_QUANTILE_DS("value", 0.95) AS "p95", APPROX_QUANTILE("value", 0.99) AS "p99" FROM events GROUP BY 1""",
     "SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99 FROM events GROUP BY 1")
_add("approx_distinct_close", """SELECT event_type, ABS(APPROX_COUNT_DISTINCT(user_id) - COUNT(DISTINCT user_id)) <= 0.1 * COUNT(DISTINCT user_id) AS "close" FROM events GROUP BY 1""", "SELECT event_type, true AS close FROM events GROUP BY 1")
_add("latest_earliest", """SELECT event_type, LATEST("value") AS "last_value", EARLIEST(user_id) AS "first_user", LATEST(props, 7) AS "last_props" FROM events GROUP BY 1""",
     "SELECT event_type, arg_max(value, ts) AS last_value, arg_min(user_id, ts) AS first_user, left(arg_max(props, ts), 7) AS last_props FROM events GROUP BY 1")
_add("latest_by", """SELECT user_id, LATEST_BY(event_type, __time, 64) AS "kind", EARLIEST_BY("value", __time) AS "v" FROM events GROUP BY 1""", "SELECT user_id, arg_max(event_type, ts) AS kind, arg_min(value, ts) AS v FROM events GROUP BY 1")
_add("filtered_aggregates", """SELECT TIME_FLOOR(__time, 'P1D') AS "day", COUNT(*) FILTER (WHERE event_type = 'error') AS "errors", MAX("value") FILTER (WHERE event_type = 'purchase') AS "top", 100.0 * COUNT(*) FILTER (WHERE event_type = 'error') / COUNT(*) AS "pct" FROM events GROUP BY 1""",
     "SELECT date_trunc('day', ts) AS day, count(*) FILTER (event_type = 'error') AS errors, max(value) FILTER (event_type = 'purchase') AS top, 100.0 * count(*) FILTER (event_type = 'error') / count(*) AS pct FROM events GROUP BY 1")
_add("conditional_aggregates", """SELECT o_orderpriority, SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS "f", SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) * 1.0 / COUNT(*) AS "share" FROM orders GROUP BY 1""",
     "SELECT o_orderpriority, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS f, (sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::DOUBLE / count(*)) AS share FROM orders GROUP BY 1")
_add("integer_division", """SELECT user_id, SUM(event_id) / COUNT(*) AS "whole", MAX(event_id) / 7 AS "sevenths", SUM(event_id) * 1.0 / 4 AS "exact" FROM events GROUP BY 1""",
     "SELECT user_id, (sum(event_id) // count(*))::BIGINT AS whole, max(event_id) // 7 AS sevenths, (sum(event_id)::DOUBLE / 4) AS exact FROM events GROUP BY 1")
_add("safe_division", """SELECT event_id, SAFE_DIVIDE("value", user_id - 5) AS "d", CAST(NULLIF(user_id, 5) AS DOUBLE) AS "u", COALESCE(NULLIF(user_id, 5), -1) AS "c", NVL(NULLIF(user_id, 5), 0) AS "v", IFNULL(NULLIF(user_id, 5), 1) AS "i" FROM events""",
     "SELECT event_id, CASE WHEN user_id = 5 THEN NULL ELSE value / (user_id - 5) END AS d, nullif(user_id, 5)::DOUBLE AS u, coalesce(nullif(user_id, 5), -1) AS c, coalesce(nullif(user_id, 5), 0) AS v, coalesce(nullif(user_id, 5), 1) AS i FROM events")
_add("avg_nullif", """SELECT event_type, ROUND(AVG(NULLIF(user_id, 0)), 6) AS "a" FROM events GROUP BY 1""", "SELECT event_type, round(avg(nullif(user_id, 0)), 6) AS a FROM events GROUP BY 1")
_add("having_alias", """SELECT user_id, COUNT(*) AS "n", COUNT(DISTINCT event_type) AS "kinds" FROM events GROUP BY 1 HAVING "n" > 60 AND COUNT(DISTINCT event_type) >= 5 ORDER BY "n" DESC""",
     "SELECT user_id, count(*) AS n, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1 HAVING count(*) > 60 AND count(DISTINCT event_type) >= 5")
_add("having_filtered", """SELECT user_id FROM events GROUP BY user_id HAVING COUNT(*) FILTER (WHERE event_type = 'click') > COUNT(*) FILTER (WHERE event_type = 'error')""",
     "SELECT user_id FROM events GROUP BY user_id HAVING count(*) FILTER (event_type = 'click') > count(*) FILTER (event_type = 'error')")
_add("grouping_sets", """SELECT l_returnflag, l_linestatus, COUNT(*) AS "n" FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())""", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())")
_add("rollup", """SELECT l_returnflag, l_linestatus, COUNT(*) AS "n" FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
_add("cube", """SELECT o_orderstatus, o_orderpriority, COUNT(*) AS "n" FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
_add("two_level_aggregate", """SELECT MAX("n") AS "busiest", MIN("n") AS "calmest" FROM (SELECT TIME_FLOOR(__time, 'P1D') AS "day", COUNT(*) AS "n" FROM events GROUP BY 1)""",
     "SELECT max(n) AS busiest, min(n) AS calmest FROM (SELECT date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1)")
_add("aggregate_arithmetic", """SELECT event_type, MAX("value") - MIN("value") AS "spread", ROUND(SUM("value") / (COUNT(*) / 60.0), 1) AS "per_hour" FROM events GROUP BY 1""",
     "SELECT event_type, max(value) - min(value) AS spread, round(sum(value) / (count(*) / 60.0), 1) AS per_hour FROM events GROUP BY 1")
_add("period_as_rows", """SELECT CASE WHEN __time >= CURRENT_TIMESTAMP - INTERVAL '7' DAY THEN 'this week' ELSE 'last week' END AS "period", COUNT(*) AS "n" FROM events WHERE __time >= CURRENT_TIMESTAMP - INTERVAL '14' DAY GROUP BY 1""",
     f"SELECT CASE WHEN ts >= {_NOW} - INTERVAL 7 DAY THEN 'this week' ELSE 'last week' END AS period, count(*) AS n FROM events WHERE ts >= {_NOW} - INTERVAL 14 DAY GROUP BY 1")
# joins --------------------------------------------------------------------------
_add("join_inner_grouped", """SELECT c.c_mktsegment AS "segment", COUNT(*) AS "n", ROUND(SUM(o.o_totalprice), 2) AS "total" FROM orders o INNER JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1""",
     "SELECT c_mktsegment AS segment, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
_add("join_top_n", """SELECT n.n_name AS "nation", COUNT(*) AS "n" FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
     "SELECT n_name AS nation, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
_add("join_left_unmatched", """SELECT COUNT(*) AS "n", COUNT(o.o_orderkey) AS "matched" FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey AND o.o_orderstatus = 'P'""",
     "SELECT count(*) AS n, count(o_orderkey) AS matched FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P'")
_add("join_right", """SELECT c.c_mktsegment AS "segment", COUNT(o.o_orderkey) AS "n" FROM orders o RIGHT JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1""", "SELECT c_mktsegment AS segment, count(o_orderkey) AS n FROM orders RIGHT JOIN customer ON o_custkey = c_custkey GROUP BY 1")
_add("join_full", """SELECT COUNT(*) AS "n", COUNT(s.s_suppkey) AS "s", COUNT(c.c_custkey) AS "c" FROM supplier s FULL OUTER JOIN customer c ON s.s_suppkey = c.c_custkey""", "SELECT count(*) AS n, count(s_suppkey) AS s, count(c_custkey) AS c FROM supplier FULL JOIN customer ON s_suppkey = c_custkey")
_add("join_non_equi", """SELECT r.r_name AS "region", COUNT(*) AS "n" FROM region r JOIN nation n ON n.n_nationkey < r.r_regionkey * 5 GROUP BY 1""", "SELECT r_name AS region, count(*) AS n FROM region JOIN nation ON n_nationkey < r_regionkey * 5 GROUP BY 1")
_add("join_filter_dimension", """SELECT COUNT(*) AS "n" FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE p.p_size > 25 AND p.p_type = 'ECONOMY'""", "SELECT count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 25 AND p_type = 'ECONOMY'")
_add("join_time_bucket", """SELECT TIME_FLOOR(o.__time, 'P1Y') AS "year", c.c_mktsegment AS "segment", COUNT(*) AS "n" FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2""",
     "SELECT date_trunc('year', o_orderdate)::TIMESTAMP AS year, c_mktsegment AS segment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2")
_add("join_cross", """SELECT COUNT(*) AS "n" FROM region CROSS JOIN nation""", "SELECT count(*) AS n FROM region CROSS JOIN nation")
_add("join_anti", """SELECT c.c_custkey FROM customer c LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) o ON c.c_custkey = o.o_custkey WHERE o.o_custkey IS NULL ORDER BY c.c_custkey""",
     "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
_add("lookup", """SELECT LOOKUP(event_type, 'kinds') AS "kind", COUNT(*) AS "n" FROM events GROUP BY 1""", "SELECT CASE event_type WHEN 'click' THEN 'Click' WHEN 'error' THEN 'Error' END AS kind, count(*) AS n FROM events GROUP BY 1")
_add("lookup_default", """SELECT LOOKUP(event_type, 'kinds', 'other') AS "kind", COUNT(*) AS "n" FROM events WHERE LOOKUP(event_type, 'kinds') IS NULL OR event_type = 'click' GROUP BY 1""",
     "SELECT CASE event_type WHEN 'click' THEN 'Click' ELSE 'other' END AS kind, count(*) AS n FROM events WHERE event_type NOT IN ('error') GROUP BY 1")
# windows, sorting, sets ------------------------------------------------------------
_add("window_top_per_group", """SELECT "kind", "user", "n" FROM (SELECT event_type AS "kind", user_id AS "user", COUNT(*) AS "n", ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY COUNT(*) DESC, user_id) AS "rn" FROM events GROUP BY 1, 2) WHERE "rn" <= 3""",
     "SELECT event_type AS kind, user_id AS user, n FROM (SELECT event_type, user_id, count(*) AS n, row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, user_id) AS rn FROM events GROUP BY 1, 2) WHERE rn <= 3")
_add("window_rank_share", """SELECT event_type AS "kind", COUNT(*) AS "n", RANK() OVER (ORDER BY COUNT(*) DESC) AS "place", ROUND(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (), 4) AS "pct" FROM events GROUP BY 1""",
     "SELECT event_type AS kind, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS place, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM events GROUP BY 1")
_add("window_lag_frames", """SELECT "day", "n", COALESCE(LAG("n") OVER (ORDER BY "day"), -1) AS "before", SUM("n") OVER (ORDER BY "day" ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS "week" FROM (SELECT TIME_FLOOR(__time, 'P1D') AS "day", COUNT(*) AS "n" FROM events GROUP BY 1) t""",
     "SELECT day, n, coalesce(lag(n) OVER (ORDER BY day), -1) AS before, (sum(n) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))::BIGINT AS week FROM (SELECT date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1)")
_add("qualify", """SELECT event_type AS "kind", user_id AS "user", COUNT(*) AS "n" FROM events GROUP BY 1, 2 QUALIFY ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY COUNT(*) DESC, user_id) = 1 ORDER BY 1""",
     "SELECT event_type AS kind, user_id AS user, count(*) AS n FROM events GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, user_id) = 1")
_add("limit_offset", """SELECT user_id, COUNT(*) AS "n" FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10 OFFSET 5""", "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10 OFFSET 5")
_add("sort_by_grouping", """SELECT p_partkey, p_name, p_size FROM part GROUP BY 1, 2, 3 ORDER BY 3 DESC, 1 LIMIT 25""", "SELECT DISTINCT p_partkey, p_name, p_size FROM part ORDER BY 3 DESC, 1 LIMIT 25")
_add("union_all_windows", """SELECT 'recent' AS "period", COUNT(*) AS "n" FROM events WHERE __time >= CURRENT_TIMESTAMP - INTERVAL '7' DAY UNION ALL SELECT 'older' AS "period", COUNT(*) AS "n" FROM events WHERE __time < CURRENT_TIMESTAMP - INTERVAL '7' DAY""",
     f"SELECT 'recent' AS period, count(*) AS n FROM events WHERE ts >= {_NOW} - INTERVAL 7 DAY UNION ALL SELECT 'older', count(*) FROM events WHERE ts < {_NOW} - INTERVAL 7 DAY")
_add("union_distinct", """SELECT c_nationkey AS "k" FROM customer UNION SELECT s_nationkey AS "k" FROM supplier""", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
_add("intersect_except", """SELECT c_nationkey AS "k" FROM customer INTERSECT SELECT n_nationkey AS "k" FROM nation EXCEPT SELECT r_regionkey AS "k" FROM region""", "(SELECT c_nationkey AS k FROM customer INTERSECT SELECT n_nationkey FROM nation) EXCEPT SELECT r_regionkey FROM region")
_add("cte", """WITH "daily" AS (SELECT TIME_FLOOR(__time, 'P1D') AS "day", COUNT(*) AS "n" FROM events GROUP BY 1), "best" AS (SELECT MAX("n") AS "top" FROM "daily") SELECT d."day", d."n" FROM "daily" d JOIN "best" b ON d."n" = b."top\"""",
     "WITH daily AS (SELECT date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1) SELECT day, n FROM daily WHERE n = (SELECT max(n) FROM daily)")
_add("select_distinct", """SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem""", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
# strings, arrays, JSON ------------------------------------------------------------
_add("string_functions", """SELECT p_partkey, LOWER(p_type) AS "lo", UPPER(p_name) AS "up", SUBSTRING(p_brand, 1, 5) AS "sub", CONCAT(p_name, '/', p_type) AS "cat", LENGTH(p_name) AS "len", LEFT(p_name, 3) AS "l", CAST(p_retailprice AS BIGINT) AS "whole", STARTS_WITH(p_name, 'red') AS "red" FROM part""",
     "SELECT p_partkey, lower(p_type) AS lo, upper(p_name) AS up, substring(p_brand, 1, 5) AS sub, p_name || '/' || p_type AS cat, length(p_name) AS len, left(p_name, 3) AS l, trunc(p_retailprice)::BIGINT AS whole, starts_with(p_name, 'red') AS red FROM part")
_add("mv_group", """SELECT tags AS "tag", COUNT(*) AS "n" FROM tagged GROUP BY 1""", "SELECT unnest(CASE WHEN p_partkey % 10 = 0 THEN [NULL] ELSE string_split(p_name, ' ') END) AS tag, count(*) AS n FROM part GROUP BY 1")
_add("mv_contains_overlap", """SELECT COUNT(*) FILTER (WHERE MV_CONTAINS(tags, 'red')) AS "a", COUNT(*) FILTER (WHERE MV_OVERLAP(tags, ARRAY['red', 'ring'])) AS "b", COUNT(*) FILTER (WHERE MV_CONTAINS(tags, ARRAY['red', 'ring'])) AS "c", COUNT(*) FILTER (WHERE tags = 'ring') AS "d", COUNT(*) FILTER (WHERE tags <> 'ring') AS "e", SUM(MV_LENGTH(tags)) AS "f" FROM tagged""",
     "WITH t AS (SELECT CASE WHEN p_partkey % 10 = 0 THEN []::VARCHAR[] ELSE string_split(p_name, ' ') END AS tags FROM part) SELECT count(*) FILTER (list_contains(tags, 'red')) AS a, count(*) FILTER (list_has_any(tags, ['red', 'ring'])) AS b, count(*) FILTER (list_has_all(tags, ['red', 'ring'])) AS c, count(*) FILTER (list_contains(tags, 'ring')) AS d, count(*) FILTER (NOT list_contains(tags, 'ring')) AS e, sum(len(tags))::BIGINT AS f FROM t")
_add("mv_filter_group", """SELECT MV_FILTER_ONLY(tags, ARRAY['red', 'ring', 'gear']) AS "tag", COUNT(*) AS "n" FROM tagged WHERE MV_OVERLAP(tags, ARRAY['red', 'ring', 'gear']) GROUP BY 1""",
     "SELECT tag, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS tag FROM part WHERE p_partkey % 10 <> 0) WHERE tag IN ('red', 'ring', 'gear') GROUP BY 1")
_add("mv_positions", """SELECT p_partkey, MV_OFFSET_OF(tags, 'ring') AS "o", MV_ORDINAL_OF(tags, 'ring') AS "p", MV_LENGTH(MV_FILTER_NONE(tags, ARRAY['ring'])) AS "rest" FROM tagged""",
     "WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN []::VARCHAR[] ELSE string_split(p_name, ' ') END AS tags FROM part) SELECT p_partkey, coalesce(list_position(tags, 'ring'), 0) - 1 AS o, coalesce(nullif(list_position(tags, 'ring'), 0), -1) AS p, len(list_filter(tags, lambda x: x <> 'ring')) AS rest FROM t")
_add("unnest_text", """SELECT t."word" AS "word", COUNT(*) AS "n" FROM part, UNNEST(STRING_TO_ARRAY(p_name, ' ')) AS t("word") GROUP BY 1""", "SELECT unnest(string_split(p_name, ' ')) AS word, count(*) AS n FROM part GROUP BY 1")
_add("unnest_mv", """SELECT t."tag" AS "tag", COUNT(*) AS "n" FROM tagged CROSS JOIN UNNEST(MV_TO_ARRAY(tags)) AS t("tag") GROUP BY 1""", "SELECT unnest(string_split(p_name, ' ')) AS tag, count(*) AS n FROM part WHERE p_partkey % 10 <> 0 GROUP BY 1")
_add("json_value", """SELECT JSON_VALUE(PARSE_JSON(props), '$.k') AS "k", COUNT(*) AS "n" FROM events GROUP BY 1""", "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1")
_add("json_malformed", """SELECT COUNT(JSON_VALUE(TRY_PARSE_JSON(j), '$.flag')) AS "ok", COUNT(*) FILTER (WHERE JSON_VALUE(TRY_PARSE_JSON(j), '$.flag') = '1') AS "on", COUNT(JSON_VALUE(j, '$.flag')) AS "raw" FROM dirty""",
     "SELECT count(*) FILTER (event_id % 25 <> 0) AS ok, count(*) FILTER (event_id % 25 <> 0 AND event_id % 2 = 0) AS on, 0::BIGINT AS raw FROM events")

# what needs the types or the shape of a query ------------------------------------
_add("json_value_of_parsed", """SELECT JSON_VALUE(p.j, '$.k') AS "k", COUNT(*) AS "n" FROM (SELECT PARSE_JSON(props) AS j FROM events) p GROUP BY 1""",
     "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1")
_add("latest_in_join", """SELECT o.o_custkey, LATEST(l.l_linenumber) AS "x" FROM (SELECT __time, l_orderkey, MAX(l_linenumber) AS l_linenumber FROM lineitem GROUP BY 1, 2) l INNER JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1 HAVING COUNT(DISTINCT l.__time) = COUNT(*)""",
     "SELECT o_custkey, arg_max(m, l_shipdate) AS x FROM (SELECT l_shipdate, l_orderkey, max(l_linenumber) AS m FROM lineitem GROUP BY 1, 2) l JOIN orders ON l_orderkey = o_orderkey GROUP BY 1 HAVING count(DISTINCT l_shipdate) = count(*)")
_add("mv_in", """SELECT COUNT(*) AS "n" FROM tagged WHERE tags IN ('red', 'ring') AND NOT tags IN ('blue') AND tags NOT IN ('steel') AND 'green' <> tags""",
     """WITH t AS (SELECT CASE WHEN p_partkey % 10 = 0 THEN CAST([] AS VARCHAR[]) ELSE string_split(p_name, ' ') END AS v FROM part)
     SELECT count(*) AS n FROM t WHERE list_has_any(v, ['red', 'ring']) AND NOT list_contains(v, 'blue') AND NOT list_contains(v, 'steel') AND NOT list_contains(v, 'green')""")
_add("union_all_ordered", """SELECT event_type AS "kind", COUNT(*) AS "n" FROM events GROUP BY 1 UNION ALL SELECT o_orderstatus, COUNT(*) FROM orders GROUP BY 1 ORDER BY "n" DESC, "kind" LIMIT 4 OFFSET 1""",
     "SELECT event_type AS kind, count(*) AS n FROM events GROUP BY 1 UNION ALL SELECT o_orderstatus, count(*) FROM orders GROUP BY 1 ORDER BY n DESC, kind LIMIT 4 OFFSET 1")
_add("lookup_of_many_keys", """SELECT LOOKUP(CAST(o_custkey AS VARCHAR), 'customers', 'none') AS "segment", COUNT(*) AS "n", SUM(CASE WHEN LOOKUP(CAST(o_custkey AS VARCHAR), 'customers') = 'BUILDING' THEN 1 ELSE 0 END) AS "b" FROM orders GROUP BY 1""",
     "SELECT coalesce(c_mktsegment, 'none') AS segment, count(*) AS n, sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END)::BIGINT AS b FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1")
_add("time_extract_epoch", """SELECT TIME_EXTRACT(__time, 'EPOCH') AS "s", COUNT(*) AS "n" FROM events GROUP BY 1""", "SELECT floor(epoch(ts))::BIGINT AS s, count(*) AS n FROM events GROUP BY 1")
_add("window_values", """SELECT "day", "n", LEAD("n") OVER (ORDER BY "day") AS "next", NTILE(4) OVER (ORDER BY "day") AS "quarter", FIRST_VALUE("n") OVER (ORDER BY "day") AS "first_n", SUM("n") OVER (ORDER BY "n" RANGE BETWEEN 5 PRECEDING AND CURRENT ROW) AS "near" FROM (SELECT TIME_FLOOR(__time, 'P1D') AS "day", COUNT(*) AS "n" FROM events GROUP BY 1) t""",
     "SELECT day, n, lead(n) OVER (ORDER BY day) AS next, ntile(4) OVER (ORDER BY day) AS quarter, first_value(n) OVER (ORDER BY day) AS first_n, (sum(n) OVER (ORDER BY n RANGE BETWEEN 5 PRECEDING AND CURRENT ROW))::BIGINT AS near FROM (SELECT date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1)")
_add("array_contains_text", """SELECT p_partkey, ARRAY_CONTAINS(STRING_TO_ARRAY(p_name, ' '), 'ring') AS "has" FROM part""", "SELECT p_partkey, list_contains(string_split(p_name, ' '), 'ring') AS has FROM part")

# types and several values through subqueries ----------------------------------------
_add("division_of_aliases", """SELECT "kind", "n" / "m" AS "whole", "n" * 1.0 / "m" AS "exact" FROM (SELECT event_type AS "kind", COUNT(*) AS "n", COUNT(DISTINCT user_id) AS "m" FROM events GROUP BY 1)""",
     "SELECT event_type AS kind, count(*) // count(DISTINCT user_id) AS whole, count(*)::DOUBLE / count(DISTINCT user_id) AS exact FROM events GROUP BY 1")
_add("division_in_cte", """WITH "s" AS (SELECT user_id, SUM(CASE WHEN event_type = 'click' THEN 3 ELSE 1 END) AS "points", COUNT(*) AS "n" FROM events GROUP BY 1), "t" AS (SELECT user_id, "points" / "n" AS "per" FROM "s")
     SELECT "per", COUNT(*) AS "users", SUM("per") / COUNT(*) AS "same" FROM "t" GROUP BY 1""",
     "SELECT per, count(*) AS users, per AS same FROM (SELECT user_id, (sum(CASE WHEN event_type = 'click' THEN 3 ELSE 1 END) // count(*))::BIGINT AS per FROM events GROUP BY 1) GROUP BY 1")
_TAGS = "WITH t AS (SELECT p_partkey, p_size, CASE WHEN p_partkey % 10 = 0 THEN CAST([] AS VARCHAR[]) ELSE string_split(p_name, ' ') END AS v FROM part)"
_ANY = "len(list_filter(v, lambda x: {})) > 0"
_add("mv_like_range", """SELECT COUNT(*) FILTER (WHERE tags LIKE 'r%') AS "a", COUNT(*) FILTER (WHERE t.tags NOT LIKE '%r%') AS "b", COUNT(*) FILTER (WHERE tags > 'r') AS "c", COUNT(*) FILTER (WHERE 'c' >= tags) AS "d", COUNT(*) FILTER (WHERE tags BETWEEN 'g' AND 'h' AND p_size > 10) AS "e", COUNT(*) FILTER (WHERE tags NOT BETWEEN 'g' AND 'h') AS "f", COUNT(*) FILTER (WHERE tags IN (LOWER('RED'), CONCAT('ri', 'ng'))) AS "g" FROM tagged t""",
     f"""{_TAGS} SELECT count(*) FILTER ({_ANY.format("x LIKE 'r%'")}) AS a, count(*) FILTER (NOT {_ANY.format("x LIKE '%r%'")}) AS b, count(*) FILTER ({_ANY.format("x > 'r'")}) AS c, count(*) FILTER ({_ANY.format("x <= 'c'")}) AS d,
     count(*) FILTER ({_ANY.format("x BETWEEN 'g' AND 'h'")} AND p_size > 10) AS e, count(*) FILTER (NOT {_ANY.format("x BETWEEN 'g' AND 'h'")}) AS f, count(*) FILTER (list_has_any(v, ['red', 'ring'])) AS g FROM t""")
_add("mv_per_value", """SELECT UPPER(SUBSTRING(tags, 1, 2)) AS "head", COUNT(*) AS "n" FROM tagged WHERE UPPER(tags) = 'RED' OR LOWER(tags) LIKE 's%' GROUP BY 1""",
     f"""{_TAGS} SELECT upper(substring(x, 1, 2)) AS head, count(*) AS n FROM (SELECT unnest(v) AS x FROM t WHERE list_contains(v, 'red') OR {_ANY.format("x LIKE 's%'")}) GROUP BY 1""")
_add("mv_of_subquery", """SELECT q."words" AS "word", COUNT(*) AS "n" FROM (SELECT tags AS "words", p_size AS tags FROM tagged WHERE tags = 'red') q WHERE q."words" <> 'ring' AND q.tags = 7 GROUP BY 1""",
     f"{_TAGS} SELECT x AS word, count(*) AS n FROM (SELECT unnest(v) AS x FROM t WHERE list_contains(v, 'red') AND NOT list_contains(v, 'ring') AND p_size = 7) GROUP BY 1")
_add("mv_of_exploded", """SELECT "tag", "n" FROM (SELECT tags AS "tag", COUNT(*) AS "n" FROM tagged GROUP BY 1) WHERE "tag" = 'red' OR "tag" LIKE 's%'""",
     f"{_TAGS} SELECT * FROM (SELECT x AS tag, count(*) AS n FROM (SELECT unnest(CASE WHEN len(v) = 0 THEN [NULL] ELSE v END) AS x FROM t) GROUP BY 1) WHERE tag = 'red' OR tag LIKE 's%'")
_add("array_to_mv_group", """SELECT ARRAY_TO_MV(STRING_TO_ARRAY(p_name, ' ')) AS "word", COUNT(*) AS "n", MAX(p_size) AS "top" FROM part GROUP BY 1 ORDER BY 2 DESC, 1""",
     "SELECT word, count(*) AS n, max(p_size) AS top FROM (SELECT unnest(string_split(p_name, ' ')) AS word, p_size FROM part) GROUP BY 1")
_add("array_to_mv_of_subquery", """SELECT "w" AS "word", COUNT(*) AS "n" FROM (SELECT STRING_TO_MV(p_name, ' ') AS "w" FROM part) WHERE "w" = 'red' GROUP BY 1""",
     "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part WHERE list_contains(string_split(p_name, ' '), 'red')) GROUP BY 1")
_add("lookup_beside_star", """SELECT *, LOOKUP(CAST(o_custkey AS VARCHAR), 'customers') AS "segment" FROM (SELECT o_orderkey, o_custkey FROM orders) o WHERE LOOKUP(CAST(o_custkey AS VARCHAR), 'customers') <> 'BUILDING' OR LOOKUP(CAST(o_orderkey AS VARCHAR), 'customers') IS NOT NULL""",
     """SELECT o_orderkey, o_custkey, c.c_mktsegment AS segment FROM orders LEFT JOIN customer c ON c.c_custkey = o_custkey LEFT JOIN customer d ON d.c_custkey = o_orderkey WHERE c.c_mktsegment <> 'BUILDING' OR d.c_mktsegment IS NOT NULL""")
_add("lookup_of_aggregate", """SELECT "status", LOOKUP(CAST("k" AS VARCHAR), 'customers', 'none') AS "segment" FROM (SELECT o_orderstatus AS "status", MAX(o_custkey) AS "k" FROM orders GROUP BY 1)""",
     "SELECT status, coalesce(c_mktsegment, 'none') AS segment FROM (SELECT o_orderstatus AS status, max(o_custkey) AS k FROM orders GROUP BY 1) LEFT JOIN customer ON c_custkey = k")
_add("quantile_rank_error", """SELECT l."flag" AS "flag", COUNT(*) AS "n", ABS(AVG(CASE WHEN l."v" <= q."p50" THEN 1.0 ELSE 0.0 END) - 0.5) < 0.005 AS "p50_ok", ABS(AVG(CASE WHEN l."v" <= q."p99" THEN 1.0 ELSE 0.0 END) - 0.99) < 0.005 AS "p99_ok",
     ABS(COUNT(*) FILTER (WHERE l."v" <= q."odd" AND l."k" > 3) * 1.0 / COUNT(*) FILTER (WHERE l."k" > 3) - 0.25) < 0.005 AS "odd_ok"
     FROM (SELECT l_returnflag AS "flag", l_linenumber AS "k", l_extendedprice AS "v" FROM lineitem) l
     JOIN (SELECT l_returnflag AS "flag", APPROX_QUANTILE_DS(l_extendedprice, 0.5) AS "p50", APPROX_QUANTILE(l_extendedprice, 0.99) AS "p99", APPROX_QUANTILE_DS(l_extendedprice, 0.25) FILTER (WHERE l_linenumber > 3) AS "odd" FROM lineitem GROUP BY 1) q
     ON l."flag" = q."flag" GROUP BY 1""",
     "SELECT l_returnflag AS flag, count(*) AS n, true AS p50_ok, true AS p99_ok, true AS odd_ok FROM lineitem GROUP BY 1")
_add("quantile_of_nothing", """SELECT event_type, APPROX_QUANTILE_DS("value", 0.5) FILTER (WHERE event_id < 0) AS "none", APPROX_QUANTILE_DS(NULLIF("value", "value"), 0.5) AS "nulls", COUNT(*) AS "n" FROM events GROUP BY 1""",
     "SELECT event_type, NULL::DOUBLE AS none, NULL::DOUBLE AS nulls, count(*) AS n FROM events GROUP BY 1")
_add("time_floor_origin", """SELECT TIME_FLOOR(__time, 'P1W', TIMESTAMP '2024-01-03 12:00:00') AS "week", TIME_FLOOR(__time, 'PT6H', TIMESTAMP '2024-01-01 01:00:00') AS "part", COUNT(*) AS "n" FROM events GROUP BY 1, 2""",
     "SELECT time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '2024-01-03 12:00:00') AS week, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01 01:00:00') AS part, count(*) AS n FROM events GROUP BY 1, 2")
_add("time_floor_origin_months", """SELECT TIME_FLOOR(__time, 'P3M', TIMESTAMP '1995-02-15 00:00:00') AS "quarter", TIME_CEIL(__time, 'P1M', TIMESTAMP '1995-02-15 00:00:00') AS "next", COUNT(*) AS "n" FROM orders GROUP BY 1, 2""",
     """WITH d AS (SELECT o_orderdate::TIMESTAMP AS t FROM orders), m AS (SELECT t, (date_trunc('month', t - INTERVAL 14 DAY) + INTERVAL 14 DAY)::TIMESTAMP AS s FROM d)
     SELECT s - to_months(((year(s) * 12 + month(s) - 1995 * 12 - 2) % 3 + 3) % 3) AS quarter, CASE WHEN s = t THEN t ELSE s + INTERVAL 1 MONTH END AS next, count(*) AS n FROM m GROUP BY 1, 2""")
_add("time_floor_zone", """SELECT TIME_FLOOR(__time, 'P1D', NULL, 'Asia/Tokyo') AS "day", TIME_SHIFT(__time, 'P1D', 1, 'Asia/Tokyo') AS "later", COUNT(*) AS "n" FROM events GROUP BY 1, 2""",
     "SELECT date_trunc('day', ts + INTERVAL 9 HOUR) - INTERVAL 9 HOUR AS day, ts + INTERVAL 1 DAY AS later, count(*) AS n FROM events GROUP BY 1, 2")
_add("time_format_letters", """SELECT TIME_FORMAT(__time, 'YYYY-MM-dd''T''HH:mmZZ') AS "a", TIME_FORMAT(__time, 'e') AS "b", TIME_FORMAT(__time, 'xxxx-ee', 'Asia/Tokyo') AS "c", COUNT(*) AS "n" FROM events GROUP BY 1, 2, 3""",
     "SELECT strftime(ts, '%Y-%m-%dT%H:%M') || '+00:00' AS a, isodow(ts)::VARCHAR AS b, isoyear(ts + INTERVAL 9 HOUR) || '-0' || isodow(ts + INTERVAL 9 HOUR) AS c, count(*) AS n FROM events GROUP BY 1, 2, 3")
_add("latest_within_bytes", """SELECT user_id, LATEST(CONCAT('é', event_type, '日'), 5) AS "five", EARLIEST(CONCAT('é', event_type, '日'), 1) AS "one", LATEST(CONCAT('é', LEFT(event_type, 1), '日'), 64) AS "all" FROM events GROUP BY 1""",
     "SELECT user_id, 'é' || left(arg_max(event_type, ts), 3) AS five, '' AS one, 'é' || left(arg_max(event_type, ts), 1) || '日' AS all FROM events GROUP BY 1")
