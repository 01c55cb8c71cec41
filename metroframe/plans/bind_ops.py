"""Driver-table bindings for streaming (A8, I*) and quality / observability
(J*) operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroframe.operators import quality as Q
from metroframe.plans.bind_ingest import _REQ_SQL, _requests_from_customers, tbl
from metroframe.plans.bind_timeline import EP, with_ctes
from metroframe.plans.registry import register
from metroframe.session import work_path
from metroframe.streaming import polls as P

# ---------------------------------------------------------------------------
# Streaming
# ---------------------------------------------------------------------------

LATE_CUTOFF = "2024-01-15 00:00:00"


def event_stream(spark, d, **kw) -> DataFrame:
    schema = tbl(spark, d, "events").schema
    return P.poll_stream(spark, d, schema, glob="events.parquet", event_time="ts", **kw)


def _city(df: DataFrame) -> DataFrame:
    return df.withColumn("city", F.when(F.col("user_id") % 2 == 0, F.lit("nyc")).otherwise(F.lit("london")))


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@register("stream_poll_scan", "SELECT * FROM events")
def stream_poll_scan(spark, d):
    path = P.run_to_parquet(event_stream(spark, d), "poll-scan")
    return _ntz(spark.read.parquet(path), "ts")


@register("stream_dedup", """
SELECT DISTINCT user_id, time_bucket(INTERVAL 30 MINUTE, ts) AS bucket_start FROM events""")
def stream_dedup(spark, d):
    s = P.stream_dedup(event_stream(spark, d), "user_id", "ts", "30 minutes", "1 hour")
    path = P.run_to_parquet(s.select("user_id", "bucket_start"), "dedup")
    return _ntz(spark.read.parquet(path), "bucket_start")


@register("stream_hourly", """
SELECT * FROM (SELECT CASE WHEN user_id % 2 = 0 THEN 'nyc' ELSE 'london' END AS city,
  date_trunc('hour', ts) AS window_start, count(*) AS n_events FROM events GROUP BY 1, 2)
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events)""")
def stream_hourly(spark, d):
    s = P.stream_hourly(_city(event_stream(spark, d)), "ts", ["city"], "0 seconds")
    path = P.run_to_parquet(s, "hourly")
    return _ntz(spark.read.parquet(path), "window_start")


@register("stream_episodes", with_ctes(EP) + """
SELECT line_id, severity_level, started_at, ended_at, duration_minutes FROM ep WHERE ended_at IS NOT NULL""")
def stream_episodes(spark, d):
    s = event_stream(spark, d)
    polls = s.select(F.col("user_id").alias("line_id"), "ts", (F.col("event_type") == "error").alias("disrupted"),
                     F.when(F.col("event_type") != "error", F.lit(10)).when(F.col("value") > 100, F.lit(6))
                     .otherwise(F.lit(9)).alias("severity"))
    path = P.run_to_parquet(P.stream_episodes(polls), "episodes")
    out = _ntz(spark.read.parquet(path), "started_at", "ended_at")
    return out.withColumn("duration_minutes", F.timestamp_diff("MINUTE", F.col("started_at"), F.col("ended_at")))


@register("stream_late_rows", f"""
SELECT CASE WHEN user_id % 2 = 0 THEN 'nyc' ELSE 'london' END AS city, date_trunc('hour', ts) AS window_start,
  count(*) AS raw_events, CASE WHEN date_trunc('hour', ts) >= TIMESTAMP '{LATE_CUTOFF}'
    AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR THEN count(*) END AS n_events
FROM events GROUP BY 1, 2""")
def stream_late_rows(spark, d):
    """Rows for the first half of the month land *after* the second half: the
    raw sink keeps them all (raw_events), the watermarked hourly aggregate
    drops them (n_events is null for their windows and for the last ones,
    which the watermark has not passed)."""
    ev = tbl(spark, d, "events")
    cutoff = F.lit(LATE_CUTOFF).cast("timestamp_ntz")
    landing = work_path(spark, "landing")
    hourly_out, raw_out = work_path(spark, "late-hourly"), work_path(spark, "late-raw")

    def drain():
        s = P.poll_stream(spark, landing, ev.schema, event_time="ts")
        P.run_to_parquet(P.stream_hourly(_city(s), "ts", ["city"], "1 hour"), "late", path=hourly_out)
        P.run_to_parquet(s, "late-raw", path=raw_out)

    ev.filter(F.col("ts") >= cutoff).write.parquet(landing)
    drain()
    ev.filter(F.col("ts") < cutoff).write.mode("append").parquet(landing)
    drain()
    kept = _ntz(_city(spark.read.parquet(raw_out)).withColumn("window_start", F.date_trunc("hour", "ts")), "window_start")
    kept = kept.groupBy("city", "window_start").agg(F.count(F.lit(1)).alias("raw_events"))
    return kept.join(_ntz(spark.read.parquet(hourly_out), "window_start"), ["city", "window_start"], "left")


# ---------------------------------------------------------------------------
# Quality
# ---------------------------------------------------------------------------

LINE_CHECKS = [
    Q.Check("orderkey_not_null", "not_null", ("l_orderkey",)),
    Q.Check("line_unique", "unique", ("l_orderkey", "l_linenumber")),
    Q.Check("returnflag_accepted", "accepted_values", ("l_returnflag",), ("A", "N")),
    Q.Check("discount_range", "range", ("l_discount",), (0.0, 0.08)),
    Q.Check("quantity_range", "range", ("l_quantity",), (1.0, 45.0)),
]

_DQ_SQL = """dq AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_orderkey IS NULL) AS f1,
  count(*) FILTER (WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL)
    - count(DISTINCT (l_orderkey, l_linenumber)) AS f2,
  count(l_returnflag) AS e3, count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) AS f3,
  count(l_discount) AS e4, count(*) FILTER (WHERE NOT l_discount BETWEEN 0.0 AND 0.08) AS f4,
  count(l_quantity) AS e5, count(*) FILTER (WHERE NOT l_quantity BETWEEN 1.0 AND 45.0) AS f5 FROM lineitem),
res AS (SELECT 'orderkey_not_null' AS check_name, 'not_null' AS check_type, n AS evaluated_rows, f1 AS failed_rows FROM dq
  UNION ALL SELECT 'line_unique', 'unique', n, f2 FROM dq
  UNION ALL SELECT 'returnflag_accepted', 'accepted_values', e3, f3 FROM dq
  UNION ALL SELECT 'discount_range', 'range', e4, f4 FROM dq
  UNION ALL SELECT 'quantity_range', 'range', e5, f5 FROM dq)"""


@register("dq_expectations", with_ctes(_DQ_SQL) + """
SELECT check_name, check_type, evaluated_rows::BIGINT AS evaluated_rows, failed_rows::BIGINT AS failed_rows,
  failed_rows = 0 AS success FROM res""")
def dq_expectations(spark, d):
    return Q.expectations(tbl(spark, d, "lineitem"), LINE_CHECKS)


@register("dq_results", with_ctes(_DQ_SQL) + """
SELECT 'lineitem_suite' AS suite_name, 'lineitem' AS table_name, count(*) AS evaluated_expectations,
  count(*) FILTER (WHERE failed_rows = 0) AS successful_expectations,
  count(*) FILTER (WHERE failed_rows > 0) AS unsuccessful_expectations,
  100.0::DOUBLE * count(*) FILTER (WHERE failed_rows = 0) / count(*) AS success_pct,
  count(*) FILTER (WHERE failed_rows > 0) = 0 AS success,
  array_to_string(list_sort(list(check_name) FILTER (WHERE failed_rows > 0)), ',') AS failed_checks_detail FROM res""")
def dq_results(spark, d):
    return Q.suite_results(Q.expectations(tbl(spark, d, "lineitem"), LINE_CHECKS), "lineitem_suite", "lineitem")


NULL_RATE_COLUMNS = ["unique_key", "created_date", "complaint_type", "borough", "latitude", "longitude"]


@register("null_rates", f"""
WITH r AS {_REQ_SQL}, n AS (SELECT count(*) AS total, {', '.join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}"
                                                                  for c in NULL_RATE_COLUMNS)} FROM r)
{' UNION ALL '.join(f"SELECT '{c}' AS column_name, {c} AS null_count, {c} / total AS null_rate FROM n"
                    for c in NULL_RATE_COLUMNS)}""")
def null_rates(spark, d):
    return Q.null_rates(_requests_from_customers(spark, d), NULL_RATE_COLUMNS)


def _daily_runs(spark, d) -> DataFrame:
    ev = tbl(spark, d, "events")
    runs = ev.groupBy(F.col("event_type").alias("pipeline"), F.to_date("ts").alias("run_date")).agg(
        F.max("ts").alias("actual_completion"), F.count(F.lit(1)).alias("records_read"),
        F.count_if(F.col("value") > 300).alias("records_rejected"))
    return runs.withColumns({
        "expected_completion": (F.col("run_date").cast("timestamp_ntz")
                                + F.make_dt_interval(F.lit(0), F.lit(23), F.lit(30), F.lit(0))),
        "status": F.when(F.col("records_rejected") == 0, "success").otherwise("partial"),
    })


_RUNS_SQL = """runs AS (SELECT event_type AS pipeline, CAST(ts AS DATE) AS run_date, max(ts) AS actual_completion,
  count(*) AS records_read, count(*) FILTER (WHERE value > 300) AS records_rejected,
  CAST(ts AS DATE) + INTERVAL 23 HOUR + INTERVAL 30 MINUTE AS expected_completion FROM events GROUP BY ALL)"""


@register("sla_breach", with_ctes(_RUNS_SQL) + """
SELECT md5(pipeline || '|' || strftime(expected_completion, '%Y-%m-%d %H:%M:%S')) AS breach_id, pipeline AS pipeline_name,
  expected_completion, actual_completion,
  (epoch_us(actual_completion) - epoch_us(expected_completion)) // 60000000 AS breach_minutes
FROM runs WHERE actual_completion > expected_completion""")
def sla_breach(spark, d):
    return Q.sla_breaches(_daily_runs(spark, d), "pipeline", "expected_completion", "actual_completion")


@register("pipeline_health", with_ctes(_RUNS_SQL) + """
SELECT pipeline, count(*) AS n_runs, count(*) FILTER (WHERE records_rejected = 0) AS n_success,
  count(*) FILTER (WHERE records_rejected > 0) AS n_partial, 0::BIGINT AS n_failed,
  sum(records_read)::BIGINT AS records_read, sum(records_rejected)::BIGINT AS records_rejected,
  max(actual_completion) AS last_run,
  first(CASE WHEN records_rejected = 0 THEN 'success' ELSE 'partial' END ORDER BY actual_completion DESC) AS last_status
FROM runs GROUP BY pipeline""")
def pipeline_health(spark, d):
    return Q.pipeline_health(_daily_runs(spark, d), "pipeline", "actual_completion", "status", "records_read",
                             "records_rejected")


# ---------------------------------------------------------------------------
# JSON profile, drift, key fields
# ---------------------------------------------------------------------------

def _order_lines(spark, d, version: int) -> DataFrame:
    o = tbl(spark, d, "orders")
    key = F.col("o_orderkey").cast("string")
    cust = F.col("o_custkey").cast("string")
    price = F.col("o_totalprice").cast("string")
    date = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    if version == 1:
        flag = F.when(F.col("o_orderkey") % 2 == 0, F.lit("true")).otherwise(F.lit("null"))
        line = F.concat(F.lit('{"o_orderkey": '), key, F.lit(', "o_custkey": '), cust, F.lit(', "o_orderstatus": "'),
                        "o_orderstatus", F.lit('", "o_totalprice": '), price, F.lit(', "o_orderdate": "'), date,
                        F.lit('", "flag": '), flag, F.lit(', "meta": {"cust": '), cust, F.lit("}}"))
    else:
        line = F.concat(F.lit('{"o_orderkey": '), key, F.lit(', "o_custkey": "'), cust, F.lit('", "o_orderstatus": "'),
                        "o_orderstatus", F.lit('", "o_totalprice": '), price, F.lit(', "o_orderdate": "'), date,
                        F.lit('", "channel": "web", "meta": {"cust": '), cust, F.lit("}}"))
    return o.select("o_orderstatus", line.alias("line"))


_LINE1 = """'{"o_orderkey": ' || o_orderkey::VARCHAR || ', "o_custkey": ' || o_custkey::VARCHAR || ', "o_orderstatus": "'
  || o_orderstatus || '", "o_totalprice": ' || o_totalprice::VARCHAR || ', "o_orderdate": "'
  || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '", "flag": ' || (CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'null' END)
  || ', "meta": {"cust": ' || o_custkey::VARCHAR || '}}'"""
_LINE2 = """'{"o_orderkey": ' || o_orderkey::VARCHAR || ', "o_custkey": "' || o_custkey::VARCHAR || '", "o_orderstatus": "'
  || o_orderstatus || '", "o_totalprice": ' || o_totalprice::VARCHAR || ', "o_orderdate": "'
  || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '", "channel": "web", "meta": {"cust": ' || o_custkey::VARCHAR || '}}'"""


def _profile_sql(lines: str) -> str:
    return f"""lines AS ({lines}),
l1 AS (SELECT k AS path, json_extract(line, '$.' || k) AS v FROM (SELECT line, unnest(json_keys(line)) AS k FROM lines)),
l2 AS (SELECT path || '.' || k2 AS path, json_extract(v, '$.' || k2) AS v
  FROM (SELECT path, v, unnest(json_keys(v)) AS k2 FROM l1 WHERE json_type(v) = 'OBJECT')),
leaves AS (SELECT * FROM l1 WHERE json_type(v) <> 'OBJECT' UNION ALL SELECT * FROM l2 WHERE json_type(v) <> 'OBJECT'),
typed AS (SELECT path, json_extract_string(v, '$') AS s, json_type(v) AS jt FROM leaves),
kinds AS (SELECT path, s, CASE jt WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'BIGINT' THEN 'integer'
  WHEN 'UBIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'float' WHEN 'ARRAY' THEN 'array'
  ELSE CASE WHEN length(s) >= 10 AND substr(s, 5, 1) = '-' AND substr(s, 8, 1) = '-' THEN 'timestamp_string'
  ELSE 'string' END END AS kind FROM typed),
prof AS (SELECT path, array_to_string(list_sort(list_distinct(list(kind))), ',') AS types, count(*) AS n_present,
  count(*) FILTER (WHERE kind = 'null') AS n_null, substr(min(s), 1, 80) AS sample FROM kinds GROUP BY path)"""


@register("json_profile", with_ctes(_profile_sql(f"SELECT props AS line FROM events UNION ALL SELECT {_LINE1} FROM orders"))
          + "SELECT * FROM prof")
def json_profile(spark, d):
    lines = tbl(spark, d, "events").select(F.col("props").alias("line")).unionByName(
        _order_lines(spark, d, 1).select("line"))
    return Q.json_profile(lines, "line")


def _drift_side(name: str, lines: str) -> str:
    return _profile_sql(lines).replace("lines AS", f"{name}_lines AS").replace("FROM lines", f"FROM {name}_lines") \
        .replace("l1 AS", f"{name}_l1 AS").replace("FROM l1", f"FROM {name}_l1") \
        .replace("l2 AS", f"{name}_l2 AS").replace("FROM l2", f"FROM {name}_l2") \
        .replace("leaves AS", f"{name}_leaves AS").replace("FROM leaves", f"FROM {name}_leaves") \
        .replace("typed AS", f"{name}_typed AS").replace("FROM typed", f"FROM {name}_typed") \
        .replace("kinds AS", f"{name}_kinds AS").replace("FROM kinds", f"FROM {name}_kinds") \
        .replace("prof AS", f"{name}_prof AS")


_NN = "array_to_string(list_filter(string_split({t}, ','), lambda x: x <> 'null'), ',')"


@register("schema_drift", with_ctes(
    _drift_side("a", f"SELECT {_LINE1} AS line FROM orders WHERE o_orderstatus = 'F'"),
    _drift_side("b", f"SELECT {_LINE2} AS line FROM orders WHERE o_orderstatus <> 'F'")) + f"""
, j AS (SELECT coalesce(a.path, b.path) AS field_name, {_NN.format(t='a.types')} AS old_type,
  {_NN.format(t='b.types')} AS new_type FROM a_prof a FULL OUTER JOIN b_prof b ON a.path = b.path)
SELECT field_name, change_type, old_type, new_type,
  CASE change_type WHEN 'new_field' THEN 'logged_only' WHEN 'type_change' THEN 'auto_cast' ELSE 'pipeline_paused' END
    AS action_taken
FROM (SELECT *, CASE WHEN old_type IS NULL THEN 'new_field' WHEN new_type IS NULL THEN 'field_removed'
  WHEN old_type <> new_type THEN 'type_change' END AS change_type FROM j) WHERE change_type IS NOT NULL""")
def schema_drift(spark, d):
    v1 = _order_lines(spark, d, 1).filter(F.col("o_orderstatus") == "F")
    v2 = _order_lines(spark, d, 2).filter(F.col("o_orderstatus") != "F")
    return Q.schema_drift(Q.json_profile(v1, "line"), Q.json_profile(v2, "line"))


# Key fields expected in an order feed (binding of the
# request key-field list).
EXPECTED_FIELDS = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "flag", "meta.cust", "complaint_type"]


@register("key_field_presence", with_ctes(_profile_sql(f"SELECT {_LINE1} AS line FROM orders")) + f"""
SELECT e.field_name, p.path IS NOT NULL AS is_present, p.types, p.n_null / p.n_present AS null_rate
FROM (SELECT unnest([{', '.join(repr(f) for f in EXPECTED_FIELDS)}]) AS field_name) e
LEFT JOIN prof p ON e.field_name = p.path""")
def key_field_presence(spark, d):
    return Q.key_field_presence(Q.json_profile(_order_lines(spark, d, 1), "line"), EXPECTED_FIELDS)


