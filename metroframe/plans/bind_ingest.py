"""Driver-table bindings for scans, sinks, normalisation and contracts
(A*, B*, C*). Each builder is registered with its DuckDB oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroframe.functions import columns as C
from metroframe.operators import contracts as K
from metroframe.operators import staging as S
from metroframe.plans.registry import normalize, register
from metroframe.session import work_path
from metroframe.sources import raw as R
from metroframe.sources.seeds import read_seed_csv

AS_OF = "2024-01-30 00:00:00"


def tbl(spark: SparkSession, d: str, name: str) -> DataFrame:
    return R.load(spark, d, name)


def city_coords(spark: SparkSession) -> DataFrame:
    rows = [(city, lat, lon) for city, (lat, lon) in K.CITY_COORDS.items()]
    return F.broadcast(spark.createDataFrame(rows, "city string, latitude double, longitude double"))  # two rows


# ---------------------------------------------------------------------------
# A: scans and sinks
# ---------------------------------------------------------------------------

ORDERS_RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                                  ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                   "o_orderpriority"]])


def _orders_json_lines(spark, d) -> DataFrame:
    o = tbl(spark, d, "orders")
    rec = F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                   F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("o_orderdate"),
                   "o_orderpriority", F.lit("ignored").alias("unknown_field"))
    return o.select(F.to_json(rec).alias("value"))


def _typed_orders(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    return df.select(
        C.safe_int("o_orderkey").alias("o_orderkey"), C.safe_int("o_custkey").alias("o_custkey"),
        C.safe_str("o_orderstatus").alias("o_orderstatus"), C.safe_float("o_totalprice").alias("o_totalprice"),
        C.parse_timestamp("o_orderdate").alias("o_orderdate"), C.safe_str("o_orderpriority").alias("o_orderpriority"),
        *(extra or []))


@register("raw_json_scan", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""")
def raw_json_scan(spark, d):
    """Lands the orders as NDJSON under source/YYYY/MM/DD/run and scans the
    source's folder with its schema."""
    zone = work_path(spark, "raw-zone")
    key = R.raw_key("shop/orders", "run-0001", 2024, 1, 30)
    _orders_json_lines(spark, d).write.text(f"{zone}/{key}")
    landed = R.read_raw_json(spark, f"{zone}/shop/orders", ORDERS_RAW_SCHEMA, with_file=False)
    return normalize(_typed_orders(landed))


@register("seed_lookup", """
SELECT n_nationkey::BIGINT AS n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")
def seed_lookup(spark, d):
    """The right side is a seed: a CSV with a header, read with its schema."""
    path = work_path(spark, "seed-region")
    tbl(spark, d, "region").select("r_regionkey", "r_name").coalesce(1).write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("r_regionkey", T.LongType()), T.StructField("r_name", T.StringType())])
    region = read_seed_csv(spark, path, schema)
    n = tbl(spark, d, "nation")
    return normalize(S.lookup(n, region, "n_regionkey", "r_regionkey").select("n_nationkey", "n_name", "r_name"))


@register("incremental_lookback", f"""
SELECT * FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 25 HOUR""")
def incremental_lookback(spark, d):
    return R.incremental_lookback(tbl(spark, d, "events"), "ts", AS_OF, hours=25)


@register("recent_top_k", """
SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 100 OFFSET 50""")
def recent_top_k(spark, d):
    return R.recent_top_k(tbl(spark, d, "events"), "ts", "event_id", n=100, offset=50)


@register("dataset_probe", """
SELECT count(*) AS row_count, min(ts) AS min_ts, max(ts) AS max_ts FROM events""")
def dataset_probe(spark, d):
    return R.dataset_probe(tbl(spark, d, "events"), "ts")


@register("unpack_arrays", """
SELECT vec_id, i - 1 AS pos, CAST(embedding[i] AS DOUBLE) AS time,
       CAST(CASE WHEN i <= 32 THEN embedding[i] END AS DOUBLE) AS half,
       CAST(CASE WHEN i < len(embedding) THEN embedding[i + 1] END AS DOUBLE) AS shifted
FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)""")
def unpack_arrays(spark, d):
    e = tbl(spark, d, "embeddings").select(
        "vec_id", "embedding",
        F.slice("embedding", 1, 32).alias("half_arr"),
        F.slice("embedding", 2, F.size("embedding")).alias("shifted_arr"))
    return normalize(R.unpack_arrays(e, ["vec_id"], "embedding", {"half": "half_arr", "shifted": "shifted_arr"}))


@register("city_union", """
SELECT event_id, ts, city, CASE city WHEN 'nyc' THEN 40.7128 ELSE 51.5074 END::DOUBLE AS latitude,
       CASE city WHEN 'nyc' THEN -74.006 ELSE -0.1278 END::DOUBLE AS longitude
FROM (SELECT event_id, ts, 'nyc' AS city FROM events WHERE user_id % 2 = 0
      UNION ALL SELECT event_id, ts, 'london' AS city FROM events WHERE user_id % 2 = 1)""")
def city_union(spark, d):
    ev = tbl(spark, d, "events").select("event_id", "ts", "user_id")
    parts = {"nyc": ev.filter(F.col("user_id") % 2 == 0).drop("user_id"),
             "london": ev.filter(F.col("user_id") % 2 == 1).drop("user_id")}
    return R.city_union(parts, city_coords(spark))


@register("explode_statuses", """
SELECT event_id, event_type AS status, value FROM events WHERE value <= 400
UNION ALL SELECT event_id, 'derived', value / 2 FROM events WHERE value <= 400
UNION ALL SELECT event_id, NULL, NULL FROM events WHERE NOT value <= 400""")
def explode_statuses(spark, d):
    """Each event becomes a poll response carrying a nested status array (two
    statuses; none above value 400), exploded back to one row per status."""
    ev = tbl(spark, d, "events")
    statuses = F.when(F.col("value") <= 400, F.array(
        F.struct(F.col("event_type").alias("status"), F.col("value").alias("value")),
        F.struct(F.lit("derived").alias("status"), (F.col("value") / 2).alias("value"))))
    return R.explode_nested(ev.select("event_id", statuses.alias("statuses")), "statuses", ["event_id"])


@register("ndjson_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       year(date_trunc('month', o_orderdate))::BIGINT AS year, month(o_orderdate)::BIGINT AS month, 1::BIGINT AS day
FROM orders""")
def ndjson_roundtrip(spark, d):
    rec = R.parse_json_lines(_orders_json_lines(spark, d), ORDERS_RAW_SCHEMA, keep_raw=False)
    run = rec.withColumn("_run_date", F.date_trunc("month", C.parse_timestamp("o_orderdate")))
    path = work_path(spark, "raw-orders")
    R.write_ndjson(run, path, "_run_date")
    back = spark.read.schema(ORDERS_RAW_SCHEMA).json(path)
    return normalize(_typed_orders(back, ["year", "month", "day"]))


RAW_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "load_note"]


@register("raw_append", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL::VARCHAR AS load_note FROM orders""")
def raw_append(spark, d):
    o = tbl(spark, d, "orders")
    path = work_path(spark, "raw-append")
    R.append_rows(o.filter(F.col("o_orderstatus") == "F"), path, RAW_ORDER_COLUMNS)
    R.append_rows(o.filter(F.col("o_orderstatus") != "F"), path, RAW_ORDER_COLUMNS)
    return normalize(spark.read.parquet(path))


@register("mart_partitioned_write", """
SELECT o_orderkey, o_custkey, o_totalprice, year(o_orderdate)::BIGINT AS order_year FROM orders""")
def mart_partitioned_write(spark, d):
    o = tbl(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                       F.year("o_orderdate").alias("order_year"))
    path = work_path(spark, "mart-orders")
    R.write_mart(o, path, "order_year", ["o_custkey"])
    return normalize(spark.read.parquet(path))


# ---------------------------------------------------------------------------
# B: normalisation
# ---------------------------------------------------------------------------

def _padded_text(spark, d) -> DataFrame:
    o = tbl(spark, d, "orders")
    k = F.col("o_orderkey") % 5
    raw = (F.when(k == 0, F.lit("")).when(k == 1, F.concat(F.lit("  "), "o_orderpriority", F.lit("\t")))
           .when(k == 2, F.lit("   ")).when(k == 3, F.concat("o_orderstatus", F.lit("\n")))
           .otherwise(F.col("o_orderpriority")))
    return o.select("o_orderkey", raw.alias("raw"))


_PADDED_SQL = """(SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '  ' || o_orderpriority || chr(9)
  WHEN 2 THEN '   ' WHEN 3 THEN o_orderstatus || chr(10) ELSE o_orderpriority END AS raw FROM orders)"""


@register("safe_str", f"""
SELECT o_orderkey, raw, nullif(trim(raw, ' ' || chr(9) || chr(10) || chr(13)), '') AS clean FROM {_PADDED_SQL}""")
def safe_str(spark, d):
    return _padded_text(spark, d).withColumn("clean", C.safe_str("raw"))


def _numeric_text(spark, d) -> DataFrame:
    o = tbl(spark, d, "orders")
    k = F.col("o_orderkey") % 8
    cust = F.col("o_custkey").cast("string")
    raw = (F.when(k == 0, F.concat(cust, F.lit(".25"))).when(k == 1, F.lit("bad"))
           .when(k == 2, F.concat(F.lit(" "), cust, F.lit(" "))).when(k == 3, F.lit("1_000"))
           .when(k == 4, F.concat(cust, F.lit(".5d"))).when(k == 5, F.lit(""))
           .when(k == 6, F.concat(F.lit("-"), cust, F.lit("e-2"))).otherwise(F.concat(cust, F.lit("abc"))))
    return o.select("o_orderkey", raw.alias("raw"))


_NUMERIC_SQL = """(SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN o_custkey::VARCHAR || '.25' WHEN 1 THEN 'bad'
  WHEN 2 THEN ' ' || o_custkey::VARCHAR || ' ' WHEN 3 THEN '1_000' WHEN 4 THEN o_custkey::VARCHAR || '.5d'
  WHEN 5 THEN '' WHEN 6 THEN '-' || o_custkey::VARCHAR || 'e-2' ELSE o_custkey::VARCHAR || 'abc' END AS raw
  FROM orders)"""

_PY_FLOAT_SQL = (f"CASE WHEN regexp_matches(trim(raw), '{C.FLOAT_PATTERN}') "
                 "THEN TRY_CAST(replace(trim(raw), '_', '') AS DOUBLE) END")


@register("safe_float", f"SELECT o_orderkey, raw, {_PY_FLOAT_SQL} AS parsed FROM {_NUMERIC_SQL}")
def safe_float(spark, d):
    return _numeric_text(spark, d).withColumn("parsed", C.safe_float("raw"))


@register("safe_int", f"SELECT o_orderkey, raw, CAST(trunc({_PY_FLOAT_SQL}) AS BIGINT) AS parsed FROM {_NUMERIC_SQL}")
def safe_int(spark, d):
    return _numeric_text(spark, d).withColumn("parsed", C.safe_int("raw"))


def _aqi_json(spark, d) -> DataFrame:
    ev = tbl(spark, d, "events")
    k = F.col("event_id") % 3
    n = F.floor("value").cast("string")
    txt = (F.when(k == 0, F.concat(F.lit('{"AQI": '), n, F.lit("}")))
           .when(k == 1, F.concat(F.lit('{"aqi": '), n, F.lit("}")))
           .otherwise(F.concat(F.lit('{"AQI": null, "aqi": '), n, F.lit("}"))))
    return ev.select("event_id", "event_type", "value", txt.alias("line"))


@register("alias_keys", """
SELECT event_id, CASE WHEN event_id % 3 < 2 THEN floor(value)::BIGINT END AS aqi FROM events""")
def alias_keys(spark, d):
    m = F.from_json("line", "map<string,string>")
    return _aqi_json(spark, d).select("event_id", C.safe_int(C.key_alias(m, "AQI", "aqi")).alias("aqi"))


@register("nested_category", """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_type WHEN 1 THEN 'flat_' || event_type END AS category_name
FROM events""")
def nested_category(spark, d):
    ev = tbl(spark, d, "events")
    k = F.col("event_id") % 3
    obj = F.concat(F.lit('{"Category": {"Number": 1, "Name": "'), "event_type", F.lit('"}, "category_name": "no"}'))
    nul = F.concat(F.lit('{"Category": null, "category_name": "flat_'), "event_type", F.lit('"}'))
    line = F.when(k == 0, obj).when(k == 1, nul).otherwise(F.lit('{"category_name": "absent"}'))
    m = F.from_json(line, "map<string,string>")
    return ev.select("event_id", C.safe_str(C.nested_category(m, "Category", "Name", "category_name"))
                     .alias("category_name"))


@register("keep_raw_json", """
SELECT o_orderkey, o_orderstatus,
       '{"o_orderkey": ' || o_orderkey::VARCHAR || ', "o_orderstatus": "' || o_orderstatus || '"}' AS raw_json
FROM orders""")
def keep_raw_json(spark, d):
    o = tbl(spark, d, "orders")
    line = F.concat(F.lit('{"o_orderkey": '), F.col("o_orderkey").cast("string"),
                    F.lit(', "o_orderstatus": "'), "o_orderstatus", F.lit('"}'))
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType())])
    return R.parse_json_lines(o.select(line.alias("value")), schema)


@register("ingest_metadata", f"""
SELECT *, sha256('run-0001|' || json_object('event_id', event_id, 'ts', epoch_us(ts), 'user_id', user_id, 'event_type', event_type,
  'value', CAST(value AS VARCHAR), 'props', props)::VARCHAR) AS _ingestion_id,
  TIMESTAMP '{AS_OF}' AS _ingestion_timestamp, DATE '{AS_OF[:10]}' AS _ingestion_date FROM events""")
def ingest_metadata(spark, d):
    """The id hashes the whole record, times and numbers in forms that other
    engines write alike. The source file differs between machines, so it is
    left out here."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), "ts")
    payload = ["event_id", micros.alias("ts"), "user_id", "event_type", F.col("value").cast("string").alias("value"), "props"]
    return R.ingest_metadata(tbl(spark, d, "events"), run_id="run-0001", run_ts=AS_OF, payload_cols=payload).drop("_source_file")


@register("raw_projection", """
SELECT event_id::VARCHAR AS _ingestion_id, ts AS _ingestion_timestamp, CAST(ts AS DATE) AS _ingestion_date,
       event_id::VARCHAR AS unique_key, event_type AS complaint_type, user_id::VARCHAR AS incident_zip,
       props AS raw_json FROM events""")
def raw_projection(spark, d):
    ev = tbl(spark, d, "events")
    mapping = [("_ingestion_id", F.col("event_id").cast("string")), ("_ingestion_timestamp", F.col("ts")),
               ("_ingestion_date", F.to_date("ts")), ("unique_key", F.col("event_id").cast("string")),
               ("complaint_type", F.col("event_type")), ("incident_zip", F.col("user_id").cast("string")),
               ("raw_json", F.col("props"))]
    return R.raw_projection(ev, mapping)


@register("cast_timestamps", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 2 THEN o_orderdate END AS parsed_at FROM orders""")
def cast_timestamps(spark, d):
    o = tbl(spark, d, "orders")
    k = F.col("o_orderkey") % 4
    txt = (F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
           .when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm"))
           .when(k == 2, F.lit("not a date")).otherwise(F.date_format("o_orderdate", "MM/dd/yyyy")))
    parsed = C.parse_timestamp(txt, "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "MM/dd/yyyy")
    return o.select("o_orderkey", parsed.alias("parsed_at"))


@register("combine_date_time", """
SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN o_orderdate WHEN 1 THEN NULL
       ELSE o_orderdate + to_seconds((o_orderkey * 37) % 86400) END AS occurred_at FROM orders""")
def combine_date_time(spark, d):
    o = tbl(spark, d, "orders")
    k = F.col("o_orderkey") % 7
    secs = (F.col("o_orderkey") * 37) % 86400
    tm = F.format_string("%02d:%02d:%02d", (secs / 3600).cast("int"), ((secs % 3600) / 60).cast("int"), secs % 60)
    tm = F.when(k == 0, F.lit(None).cast("string")).when(k == 1, F.lit("25:99:00")).otherwise(tm)
    return o.select("o_orderkey", C.combine_date_time(F.date_format("o_orderdate", "MM/dd/yyyy"), tm)
                    .alias("occurred_at"))


@register("local_to_utc", """
SELECT event_id, CASE user_id % 4 WHEN 0 THEN ts + INTERVAL 5 HOUR WHEN 1 THEN ts + INTERVAL 4 HOUR
       WHEN 2 THEN ts END AS ts_utc FROM events""")
def local_to_utc(spark, d):
    ev = tbl(spark, d, "events")
    k = F.col("user_id") % 4
    label = F.when(k == 0, "EST").when(k == 1, "EDT").when(k == 2, "GMT").otherwise("XYZ")
    return ev.select("event_id", C.local_to_utc("ts", label=label).alias("ts_utc"))


@register("surrogate_key", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey,
       md5(concat_ws('|', coalesce(l_orderkey::VARCHAR, ''), coalesce(l_linenumber::VARCHAR, ''),
           coalesce((CASE WHEN l_partkey % 10 <> 0 THEN l_suppkey END)::VARCHAR, ''))) AS line_sk
FROM lineitem""")
def surrogate_key(spark, d):
    li = tbl(spark, d, "lineitem")
    supp = F.when(F.col("l_partkey") % 10 != 0, F.col("l_suppkey"))
    return normalize(li.select("l_orderkey", "l_linenumber", "l_partkey",
                               C.surrogate_key("l_orderkey", "l_linenumber", supp).alias("line_sk")))


@register("staging_projection", """
SELECT md5(concat_ws('|', user_id::VARCHAR, event_id::VARCHAR)) AS status_event_id, user_id::VARCHAR AS line_id,
       ts AS observed_at, (floor(value)::BIGINT % 21) AS status_severity, CAST(value AS DECIMAL(18, 2)) AS amount
FROM events""")
def staging_projection(spark, d):
    ev = tbl(spark, d, "events")
    return ev.select(C.surrogate_key("user_id", "event_id").alias("status_event_id"),
                     F.col("user_id").cast("string").alias("line_id"), F.col("ts").alias("observed_at"),
                     (F.floor("value") % 21).cast("bigint").alias("status_severity"),
                     F.col("value").cast("decimal(18,2)").alias("amount"))


@register("time_trunc", """
SELECT event_id, date_trunc('hour', ts) AS event_hour, CAST(ts AS DATE) AS event_date FROM events""")
def time_trunc(spark, d):
    return tbl(spark, d, "events").select("event_id", C.hour_trunc("ts").alias("event_hour"),
                                          C.day_trunc("ts").alias("event_date"))


@register("calendar_features", """
SELECT event_id, hour(ts)::BIGINT AS hour_of_day, (dayofweek(ts) + 1)::BIGINT AS day_of_week,
       dayofweek(ts) IN (0, 6) AS is_weekend, month(ts)::BIGINT AS month FROM events""")
def calendar_features(spark, d):
    feats = C.calendar_features("ts")
    return normalize(tbl(spark, d, "events").select("event_id", *[c.alias(n) for n, c in feats.items()]))


# ---------------------------------------------------------------------------
# C: contracts
# ---------------------------------------------------------------------------

def _requests_from_customers(spark, d) -> DataFrame:
    c = tbl(spark, d, "customer")
    key = F.col("c_custkey")
    nk = F.col("c_nationkey") % 7
    return c.select(
        "c_custkey",
        F.when(key % 11 == 0, F.lit(None)).when(key % 11 == 1, F.lit("  ")).otherwise(key.cast("string"))
        .alias("unique_key"),
        F.when(key % 13 == 0, F.lit(None)).otherwise(F.lit("2024-01-01")).alias("created_date"),
        F.when(key % 5 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("complaint_type"),
        F.when(nk == 0, "MANHATTAN").when(nk == 1, "brooklyn").when(nk == 2, "Queens").when(nk == 3, "BRONX")
        .when(nk == 4, "staten island").when(nk == 5, "ATLANTIS").alias("borough"),
        F.when(key % 3 == 0, "n/a").otherwise("40.7").alias("latitude"),
        F.when(key % 4 == 0, F.lit(None)).otherwise("-73.9").alias("longitude"),
    )


_REQ_SQL = """(SELECT c_custkey,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 11 = 1 THEN '  ' ELSE c_custkey::VARCHAR END AS unique_key,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE '2024-01-01' END AS created_date,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS complaint_type,
  CASE c_nationkey % 7 WHEN 0 THEN 'MANHATTAN' WHEN 1 THEN 'brooklyn' WHEN 2 THEN 'Queens' WHEN 3 THEN 'BRONX'
       WHEN 4 THEN 'staten island' WHEN 5 THEN 'ATLANTIS' END AS borough,
  CASE WHEN c_custkey % 3 = 0 THEN 'n/a' ELSE '40.7' END AS latitude,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE '-73.9' END AS longitude
FROM customer)"""


def _errors_text(df: DataFrame) -> DataFrame:
    return df.withColumn("errors", F.array_join("validation_errors", "; ")).drop("validation_errors")


@register("validate_requests", f"""
SELECT c_custkey, NOT (nullif(trim(unique_key), '') IS NULL OR created_date IS NULL) AS is_valid,
  concat_ws('; ', CASE WHEN nullif(trim(unique_key), '') IS NULL THEN 'missing unique_key' END,
    CASE WHEN created_date IS NULL THEN 'missing created_date' END,
    CASE WHEN complaint_type IS NULL THEN 'missing complaint_type' END,
    CASE WHEN borough IS NOT NULL AND upper(borough) NOT IN ('MANHATTAN', 'BROOKLYN', 'QUEENS', 'BRONX', 'STATEN ISLAND')
         THEN 'unknown borough: ' || borough END) AS errors,
  latitude <> 'n/a' AND longitude IS NOT NULL AS has_location, borough IS NOT NULL AS has_borough
FROM {_REQ_SQL}""")
def validate_requests(spark, d):
    out = K.validate_requests(_requests_from_customers(spark, d))
    return _errors_text(out.select("c_custkey", "is_valid", "validation_errors", "has_location", "has_borough"))


@register("location_flags", f"""
SELECT c_custkey, latitude <> 'n/a' AND longitude IS NOT NULL AS has_location, borough IS NOT NULL AS has_borough
FROM {_REQ_SQL}""")
def location_flags(spark, d):
    flags = K.location_flags()
    return _requests_from_customers(spark, d).select("c_custkey", *[c.alias(n) for n, c in flags.items()])


@register("validate_incidents", """
SELECT s_suppkey, s_suppkey % 9 <> 0 AS is_valid,
  concat_ws('; ', CASE WHEN s_suppkey % 9 = 0 THEN 'missing cmplnt_num' END,
    CASE WHEN s_suppkey % 4 = 0 THEN 'missing cmplnt_fr_dt' END,
    CASE WHEN s_nationkey % 5 = 3 THEN 'unknown law_cat_cd: INFRACTION' END) AS errors
FROM supplier""")
def validate_incidents(spark, d):
    s = tbl(spark, d, "supplier")
    nk = F.col("s_nationkey") % 5
    inc = s.select(
        "s_suppkey",
        F.when(F.col("s_suppkey") % 9 != 0, F.col("s_suppkey").cast("string")).alias("cmplnt_num"),
        F.when(F.col("s_suppkey") % 4 == 0, F.lit("")).otherwise("03/15/2024").alias("cmplnt_fr_dt"),
        F.when(nk == 0, "FELONY").when(nk == 1, "misdemeanor").when(nk == 2, "VIOLATION")
        .when(nk == 3, "INFRACTION").alias("law_cat_cd"))
    return _errors_text(K.validate_incidents(inc).select("s_suppkey", "is_valid", "validation_errors"))


@register("validate_weather", """
SELECT event_id, event_id % 10 <> 0 AND user_id % 4 IN (0, 1) AS is_valid,
  concat_ws('; ', CASE WHEN event_id % 10 = 0 THEN 'missing observation_time' END,
    CASE WHEN user_id % 4 = 3 THEN 'missing city' END,
    CASE WHEN user_id % 4 = 2 THEN 'unknown city: paris' END) AS errors
FROM events""")
def validate_weather(spark, d):
    ev = tbl(spark, d, "events")
    k = F.col("user_id") % 4
    w = ev.select("event_id",
                  F.when(F.col("event_id") % 10 != 0, F.lit("2024-01-01T00:00")).alias("observation_time"),
                  F.when(k == 0, "nyc").when(k == 1, "london").when(k == 2, "paris").alias("city"))
    return _errors_text(K.validate_weather(w).select("event_id", "is_valid", "validation_errors"))


@register("validate_air", """
SELECT event_id, event_id % 17 <> 0 AS is_valid,
  concat_ws('; ', CASE WHEN event_id % 17 = 0 THEN 'missing parameter_name' END,
    CASE WHEN event_id % 19 = 0 THEN 'missing date_observed' END,
    CASE WHEN hour(ts) + user_id % 3 > 23 THEN 'invalid hour_observed: ' || (hour(ts) + user_id % 3)::VARCHAR END,
    CASE WHEN floor(value * 2) > 500 THEN 'aqi out of range: ' || floor(value * 2)::BIGINT::VARCHAR END) AS errors
FROM events""")
def validate_air(spark, d):
    ev = tbl(spark, d, "events")
    a = ev.select("event_id",
                  F.when(F.col("event_id") % 17 != 0, F.col("event_type")).alias("parameter_name"),
                  F.when(F.col("event_id") % 19 == 0, F.lit(" ")).otherwise("2024-01-01").alias("date_observed"),
                  (F.hour("ts") + F.col("user_id") % 3).cast("string").alias("hour_observed"),
                  F.floor(F.col("value") * 2).cast("string").alias("aqi"))
    return _errors_text(K.validate_air(a).select("event_id", "is_valid", "validation_errors"))


def _event_contract(ev: DataFrame) -> DataFrame:
    rules = [K.rule(F.col("value") > 300, "value above 300", hard=True),
             K.rule(F.col("event_type") == "error", "error event")]
    return K.apply_contract(ev, rules)


@register("quarantine_split", """
SELECT event_id, CASE WHEN value > 300 THEN 'quarantine' ELSE 'valid' END AS route,
  concat_ws('; ', CASE WHEN value > 300 THEN 'value above 300' END,
    CASE WHEN event_type = 'error' THEN 'error event' END) AS errors
FROM events""")
def quarantine_split(spark, d):
    annotated = _event_contract(tbl(spark, d, "events")).select("event_id", "validation_errors", "is_valid")
    valid, bad = K.split_valid(annotated)
    vpath, qpath = work_path(spark, "valid"), work_path(spark, "quarantine")
    valid.write.parquet(vpath)
    bad.write.parquet(qpath)
    back = (spark.read.parquet(vpath).withColumn("route", F.lit("valid"))
            .unionByName(spark.read.parquet(qpath).withColumn("route", F.lit("quarantine"))))
    return _errors_text(back.select("event_id", "route", "validation_errors"))


@register("run_accounting", """
SELECT CAST(ts AS DATE) AS run_date, count(*) AS records_read, count(*) FILTER (WHERE value <= 300) AS records_written,
  count(*) FILTER (WHERE value > 300) AS records_rejected,
  CASE WHEN count(*) FILTER (WHERE value > 300) = 0 THEN 'success' ELSE 'partial' END AS status
FROM events GROUP BY 1""")
def run_accounting(spark, d):
    ev = tbl(spark, d, "events").withColumn("run_date", F.to_date("ts"))
    return K.run_accounting(_event_contract(ev), ["run_date"])


@register("dry_run_counts", """
SELECT message, count(*) AS n_rows FROM (
  SELECT 'value above 300' AS message FROM events WHERE value > 300
  UNION ALL SELECT 'error event' FROM events WHERE event_type = 'error') GROUP BY 1""")
def dry_run_counts(spark, d):
    return K.error_counts(_event_contract(tbl(spark, d, "events")))


@register("dry_run", """
SELECT count(*) AS records_read, count(*) FILTER (WHERE value <= 300) AS records_valid,
  count(*) FILTER (WHERE value > 300) AS records_rejected FROM events""")
def dry_run(spark, d):
    """The contract run without a sink: nothing is written, the counts are
    observed on the pass."""
    counts = K.dry_run(_event_contract(tbl(spark, d, "events")))
    names = ["records_read", "records_valid", "records_rejected"]
    return spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} long" for n in names))
