"""Driver-table bindings for staging operators (E*, F4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from metroframe.functions import columns as C
from metroframe.operators import staging as S
from metroframe.plans.bind_ingest import tbl
from metroframe.plans.registry import normalize, register
from metroframe.sources.seeds import seed, seed_rows, values_sql

LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus"]


@register("dedup_latest", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY {', '.join(c + ' DESC' for c in LINE_ORDER)}) = 1""")
def dedup_latest(spark, d):
    return normalize(S.dedup_latest(tbl(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER))


@register("dedup_window", """
SELECT user_id, time_bucket(INTERVAL 30 MINUTE, ts) AS bucket_start, event_id, ts, event_type, value, props
FROM events QUALIFY row_number() OVER (PARTITION BY user_id, time_bucket(INTERVAL 30 MINUTE, ts)
  ORDER BY ts DESC, event_id DESC) = 1""")
def dedup_window(spark, d):
    return S.dedup_window(tbl(spark, d, "events"), "user_id", "ts", "30 minutes", order=["ts", "event_id"])


def _customers_missing_borough(spark, d):
    c = tbl(spark, d, "customer")
    raw = F.when(F.col("c_custkey") % 7 != 0, F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")))
    return c.select("c_custkey", "c_nationkey", raw.alias("borough"))


_CUST_SQL = """(SELECT c_custkey, c_nationkey,
  CASE WHEN c_custkey % 7 <> 0 THEN 'nation ' || c_nationkey::VARCHAR END AS borough FROM customer)"""


@register("fill_from_lookup", f"""
SELECT c_custkey, coalesce(upper(borough), n_name) AS borough
FROM {_CUST_SQL} c LEFT JOIN nation ON c.c_nationkey = n_nationkey""")
def fill_from_lookup(spark, d):
    c = _customers_missing_borough(spark, d)
    n = tbl(spark, d, "nation")
    out = S.fill_from_lookup(c, n, c["c_nationkey"], "n_nationkey", "borough", "n_name")
    return out.select("c_custkey", "borough")


def _nation_region(spark, d):
    n, r = tbl(spark, d, "nation"), tbl(spark, d, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"], "left").select("n_nationkey", "n_name", "r_name")


@register("neighborhood_lookup", f"""
SELECT c_custkey, coalesce(upper(borough), n_name) AS borough, r_name AS neighborhood
FROM {_CUST_SQL} c LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region
  ON n_regionkey = r_regionkey) l ON c.c_nationkey = l.n_nationkey""")
def neighborhood_lookup(spark, d):
    c = _customers_missing_borough(spark, d)
    lk = _nation_region(spark, d)
    out = S.fill_from_lookup(c, lk, c["c_nationkey"], "n_nationkey", "borough", "n_name", carry=["r_name"])
    return out.select("c_custkey", "borough", F.col("r_name").alias("neighborhood"))


@register("community_board_lookup", """
SELECT s_suppkey, s_nationkey::VARCHAR AS community_board, n_name AS neighborhoods
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")
def community_board_lookup(spark, d):
    s = tbl(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("community_board"))
    boards = tbl(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("board"),
                                            F.col("n_name").alias("neighborhoods"))
    return S.lookup(s, boards, "community_board", "board").select("s_suppkey", "community_board", "neighborhoods")


_SEV = values_sql(seed_rows("tfl_severity_lookup"), ["severity_code", "severity_description", "is_disrupted"])


@register("severity_lookup", f"""
SELECT event_id, user_id % 25 AS severity_code, coalesce(t.severity_description, 'Unknown') AS severity_description,
       coalesce(t.is_disrupted, FALSE) AS is_disrupted
FROM events LEFT JOIN {_SEV} ON user_id % 25 = t.severity_code""")
def severity_lookup(spark, d):
    ev = tbl(spark, d, "events").select("event_id", (F.col("user_id") % 25).alias("code"))
    sev = seed(spark, "tfl_severity_lookup")
    out = S.lookup(ev, sev, "code", "severity_code")
    return out.select("event_id", F.col("code").alias("severity_code"),
                      F.coalesce("severity_description", F.lit("Unknown")).alias("severity_description"),
                      F.coalesce("is_disrupted", F.lit(False)).alias("is_disrupted"))


_WMO = values_sql(seed_rows("wmo_weather_code_lookup"), ["wmo_code", "description", "category", "is_precipitation"])


@register("weather_lookup", f"""
SELECT event_id, floor(value)::BIGINT % 100 AS wmo_code, t.description AS weather_description,
       t.category AS weather_category, t.is_precipitation AS seed_is_precipitation
FROM events LEFT JOIN {_WMO} ON floor(value)::BIGINT % 100 = t.wmo_code""")
def weather_lookup(spark, d):
    ev = tbl(spark, d, "events").select("event_id", (F.floor("value") % 100).alias("code"))
    wmo = seed(spark, "wmo_weather_code_lookup")
    out = S.lookup(ev, wmo, "code", "wmo_code")
    return out.select("event_id", F.col("code").alias("wmo_code"), F.col("description").alias("weather_description"),
                      F.col("category").alias("weather_category"),
                      F.col("is_precipitation").alias("seed_is_precipitation"))


@register("precip_flag", """
SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN value / 100 END AS precipitation_mm,
       coalesce(CASE WHEN event_id % 11 <> 0 THEN value / 100 END > 0.1, FALSE) AS is_precipitation FROM events""")
def precip_flag(spark, d):
    ev = tbl(spark, d, "events")
    mm = F.when(F.col("event_id") % 11 != 0, F.col("value") / 100)
    return ev.select("event_id", mm.alias("precipitation_mm"), S.precip_flag(mm).alias("is_precipitation"))


POLLUTANTS = ["click", "purchase", "signup", "view"]


def _air_obs(spark, d):
    """events as air-quality observations: area = user % 5, parameter =
    event type, AQI = floor(value); out-of-range AQI dropped (D7)."""
    ev = tbl(spark, d, "events")
    aqi = S.valid_aqi(F.floor("value").cast("bigint"))
    band = F.when(F.col("event_id") % 9 != 0, S.aqi_band(aqi))
    return (ev.select((F.col("user_id") % 5).alias("area"), C.hour_trunc("ts").alias("obs_hour"),
                      F.col("event_type").alias("param"), aqi.alias("aqi"), band.alias("category_name"))
            .filter(F.col("aqi").isNotNull()))


_AIR_SQL = """(SELECT user_id % 5 AS area, date_trunc('hour', ts) AS obs_hour, event_type AS param,
  floor(value)::BIGINT AS aqi, event_id FROM events WHERE floor(value) BETWEEN 0 AND 500)"""


@register("pollutant_pivot", f"""
SELECT area, obs_hour, {', '.join(f"max(aqi) FILTER (WHERE param = '{p}') AS {p}_aqi" for p in POLLUTANTS)}
FROM {_AIR_SQL} GROUP BY ALL""")
def pollutant_pivot(spark, d):
    return S.pivot_measures(_air_obs(spark, d), ["area", "obs_hour"], "param", "aqi", POLLUTANTS, overall=None)


@register("overall_aqi", f"SELECT area, obs_hour, max(aqi) AS overall_aqi FROM {_AIR_SQL} GROUP BY ALL")
def overall_aqi(spark, d):
    return S.pivot_measures(_air_obs(spark, d), ["area", "obs_hour"], "param", "aqi", [], overall="overall_aqi")


@register("dominant_pollutant", f"""
SELECT area, obs_hour, first(param ORDER BY aqi DESC, param DESC) AS dominant_pollutant FROM {_AIR_SQL} GROUP BY ALL""")
def dominant_pollutant(spark, d):
    return S.pivot_measures(_air_obs(spark, d), ["area", "obs_hour"], "param", "aqi", [], overall=None,
                            argmax="dominant_pollutant")


_BAND_SQL = ("CASE WHEN {a} <= 50 THEN 'Good' WHEN {a} <= 100 THEN 'Moderate' WHEN {a} <= 150 THEN "
             "'Unhealthy for Sensitive Groups' WHEN {a} <= 200 THEN 'Unhealthy' WHEN {a} <= 300 THEN "
             "'Very Unhealthy' WHEN {a} <= 500 THEN 'Hazardous' END")


@register("aqi_category", f"""
SELECT area, obs_hour, coalesce(first(CASE WHEN event_id % 9 <> 0 THEN {_BAND_SQL.format(a='aqi')} END
  ORDER BY aqi DESC, param DESC), {_BAND_SQL.format(a='max(aqi)')}) AS aqi_category
FROM {_AIR_SQL} GROUP BY ALL""")
def aqi_category(spark, d):
    worst = S.worst_category("category_name", "aqi", "param")
    out = S.pivot_measures(_air_obs(spark, d), ["area", "obs_hour"], "param", "aqi", [], overall="_max",
                           extra_aggs=[worst.alias("_worst")])
    return out.select("area", "obs_hour", F.coalesce("_worst", S.aqi_band(F.col("_max"))).alias("aqi_category"))


@register("area_to_city", """
SELECT event_id, CASE user_id % 4 WHEN 0 THEN 'New York City - Manhattan' WHEN 1 THEN 'NYC Queens'
  WHEN 2 THEN 'London Central' ELSE 'Boston' END AS reporting_area,
  CASE user_id % 4 WHEN 0 THEN 'nyc' WHEN 1 THEN 'nyc' WHEN 2 THEN 'london' END AS city FROM events""")
def area_to_city(spark, d):
    k = F.col("user_id") % 4
    area = (F.when(k == 0, "New York City - Manhattan").when(k == 1, "NYC Queens")
            .when(k == 2, "London Central").otherwise("Boston"))
    ev = tbl(spark, d, "events").select("event_id", area.alias("reporting_area"))
    return ev.withColumn("city", S.area_to_city("reporting_area"))


@register("arrivals_clean", """
SELECT md5(concat_ws('|', user_id::VARCHAR, event_type, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S')))
         AS arrival_event_id, user_id::VARCHAR AS vehicle_id, event_type AS stop_point_id,
       date_trunc('hour', ts) AS expected_arrival_at, floor(value)::BIGINT AS time_to_station_seconds, ts AS observed_at
FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type, date_trunc('hour', ts)
  ORDER BY ts DESC, event_id DESC) = 1""")
def arrivals_clean(spark, d):
    ev = tbl(spark, d, "events")
    raw = ev.select(F.col("user_id").cast("string").alias("vehicle_id"), F.col("event_type").alias("stop_point_id"),
                    F.date_format(C.hour_trunc("ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("expected_arrival"),
                    F.floor("value").cast("bigint").alias("time_to_station_seconds"),
                    F.col("ts").alias("observed_at"), "event_id")
    latest = S.dedup_latest(raw, ["vehicle_id", "stop_point_id", "expected_arrival"], ["observed_at", "event_id"])
    return latest.select(
        C.surrogate_key("vehicle_id", "stop_point_id", "expected_arrival").alias("arrival_event_id"),
        "vehicle_id", "stop_point_id", C.parse_timestamp("expected_arrival").alias("expected_arrival_at"),
        "time_to_station_seconds", "observed_at")


# Written independently of the library's rule tables (RE2 syntax): specific
# identifiers first, so that a longer digit pattern cannot swallow them.
_MASK_SQL = """
regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
  '\\b[[:alnum:]._%+-]+@[[:alnum:]-]+(\\.[[:alnum:]-]+)*\\.[[:alpha:]]{2,}\\b', '[EMAIL]', 'g'),
  '\\b\\d\\d\\d-\\d\\d-\\d\\d\\d\\d\\b', '[SSN]', 'g'),
  '(\\+\\d{1,3}[ .-]?)?(\\(\\d{3}\\) ?|\\b\\d{3}[ .-])\\d{3}[ .-]\\d{4}\\b', '[PHONE]', 'g'),
  '\\b\\d{1,6} [[:alpha:]]+ (Street|St|Avenue|Ave|Road|Rd|Boulevard|Blvd|Lane|Ln)\\b', '[ADDRESS]', 'g')"""


@register("pii_mask", f"SELECT doc_id, {_MASK_SQL} AS masked_text FROM documents")
def pii_mask(spark, d):
    return tbl(spark, d, "documents").select("doc_id", S.mask_text("text").alias("masked_text"))


PII_SALT = "metroframe-pii"


@register("pii_drop", f"""
SELECT c_custkey, c_nationkey::BIGINT AS c_nationkey, c_mktsegment, sha256('{PII_SALT}' || c_name) AS name_token
FROM customer""")
def pii_drop(spark, d):
    c = tbl(spark, d, "customer").withColumn("name_token", S.pseudonymize("c_name", PII_SALT))
    tagged = S.tag_pii(c, {"c_name": "direct", "c_acctbal": "adjacent"})
    return normalize(S.assert_no_pii(S.drop_pii(tagged)))


# Written independently of the library's rule tables, as whole words.
_REASON_SQL = """
WITH d AS (SELECT doc_id, ' ' || regexp_replace(lower(text), '[^\\p{L}\\p{N}_ ]', '.', 'g') || ' ' AS t,
  regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS w FROM documents)
SELECT doc_id, CASE
  WHEN list_has_any(w, ['planned', 'engineering', 'works', 'closure', 'closures', 'maintenance']) THEN 'planned'
  WHEN list_has_any(w, ['strike', 'strikes', 'staff', 'staffing', 'crew', 'crews']) OR regexp_matches(t, '[ .]industrial action[ .]') THEN 'staffing'
  WHEN list_has_any(w, ['signal', 'signals', 'signalling']) OR regexp_matches(t, '[ .](points? (failure|fault)|track circuit|train fault|faulty train|power (failure|supply|cut))[ .]')
    THEN 'signal_failure'
  WHEN list_has_any(w, ['weather', 'flood', 'floods', 'flooding', 'flooded', 'snow', 'ice', 'icy', 'storm', 'storms', 'heat', 'rain', 'wind', 'winds', 'fog'])
    THEN 'weather'
  ELSE 'unknown' END AS disruption_category FROM d"""


@register("classify_reason", _REASON_SQL)
def classify_reason(spark, d):
    return tbl(spark, d, "documents").select("doc_id", S.classify_reason("text").alias("disruption_category"))
