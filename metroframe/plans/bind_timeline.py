"""Driver-table bindings for the intermediate layer (F*).

The ``events`` table plays every city domain at once (the same derivation is
written twice: as DataFrame code here and as SQL CTEs for the oracle):

* city = 'nyc' for even user ids, 'london' for odd ones; hour = ts truncated;
* weather: 'view' events (temperature = value / 10, precipitation = value / 100,
  WMO code = floor(max value) % 100);
* air quality: every event, parameter = event type, AQI = floor(value);
* service requests: 'purchase' and 'click' events ('click' = noise);
  incidents: 'error' events of nyc users;
* transit: each london user is a line, every event a poll, an 'error' poll is
  disrupted; severity 6 above value 100, else 9; 10 when not disrupted.

Service requests for SLA work are ``orders`` (created = order date, closed =
last ship date of the order's lines, open when it has none).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroframe.functions import columns as C
from metroframe.operators import marts as M
from metroframe.operators import staging as S
from metroframe.operators import timeline as TL
from metroframe.plans.bind_ingest import tbl
from metroframe.plans.bind_staging import _BAND_SQL, _WMO
from metroframe.plans.registry import normalize, register
from metroframe.sources.seeds import seed

# ---------------------------------------------------------------------------
# City model: DataFrame side
# ---------------------------------------------------------------------------

# Synthetic disruption reasons by poll value (binding only).
REASON_BY_VALUE = [(250, "Signal failure"), (150, "Heavy rain and flooding"), (50, "Planned engineering works")]
REASON_ELSE = "Staff shortage"
RAIN_RELATED_MM = 2.5


def city_events(spark, d) -> DataFrame:
    ev = tbl(spark, d, "events")
    return ev.withColumns({
        "city": F.when(F.col("user_id") % 2 == 0, F.lit("nyc")).otherwise(F.lit("london")),
        "event_hour": C.hour_trunc("ts"),
        "event_date": F.to_date("ts"),
    })


def weather_hourly(ev: DataFrame) -> DataFrame:
    return (ev.filter(F.col("event_type") == "view").groupBy("city", "event_hour")
            .agg(S.exact_mean("value", 2, 10.0).alias("temperature_c"),
                 F.round(F.max("value") / 100, 4).alias("precipitation_mm"),
                 (F.floor(F.max("value")) % 100).cast("bigint").alias("weather_code")))


def air_obs(ev: DataFrame) -> DataFrame:
    aqi = S.valid_aqi(F.floor("value").cast("bigint"))
    return (ev.select("city", "event_hour", "event_date", F.col("event_type").alias("param"), aqi.alias("aqi"))
            .filter(F.col("aqi").isNotNull()))


def air_hourly(ev: DataFrame) -> DataFrame:
    return S.pivot_measures(air_obs(ev), ["city", "event_hour"], "param", "aqi", [], overall="overall_aqi",
                            argmax="dominant_pollutant")


def request_counts(ev: DataFrame) -> DataFrame:
    t = F.col("event_type")
    return M.conditional_counts(ev, ["city", "event_hour"], {
        "requests_count": t.isin("purchase", "click"), "noise_count": t == "click", "incidents_count": t == "error"})


def hourly_all(ev: DataFrame) -> DataFrame:
    """Weather, air quality and counts per city and hour as conditional
    aggregates: one scan and one shuffle for all domains."""
    view = F.when(F.col("event_type") == "view", F.col("value"))
    aqi = S.valid_aqi(F.floor("value").cast("bigint"))
    t = F.col("event_type")
    return ev.groupBy("city", "event_hour").agg(
        S.exact_mean(view, 2, 10.0).alias("temperature_c"), F.round(F.max(view) / 100, 4).alias("precipitation_mm"),
        (F.floor(F.max(view)) % 100).cast("bigint").alias("weather_code"), F.max(aqi).alias("overall_aqi"),
        F.count_if(t.isin("purchase", "click")).alias("requests_count"), F.count_if(t == "click").alias("noise_count"),
        F.count_if(t == "error").alias("incidents_count"))


def line_polls(spark, d) -> DataFrame:
    ev = tbl(spark, d, "events")
    v = F.col("value")
    disrupted = F.col("event_type") == "error"
    reason = None
    for lo, text in REASON_BY_VALUE:
        reason = F.when(v > lo, F.lit(text)) if reason is None else reason.when(v > lo, F.lit(text))
    return ev.select(
        F.col("user_id").alias("line_id"), "ts", disrupted.alias("disrupted"),
        F.when(~disrupted, F.lit(10)).when(v > 100, F.lit(6)).otherwise(F.lit(9)).alias("severity"),
        reason.otherwise(F.lit(REASON_ELSE)).alias("reason"))


def line_episodes(spark, d, carry=None) -> DataFrame:
    eps = TL.episodes(line_polls(spark, d), "line_id", "ts", "disrupted", extra_state=["severity"], carry=carry)
    return eps.withColumnRenamed("severity", "severity_level")


# ---------------------------------------------------------------------------
# City model: SQL side (oracle)
# ---------------------------------------------------------------------------

EV = """ev AS (SELECT *, CASE WHEN user_id % 2 = 0 THEN 'nyc' ELSE 'london' END AS city,
  date_trunc('hour', ts) AS event_hour, CAST(ts AS DATE) AS event_date FROM events)"""
WH = """wh AS (SELECT city, event_hour, sum(round(value * 100)::BIGINT) / (count(value) * 1000.0::DOUBLE) AS temperature_c,
  round(max(value) / 100, 4) AS precipitation_mm, floor(max(value))::BIGINT % 100 AS weather_code
  FROM ev WHERE event_type = 'view' GROUP BY city, event_hour)"""
AO = """ao AS (SELECT city, event_hour, event_date, event_type AS param, floor(value)::BIGINT AS aqi
  FROM ev WHERE floor(value) BETWEEN 0 AND 500)"""
AH = """ah AS (SELECT city, event_hour, max(aqi) AS overall_aqi,
  first(param ORDER BY aqi DESC, param DESC) AS dominant_pollutant FROM ao GROUP BY city, event_hour)"""
RC = """rc AS (SELECT city, event_hour, count(*) FILTER (WHERE event_type IN ('purchase', 'click')) AS requests_count,
  count(*) FILTER (WHERE event_type = 'click') AS noise_count,
  count(*) FILTER (WHERE event_type = 'error') AS incidents_count FROM ev GROUP BY city, event_hour)"""
SP = """sp AS (SELECT city, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS event_hour
  FROM (SELECT city, min(event_hour) AS lo, max(event_hour) AS hi FROM ev GROUP BY city))"""
_REASON_CASE = ("CASE " + " ".join(f"WHEN value > {lo} THEN '{t}'" for lo, t in REASON_BY_VALUE)
                + f" ELSE '{REASON_ELSE}' END")
EP = f"""polls AS (SELECT user_id AS line_id, ts, event_type = 'error' AS disrupted,
  CASE WHEN event_type <> 'error' THEN 10 WHEN value > 100 THEN 6 ELSE 9 END AS severity,
  {_REASON_CASE} AS reason FROM events),
chg AS (SELECT *, lag(disrupted) OVER w AS pd, lag(severity) OVER w AS ps,
  max(ts) OVER (PARTITION BY line_id) AS last_seen_at FROM polls WINDOW w AS (PARTITION BY line_id ORDER BY ts)),
runs AS (SELECT line_id, disrupted, severity, reason, ts AS started_at,
  lead(ts) OVER (PARTITION BY line_id ORDER BY ts) AS ended_at, last_seen_at
  FROM chg WHERE pd IS NULL OR pd <> disrupted OR ps <> severity),
ep AS (SELECT line_id, severity::BIGINT AS severity_level, reason, started_at, ended_at, last_seen_at,
  (epoch_us(ended_at) - epoch_us(started_at)) // 60000000 AS duration_minutes FROM runs WHERE disrupted)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------------------
# Requests from orders
# ---------------------------------------------------------------------------

def order_requests(spark, d) -> DataFrame:
    o = tbl(spark, d, "orders")
    closed = tbl(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("closed_at"))
    return (o.join(closed, o["o_orderkey"] == closed["l_orderkey"], "left")
            .select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("created_at"), "closed_at",
                    F.col("o_orderpriority").alias("complaint_type")))


REQ = """req AS (SELECT o_orderkey, o_custkey, o_orderdate AS created_at, c.closed_at, o_orderpriority AS complaint_type
  FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS closed_at FROM lineitem GROUP BY l_orderkey) c
  ON o_orderkey = c.l_orderkey),
res AS (SELECT *, closed_at IS NULL AS is_open, CASE WHEN closed_at >= created_at
  THEN round((epoch_us(closed_at) - epoch_us(created_at)) / 3600000000.0, 4) END AS hours_to_close FROM req)"""


@register("resolution_hours", with_ctes(REQ) + "SELECT o_orderkey, is_open, hours_to_close FROM res")
def resolution_hours(spark, d):
    r = order_requests(spark, d)
    return r.select("o_orderkey", *[c.alias(n) for n, c in M.resolution().items()])


@register("enrich_hourly", with_ctes(EV, WH, AO, AH) + """
SELECT event_id, ev.city, ev.event_hour, temperature_c, precipitation_mm, overall_aqi
FROM ev LEFT JOIN wh USING (city, event_hour) LEFT JOIN ah USING (city, event_hour)
WHERE event_type IN ('purchase', 'click')""")
def enrich_hourly(spark, d):
    ev = city_events(spark, d)
    req = ev.filter(F.col("event_type").isin("purchase", "click")).select("event_id", "city", "event_hour")
    hourly = hourly_all(ev).select("city", "event_hour", "temperature_c", "precipitation_mm", "overall_aqi")
    return M.enrich_left(req, [hourly], ["city", "event_hour"])


def _zip_seed_sql() -> str:
    from metroframe.sources.seeds import seed_rows, values_sql
    return values_sql(seed_rows("borough_zip_lookup"), ["zip_code", "borough_name", "neighborhood"])


@register("complaints_enriched", with_ctes(EV, WH, AO, AH) + f"""
, req AS (SELECT event_id, city, event_hour, event_date, ts, event_type, user_id, value,
  CASE WHEN value < 300 THEN ts + to_minutes(floor(value)::BIGINT) END AS closed_at,
  (10000 + user_id)::VARCHAR AS incident_zip,
  CASE WHEN user_id % 3 <> 0 THEN 'queens' END AS borough_raw
  FROM ev WHERE event_type IN ('purchase', 'click'))
SELECT md5(event_id::VARCHAR) AS complaint_id, ts AS created_at, req.event_hour AS complaint_hour,
  req.event_date AS complaint_date, event_type AS complaint_type, incident_zip,
  coalesce(upper(borough_raw), z.borough_name) AS borough, z.neighborhood AS neighborhood,
  closed_at IS NULL AS is_open,
  CASE WHEN closed_at >= ts THEN round((epoch_us(closed_at) - epoch_us(ts)) / 3600000000.0, 4) END AS hours_to_close,
  wh.temperature_c AS weather_temperature_c, wh.precipitation_mm AS weather_precipitation_mm,
  w.description AS weather_description, ah.overall_aqi AS air_quality_aqi,
  {_BAND_SQL.format(a='ah.overall_aqi')} AS air_quality_category
FROM req LEFT JOIN {_zip_seed_sql().replace(') AS t(', ') AS z(')} ON substr(incident_zip, 1, 5) = z.zip_code
LEFT JOIN wh ON req.city = wh.city AND req.event_hour = wh.event_hour
LEFT JOIN {_WMO.replace(') AS t(', ') AS w(')} ON wh.weather_code = w.wmo_code
LEFT JOIN ah ON req.city = ah.city AND req.event_hour = ah.event_hour""")
def complaints_enriched(spark, d):
    ev = city_events(spark, d)
    req = ev.filter(F.col("event_type").isin("purchase", "click")).select(
        "event_id", "city", "event_hour", "event_date", "ts", "event_type",
        F.when(F.col("value") < 300, F.col("ts") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.floor("value").cast("int"), F.lit(0))).alias("closed_at"),
        (F.lit(10000) + F.col("user_id")).cast("string").alias("incident_zip"),
        F.when(F.col("user_id") % 3 != 0, F.lit("queens")).alias("borough_raw"))
    zips = seed(spark, "borough_zip_lookup")
    req = S.fill_from_lookup(req, zips, S.zip5(req["incident_zip"]), "zip_code", "borough_raw", "borough_name",
                             carry=["neighborhood"], out="borough").drop("borough_raw")
    hourly = hourly_all(ev).select("city", "event_hour", "temperature_c", "precipitation_mm", "weather_code", "overall_aqi")
    wmo = seed(spark, "wmo_weather_code_lookup").select("wmo_code", F.col("description").alias("weather_description"))
    out = req.join(S.lookup(hourly, wmo, "weather_code", "wmo_code"), ["city", "event_hour"], "left")
    res = M.resolution("ts", "closed_at")
    return out.select(
        C.surrogate_key("event_id").alias("complaint_id"), F.col("ts").alias("created_at"),
        F.col("event_hour").alias("complaint_hour"), F.col("event_date").alias("complaint_date"),
        F.col("event_type").alias("complaint_type"), "incident_zip", "borough", "neighborhood",
        res["is_open"].alias("is_open"), res["hours_to_close"].alias("hours_to_close"),
        F.col("temperature_c").alias("weather_temperature_c"),
        F.col("precipitation_mm").alias("weather_precipitation_mm"), "weather_description",
        F.col("overall_aqi").alias("air_quality_aqi"), S.aqi_band(F.col("overall_aqi")).alias("air_quality_category"))


# ---------------------------------------------------------------------------
# Transit episodes
# ---------------------------------------------------------------------------

@register("disruption_episodes", with_ctes(EP) + """
SELECT line_id, severity_level, started_at, ended_at, last_seen_at, duration_minutes FROM ep""")
def disruption_episodes(spark, d):
    return normalize(line_episodes(spark, d))


EPW = f"""cat AS (SELECT *, CASE reason WHEN 'Signal failure' THEN 'signal_failure' WHEN 'Heavy rain and flooding' THEN 'weather'
  WHEN 'Planned engineering works' THEN 'planned' ELSE 'staffing' END AS disruption_category FROM ep),
epw AS (SELECT cat.*, wh.precipitation_mm AS weather_precipitation_mm,
  CASE WHEN disruption_category = 'planned' THEN FALSE
       ELSE disruption_category = 'weather' OR coalesce(wh.precipitation_mm >= {RAIN_RELATED_MM}, FALSE) END
    AS is_weather_related
  FROM cat LEFT JOIN wh ON wh.city = 'london' AND wh.event_hour = date_trunc('hour', started_at))"""


def episodes_with_weather(spark, d) -> DataFrame:
    """Episodes with their reason category, the precipitation of the start
    hour and is_weather_related (F4, F5, D10): 'planned' reasons never count,
    'weather' reasons always, otherwise heavy rain in the start hour."""
    eps = line_episodes(spark, d, carry=["reason"]).withColumn("disruption_category", S.classify_reason("reason"))
    wh = weather_hourly(city_events(spark, d)).filter(F.col("city") == "london")
    joined = eps.join(wh, C.hour_trunc(eps["started_at"]) == wh["event_hour"], "left")
    related = M.weather_related("disruption_category", "precipitation_mm", RAIN_RELATED_MM)
    return joined.select(*eps.columns, F.col("precipitation_mm").alias("weather_precipitation_mm"),
                         related.alias("is_weather_related"))


@register("weather_related", with_ctes(EV, WH, EP, EPW) + """
SELECT line_id, started_at, disruption_category, weather_precipitation_mm, is_weather_related FROM epw""")
def weather_related(spark, d):
    return episodes_with_weather(spark, d).select("line_id", "started_at", "disruption_category",
                                                   "weather_precipitation_mm", "is_weather_related")


def hourly_disruptions(spark, d) -> DataFrame:
    return TL.lines_per_hour(line_episodes(spark, d), "line_id")


DL = """dl AS (SELECT event_hour, count(DISTINCT line_id) AS disrupted_lines,
  array_to_string(list_sort(list_distinct(list(line_id::VARCHAR))), ',') AS disrupted_line_ids
  FROM (SELECT line_id, unnest(generate_series(date_trunc('hour', started_at),
      greatest(date_trunc('hour', started_at), date_trunc('hour', coalesce(ended_at, last_seen_at) - INTERVAL 1 MICROSECOND)),
      INTERVAL 1 HOUR)) AS event_hour FROM ep) GROUP BY event_hour)"""


@register("disrupted_lines_list", with_ctes(EP, DL) + "SELECT * FROM dl")
def disrupted_lines_list(spark, d):
    return hourly_disruptions(spark, d)


# ---------------------------------------------------------------------------
# Hourly air quality
# ---------------------------------------------------------------------------

@register("rolling_24h", with_ctes(EV, AO, AH) + """
SELECT city, event_hour, overall_aqi, round(avg(overall_aqi) OVER (PARTITION BY city ORDER BY event_hour
  RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW), 4) AS aqi_24h_rolling_avg FROM ah""")
def rolling_24h(spark, d):
    ah = air_hourly(city_events(spark, d))
    return ah.select("city", "event_hour", "overall_aqi",
                     F.round(TL.rolling_mean_hours("city", "event_hour", "overall_aqi", 24), 4)
                     .alias("aqi_24h_rolling_avg"))


@register("daily_peak", with_ctes(EV, AO, AH) + """
SELECT city, event_hour, overall_aqi, max(overall_aqi) OVER (PARTITION BY city, CAST(event_hour AS DATE))
  AS daily_peak_aqi FROM ah""")
def daily_peak(spark, d):
    ah = air_hourly(city_events(spark, d)).withColumn("_day", F.to_date("event_hour"))
    return ah.select("city", "event_hour", "overall_aqi",
                     TL.partition_max("overall_aqi", "city", "_day").alias("daily_peak_aqi"))


_ADVISORY_SQL = ("CASE WHEN {a} <= 100 THEN 'None' WHEN {a} <= 150 THEN 'Sensitive Groups' "
                 "WHEN {a} <= 200 THEN 'All Groups' WHEN {a} IS NOT NULL THEN 'Avoid Outdoor' END")


@register("health_advisory", with_ctes(EV, AO, AH) + f"""
SELECT city, event_hour, overall_aqi, {_ADVISORY_SQL.format(a='overall_aqi')} AS health_advisory FROM ah""")
def health_advisory(spark, d):
    ah = air_hourly(city_events(spark, d))
    return ah.select("city", "event_hour", "overall_aqi", M.health_advisory("overall_aqi").alias("health_advisory"))


@register("air_quality_indexed", with_ctes(EV, AO, AH) + f"""
SELECT md5(city || '|' || strftime(event_hour, '%Y-%m-%d %H:%M:%S')) AS observation_id, event_hour AS observed_at,
  CAST(event_hour AS DATE) AS observation_date, city, overall_aqi, {_BAND_SQL.format(a='overall_aqi')} AS aqi_category,
  round(avg(overall_aqi) OVER (PARTITION BY city ORDER BY event_hour
    RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW), 4) AS aqi_24h_rolling_avg,
  max(overall_aqi) OVER (PARTITION BY city, CAST(event_hour AS DATE)) AS daily_peak_aqi,
  dominant_pollutant, {_ADVISORY_SQL.format(a='overall_aqi')} AS health_advisory FROM ah""")
def air_quality_indexed(spark, d):
    return M.air_quality_indexed(air_hourly(city_events(spark, d)))


# ---------------------------------------------------------------------------
# Spine, counts, cross-domain hourly
# ---------------------------------------------------------------------------

@register("hour_spine", with_ctes(EV, SP) + "SELECT city, event_hour FROM sp")
def hour_spine(spark, d):
    return TL.hour_spine(city_events(spark, d), "city", "event_hour")


@register("hourly_counts", with_ctes(EV, RC) + "SELECT * FROM rc")
def hourly_counts(spark, d):
    return request_counts(city_events(spark, d))


@register("cross_domain_hourly", with_ctes(EV, SP, WH, AO, AH, RC, EP, DL) + f"""
SELECT md5(sp.city || '|' || strftime(sp.event_hour, '%Y-%m-%d %H:%M:%S')) AS cross_domain_id, sp.event_hour,
  CAST(sp.event_hour AS DATE) AS event_date, sp.city, wh.temperature_c AS temperature_celsius,
  wh.precipitation_mm, w.description AS weather_description, ah.overall_aqi,
  {_BAND_SQL.format(a='ah.overall_aqi')} AS aqi_category,
  CASE WHEN sp.city = 'nyc' THEN coalesce(rc.requests_count, 0) END AS nyc_311_complaints_count,
  CASE WHEN sp.city = 'nyc' THEN coalesce(rc.noise_count, 0) END AS nyc_311_noise_complaints,
  CASE WHEN sp.city = 'nyc' THEN coalesce(rc.incidents_count, 0) END AS nyc_crime_incidents_count,
  CASE WHEN sp.city = 'london' THEN coalesce(dl.disrupted_lines, 0) END AS london_transit_disruptions,
  CASE WHEN sp.city = 'london' THEN dl.disrupted_line_ids END AS london_transit_disrupted_lines
FROM sp LEFT JOIN wh ON sp.city = wh.city AND sp.event_hour = wh.event_hour
LEFT JOIN {_WMO.replace(') AS t(', ') AS w(')} ON wh.weather_code = w.wmo_code
LEFT JOIN ah ON sp.city = ah.city AND sp.event_hour = ah.event_hour
LEFT JOIN rc ON sp.city = rc.city AND sp.event_hour = rc.event_hour
LEFT JOIN dl ON sp.event_hour = dl.event_hour""")
def cross_domain_hourly(spark, d):
    return cross_domain_frame(spark, d)


def cross_domain_frame(spark, d) -> DataFrame:
    """int_cross_domain_hourly: the (city, hour) spine left-joined to the
    domains' hourly aggregate and the disrupted lines, both unique per
    (city, hour) — no fan-out."""
    hourly = hourly_all(city_events(spark, d))
    sp = TL.hour_spine(hourly, "city", "event_hour")
    wmo = seed(spark, "wmo_weather_code_lookup").select("wmo_code", F.col("description").alias("weather_description"))
    dl = hourly_disruptions(spark, d).withColumn("city", F.lit("london"))
    out = sp.join(hourly, ["city", "event_hour"], "left").join(dl, ["city", "event_hour"], "left")
    out = S.lookup(out, wmo, "weather_code", "wmo_code")
    nyc = F.col("city") == "nyc"
    london = F.col("city") == "london"
    return out.select(
        C.surrogate_key("city", F.date_format("event_hour", "yyyy-MM-dd HH:mm:ss")).alias("cross_domain_id"),
        "event_hour", F.to_date("event_hour").alias("event_date"), "city",
        F.col("temperature_c").alias("temperature_celsius"), "precipitation_mm", "weather_description",
        "overall_aqi", S.aqi_band(F.col("overall_aqi")).alias("aqi_category"),
        F.when(nyc, F.coalesce("requests_count", F.lit(0))).alias("nyc_311_complaints_count"),
        F.when(nyc, F.coalesce("noise_count", F.lit(0))).alias("nyc_311_noise_complaints"),
        F.when(nyc, F.coalesce("incidents_count", F.lit(0))).alias("nyc_crime_incidents_count"),
        F.when(london, F.coalesce("disrupted_lines", F.lit(0))).alias("london_transit_disruptions"),
        F.when(london, F.col("disrupted_line_ids")).alias("london_transit_disrupted_lines"))
