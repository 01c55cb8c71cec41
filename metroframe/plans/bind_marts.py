"""Driver-table bindings for marts and snapshots (G*, H*). The city model
(events as city domains, orders as service requests) is described in
``bind_timeline``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroframe.functions import columns as C
from metroframe.operators import marts as M
from metroframe.operators import snapshots as H
from metroframe.operators import staging as S
from metroframe.operators import timeline as TL
from metroframe.plans.bind_ingest import tbl
from metroframe.plans.bind_staging import _BAND_SQL
from metroframe.plans.bind_timeline import (AO, EP, EPW, EV, RC, REQ, SP, WH, air_obs, city_events,
                                            episodes_with_weather, hourly_all, line_episodes, line_polls,
                                            order_requests, with_ctes)
from metroframe.plans.registry import normalize, register
from metroframe.session import cut_lineage, work_path
from metroframe.sources.seeds import values_sql

BAD_AIR_AQI = 450
RAIN_DAY_MM = 3.0

# SLA target hours per order priority (binding seed).
PRIORITY_SLA = [
    ("1-URGENT", 8760, "HIGH"),
    ("2-HIGH", 17520, "HIGH"),
    ("3-MEDIUM", 26280, "MEDIUM"),
    ("4-NOT SPECIFIED", 35040, "LOW"),
    ("5-LOW", 43800, "LOW"),
]


def priority_sla(spark) -> DataFrame:
    return F.broadcast(spark.createDataFrame(PRIORITY_SLA, "complaint_type string, sla_hours long, priority_level string"))


_SLA_SQL = values_sql(PRIORITY_SLA, ["complaint_type", "sla_hours", "priority_level"])

# ---------------------------------------------------------------------------
# Daily city tables
# ---------------------------------------------------------------------------

DS = """ds AS (SELECT city, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS event_date
  FROM (SELECT city, min(event_date) AS lo, max(event_date) AS hi FROM ev GROUP BY city))"""
WD = """wd AS (SELECT city, event_date, sum(round(value * 100)::BIGINT) / (count(value) * 1000.0::DOUBLE) AS avg_temperature_c,
  round(max(value) / 100, 4) AS max_precipitation_mm, sum(round(value * 100)::BIGINT) / 10000.0::DOUBLE AS total_precipitation_mm
  FROM ev WHERE event_type = 'view' GROUP BY city, event_date)"""
AD = """ad AS (SELECT city, event_date, avg(aqi) AS avg_aqi, max(aqi) AS max_aqi FROM ao GROUP BY city, event_date)"""
QD = """qd AS (SELECT city, event_date, count(*) FILTER (WHERE event_type IN ('purchase', 'click')) AS complaints_count,
  count(*) FILTER (WHERE event_type = 'error') AS incidents_count,
  count(*) FILTER (WHERE event_type = 'error' AND value > 200) AS felony_count,
  count(*) AS n_events, count(*) FILTER (WHERE event_type = 'click') AS n_clicks FROM ev GROUP BY city, event_date)"""
TD = """td AS (SELECT 'london' AS city, CAST(started_at AS DATE) AS event_date, count(*) AS disruption_events
  FROM ep GROUP BY 2)"""


def _air_daily(ev: DataFrame) -> DataFrame:
    return air_obs(ev).groupBy("city", "event_date").agg(F.avg("aqi").alias("avg_aqi"), F.max("aqi").alias("max_aqi"))


def _daily_all(ev: DataFrame) -> DataFrame:
    """All domains per city and day in one scan and one shuffle."""
    view = F.when(F.col("event_type") == "view", F.col("value"))
    aqi = S.valid_aqi(F.floor("value").cast("bigint"))
    t = F.col("event_type")
    return ev.groupBy("city", "event_date").agg(
        S.exact_mean(view, 2, 10.0).alias("avg_temperature_c"), F.round(F.max(view) / 100, 4).alias("max_precipitation_mm"),
        (F.sum(F.round(view * 100).cast("bigint")) / F.lit(10000.0)).alias("total_precipitation_mm"),
        F.avg(aqi).alias("avg_aqi"), F.max(aqi).alias("max_aqi"),
        F.count_if(t.isin("purchase", "click")).alias("complaints_count"), F.count_if(t == "error").alias("incidents_count"),
        F.count_if((t == "error") & (F.col("value") > 200)).alias("felony_count"),
        F.count(F.lit(1)).alias("n_events"), F.count_if(t == "click").alias("n_clicks"))


def _transit_daily(spark, d) -> DataFrame:
    return (line_episodes(spark, d).groupBy(F.to_date("started_at").alias("event_date"))
            .agg(F.count(F.lit(1)).alias("disruption_events")).withColumn("city", F.lit("london")))


@register("city_daily_summary", with_ctes(EV, DS, WD, AO, AD, QD, EP, TD) + f"""
SELECT md5(ds.city || '|' || ds.event_date::VARCHAR) AS summary_id, ds.city, ds.event_date, avg_temperature_c,
  max_precipitation_mm, total_precipitation_mm, avg_aqi, max_aqi, {_BAND_SQL.format(a='max_aqi')} AS worst_aqi_category,
  CASE WHEN ds.city = 'nyc' THEN coalesce(complaints_count, 0) END AS complaints_count,
  CASE WHEN ds.city = 'nyc' THEN coalesce(incidents_count, 0) END AS incidents_count,
  CASE WHEN ds.city = 'nyc' THEN coalesce(felony_count, 0) END AS felony_count,
  CASE WHEN ds.city = 'london' THEN coalesce(disruption_events, 0) END AS transit_disruption_events
FROM ds LEFT JOIN wd USING (city, event_date) LEFT JOIN ad USING (city, event_date)
LEFT JOIN qd USING (city, event_date) LEFT JOIN td USING (city, event_date)""")
def city_daily_summary(spark, d):
    daily = _daily_all(city_events(spark, d))
    keys = ["city", "event_date"]
    out = TL.day_spine(daily, *keys).join(daily, keys, "left").join(_transit_daily(spark, d), keys, "left")
    nyc, london = F.col("city") == "nyc", F.col("city") == "london"
    return out.select(
        C.surrogate_key("city", "event_date").alias("summary_id"), "city", "event_date", "avg_temperature_c",
        "max_precipitation_mm", "total_precipitation_mm", "avg_aqi", "max_aqi", S.aqi_band(F.col("max_aqi")).alias("worst_aqi_category"),
        F.when(nyc, F.coalesce("complaints_count", F.lit(0))).alias("complaints_count"),
        F.when(nyc, F.coalesce("incidents_count", F.lit(0))).alias("incidents_count"),
        F.when(nyc, F.coalesce("felony_count", F.lit(0))).alias("felony_count"),
        F.when(london, F.coalesce("disruption_events", F.lit(0))).alias("transit_disruption_events"))


@register("daily_mode", with_ctes(EV) + """
SELECT city, event_date, first(event_type ORDER BY n DESC, event_type ASC) AS dominant_event_type,
  max(n) AS dominant_count FROM (SELECT city, event_date, event_type, count(*) AS n FROM ev GROUP BY ALL) GROUP BY ALL""")
def daily_mode(spark, d):
    return M.mode_of(city_events(spark, d), ["city", "event_date"], "event_type", "dominant_event_type",
                     count_out="dominant_count")


@register("worst_category", with_ctes(EV, AO) + f"""
SELECT city, event_date, first({_BAND_SQL.format(a='aqi')} ORDER BY aqi DESC, {_BAND_SQL.format(a='aqi')} DESC)
  AS worst_aqi_category, max(aqi) AS max_aqi FROM ao GROUP BY ALL""")
def worst_category(spark, d):
    obs = air_obs(city_events(spark, d)).withColumn("category", S.aqi_band(F.col("aqi")))
    return obs.groupBy("city", "event_date").agg(S.worst_category("category", "aqi", "category")
                                                 .alias("worst_aqi_category"), F.max("aqi").alias("max_aqi"))


@register("rolling_7d_30d", with_ctes(EV, AO, AD) + """
SELECT city, event_date, avg_aqi AS daily_avg_aqi,
  round(avg(avg_aqi) OVER (PARTITION BY city ORDER BY event_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), 6)
    AS aqi_7d_avg,
  round(avg(avg_aqi) OVER (PARTITION BY city ORDER BY event_date RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW), 6)
    AS aqi_30d_avg FROM ad""")
def rolling_7d_30d(spark, d):
    trends = M.air_quality_trends(_air_daily(city_events(spark, d)), "city", "event_date", unhealthy_above=BAD_AIR_AQI)
    return trends.select("city", "event_date", F.col("avg_aqi").alias("daily_avg_aqi"), "aqi_7d_avg", "aqi_30d_avg")


@register("unhealthy_days_30d", with_ctes(EV, AO, AD) + f"""
SELECT city, event_date, max_aqi, (sum(CASE WHEN max_aqi > {BAD_AIR_AQI} THEN 1 ELSE 0 END) OVER (PARTITION BY city
  ORDER BY event_date RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW))::BIGINT AS unhealthy_days_30d FROM ad""")
def unhealthy_days_30d(spark, d):
    trends = M.air_quality_trends(_air_daily(city_events(spark, d)), "city", "event_date", unhealthy_above=BAD_AIR_AQI)
    return normalize(trends.select("city", "event_date", "max_aqi", "unhealthy_days_30d"))


@register("cross_domain_daily", with_ctes(EV, DS, WD, AO, AD, QD) + f"""
, j AS (SELECT ds.city, ds.event_date, max_aqi, max_precipitation_mm,
  CASE WHEN ds.city = 'nyc' THEN coalesce(complaints_count, 0) END AS complaints_count,
  CASE WHEN ds.city = 'nyc' THEN coalesce(incidents_count, 0) END AS incidents_count,
  coalesce(max_precipitation_mm > {RAIN_DAY_MM}, FALSE) AS is_rain_day
  FROM ds LEFT JOIN wd USING (city, event_date) LEFT JOIN ad USING (city, event_date) LEFT JOIN qd USING (city, event_date))
SELECT md5(city || '|' || event_date::VARCHAR) AS correlation_id, city, event_date, max_aqi, max_precipitation_mm,
  complaints_count, incidents_count, is_rain_day,
  CASE WHEN max_aqi > {BAD_AIR_AQI} THEN complaints_count END AS complaints_on_bad_air_day,
  CASE WHEN is_rain_day THEN incidents_count END AS incidents_on_rain_day FROM j""")
def cross_domain_daily(spark, d):
    daily = _daily_all(city_events(spark, d))
    keys = ["city", "event_date"]
    j = TL.day_spine(daily, *keys).join(daily, keys, "left")
    nyc = F.col("city") == "nyc"
    j = j.select("city", "event_date", "max_aqi", "max_precipitation_mm",
                 F.when(nyc, F.coalesce("complaints_count", F.lit(0))).alias("complaints_count"),
                 F.when(nyc, F.coalesce("incidents_count", F.lit(0))).alias("incidents_count"),
                 S.precip_flag("max_precipitation_mm", RAIN_DAY_MM).alias("is_rain_day"))
    return j.select(
        C.surrogate_key("city", "event_date").alias("correlation_id"), *j.columns,
        M.conditional("complaints_count", F.col("max_aqi") > BAD_AIR_AQI).alias("complaints_on_bad_air_day"),
        M.conditional("incidents_count", F.col("is_rain_day")).alias("incidents_on_rain_day"))


@register("correlations", with_ctes(EV, WD, AO, AD, QD) + """
, daily AS (SELECT qd.city, qd.event_date, n_events, n_clicks, avg_aqi, max_precipitation_mm,
  lead(n_events, 1) OVER (PARTITION BY qd.city ORDER BY qd.event_date) AS next_day_events
  FROM qd LEFT JOIN ad USING (city, event_date) LEFT JOIN wd USING (city, event_date))
SELECT city, count(*) AS n_obs, round(corr(avg_aqi, n_events), 6) AS corr_aqi_vs_events,
  round(corr(max_precipitation_mm, n_clicks), 6) AS corr_precip_vs_noise,
  round(corr(avg_aqi, next_day_events), 6) AS corr_aqi_vs_next_day_events
FROM daily GROUP BY city""")
def correlations(spark, d):
    """Per-city Pearson correlations behind the README questions (G10), on
    the daily table, including a one-day lag (today's AQI vs tomorrow's
    activity) taken with ``lead``."""
    daily = _daily_all(city_events(spark, d)).withColumn("next_day_events", TL.lead_value("city", "event_date", "n_events", 1))
    return M.correlations(daily, ["city"], {"corr_aqi_vs_events": ("avg_aqi", "n_events"),
                                            "corr_precip_vs_noise": ("max_precipitation_mm", "n_clicks"),
                                            "corr_aqi_vs_next_day_events": ("avg_aqi", "next_day_events")})


# ---------------------------------------------------------------------------
# SLA (G4, G5)
# ---------------------------------------------------------------------------

SLA = f""", sla AS (SELECT res.*, s.sla_hours::BIGINT AS sla_hours, CASE WHEN closed_at IS NOT NULL AND s.sla_hours IS NOT NULL
  THEN hours_to_close <= s.sla_hours END AS met_sla
  FROM res LEFT JOIN {_SLA_SQL.replace(') AS t(', ') AS s(')} ON lower(trim(res.complaint_type)) = lower(trim(s.complaint_type)))
"""


def sla_frame(spark, d) -> DataFrame:
    req = order_requests(spark, d)
    req = req.select("*", *[c.alias(n) for n, c in M.resolution().items()])
    return M.apply_sla(req, priority_sla(spark), "complaint_type")


@register("complaint_sla", with_ctes(REQ) + SLA + """
SELECT o_orderkey, complaint_type, sla_hours, hours_to_close, met_sla FROM sla""")
def complaint_sla(spark, d):
    return sla_frame(spark, d).select("o_orderkey", "complaint_type", "sla_hours", "hours_to_close", "met_sla")


@register("sla_by_borough", with_ctes(REQ) + SLA + """
SELECT r_name AS borough, count(*) AS n_requests, count(*) FILTER (WHERE is_open) AS n_open,
  count(met_sla) AS n_evaluated, count(*) FILTER (WHERE met_sla) AS n_met, avg(hours_to_close) AS avg_hours_to_close,
  quantile_disc(hours_to_close, 0.5) AS median_hours_to_close,
  CASE WHEN count(met_sla) > 0 THEN count(*) FILTER (WHERE met_sla) / count(met_sla) END AS sla_compliance
FROM sla JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def sla_by_borough(spark, d):
    return M.sla_summary(placed_requests(spark, d), ["borough"])


def placed_requests(spark, d) -> DataFrame:
    """Requests with their SLA and borough."""
    sla = sla_frame(spark, d)
    cust = tbl(spark, d, "customer").select("c_custkey", "c_nationkey")
    geo = (tbl(spark, d, "nation").join(tbl(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", F.col("r_name").alias("borough")))
    return (sla.join(cust, sla["o_custkey"] == cust["c_custkey"])
            .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))


@register("sla_by_borough_from_days", with_ctes(REQ) + SLA + """
SELECT r_name AS borough, count(*) AS n_requests, count(*) FILTER (WHERE is_open) AS n_open,
  count(met_sla) AS n_evaluated, count(*) FILTER (WHERE met_sla) AS n_met,
  CASE WHEN count(hours_to_close) > 0
    THEN sum(CAST(round(hours_to_close * 10000) AS BIGINT))::BIGINT / 10000 / count(hours_to_close) END AS avg_hours_to_close,
  CASE WHEN count(met_sla) > 0 THEN count(*) FILTER (WHERE met_sla) / count(met_sla) END AS sla_compliance,
  count(hours_to_close) > 0 AS median_within_error
FROM sla JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def sla_by_borough_from_days(spark, d):
    """The summary merged from daily sketches; the sketched median itself
    differs from run to run within its error, so its rank among all hours is
    returned as right or wrong."""
    placed = placed_requests(spark, d)
    days = cut_lineage(M.sla_days(placed.withColumn("day", F.to_date("created_at")), "day", ["borough"]), name="sla-days")
    merged = M.merge_sla_days(days, ["borough"])
    hours, median = F.col("hours_to_close"), F.col("median_hours_to_close")
    # one row per region
    ranks = (placed.select("borough", "hours_to_close").join(F.broadcast(merged.select("borough", "median_hours_to_close")), "borough")
             .groupBy("borough").agg(F.count("hours_to_close").alias("n"), F.count_if(hours < median).alias("below"),
                                     F.count_if(hours <= median).alias("up_to")))
    error = M.sketch_rank_error()
    near = (F.col("below") <= (0.5 + error) * F.col("n")) & (F.col("up_to") >= (0.5 - error) * F.col("n")) & (F.col("n") > 0)
    return merged.drop("median_hours_to_close").join(ranks.select("borough", near.alias("median_within_error")), "borough")


# ---------------------------------------------------------------------------
# Transit performance
# ---------------------------------------------------------------------------

@register("transit_performance", with_ctes(EV, WH, AO, AD, EP, EPW) + """
, cov AS (SELECT user_id AS line_id, min(ts) AS s, max(ts) AS e FROM events GROUP BY 1),
days AS (SELECT line_id, s, e, CAST(unnest(generate_series(CAST(s AS DATE),
  greatest(CAST(s AS DATE), CAST(e - INTERVAL 1 MICROSECOND AS DATE)), INTERVAL 1 DAY)) AS DATE) AS service_date FROM cov),
obs AS (SELECT line_id, service_date, sum((epoch_us(least(e, service_date + INTERVAL 1 DAY))
  - epoch_us(greatest(s, service_date::TIMESTAMP))) // 60000000) AS observed_minutes FROM days GROUP BY ALL),
eps AS (SELECT line_id, started_at, coalesce(ended_at, last_seen_at) AS e, is_weather_related FROM epw),
edays AS (SELECT line_id, started_at, e, is_weather_related, CAST(unnest(generate_series(CAST(started_at AS DATE),
  greatest(CAST(started_at AS DATE), CAST(e - INTERVAL 1 MICROSECOND AS DATE)), INTERVAL 1 DAY)) AS DATE) AS service_date
  FROM eps),
dis AS (SELECT line_id, service_date, count(*) FILTER (WHERE CAST(started_at AS DATE) = service_date) AS disruption_events,
  count(*) FILTER (WHERE CAST(started_at AS DATE) = service_date AND is_weather_related) AS weather_related_events,
  sum((epoch_us(least(e, service_date + INTERVAL 1 DAY)) - epoch_us(greatest(started_at, service_date::TIMESTAMP)))
    // 60000000) AS disruption_minutes FROM edays GROUP BY ALL)
SELECT line_id, service_date, coalesce(disruption_events, 0) AS disruption_events,
  coalesce(weather_related_events, 0) AS weather_related_events,
  coalesce(disruption_minutes, 0)::BIGINT AS disruption_minutes, observed_minutes::BIGINT AS observed_minutes,
  CASE WHEN observed_minutes > 0 THEN 100 * (1 - coalesce(disruption_minutes, 0) / observed_minutes) END
    AS pct_good_service,
  CASE WHEN coalesce(disruption_events, 0) > 0 THEN ad.avg_aqi END AS avg_aqi_on_disruption_day
FROM obs LEFT JOIN dis USING (line_id, service_date)
LEFT JOIN ad ON ad.city = 'london' AND ad.event_date = obs.service_date""")
def transit_performance(spark, d):
    """Per line-day performance (G6) plus the city's mean AQI on days with a
    disruption."""
    perf = M.line_day_performance(line_polls(spark, d), episodes_with_weather(spark, d), "line_id", "ts")
    ad = _air_daily(city_events(spark, d))
    aqi = ad.filter(F.col("city") == "london").select(F.col("event_date").alias("service_date"), "avg_aqi")
    out = perf.join(aqi, "service_date", "left")
    return out.select(*perf.columns, F.when(F.col("disruption_events") > 0, F.col("avg_aqi"))
                      .alias("avg_aqi_on_disruption_day"))


# ---------------------------------------------------------------------------
# Feature table
# ---------------------------------------------------------------------------

def _hourly_base(spark, d) -> DataFrame:
    hourly = hourly_all(city_events(spark, d)).select("city", "event_hour", "temperature_c", "precipitation_mm", "overall_aqi", "requests_count")
    return (TL.hour_spine(hourly, "city", "event_hour").join(hourly, ["city", "event_hour"], "left")
            .withColumn("requests_count", F.coalesce("requests_count", F.lit(0))))


HB = """hb AS (SELECT sp.city, sp.event_hour, wh.temperature_c, wh.precipitation_mm, ah.overall_aqi,
  coalesce(rc.requests_count, 0) AS requests_count FROM sp
  LEFT JOIN wh ON sp.city = wh.city AND sp.event_hour = wh.event_hour
  LEFT JOIN (SELECT city, event_hour, max(aqi) AS overall_aqi FROM ao GROUP BY ALL) ah
    ON sp.city = ah.city AND sp.event_hour = ah.event_hour
  LEFT JOIN rc ON sp.city = rc.city AND sp.event_hour = rc.event_hour)"""
_TRAIL_SQL = ("(sum(requests_count) OVER (PARTITION BY city ORDER BY event_hour ROWS BETWEEN 23 PRECEDING AND "
              "CURRENT ROW))::BIGINT")
_NEXT_SQL = ("lead(requests_count, 1) OVER (PARTITION BY city ORDER BY event_hour) AS label_complaints_next_1h, "
             "lead(overall_aqi, 6) OVER (PARTITION BY city ORDER BY event_hour) AS label_aqi_next_6h")


@register("trailing_counts", with_ctes(EV, SP, WH, AO, RC, HB) + f"""
SELECT city, event_hour, requests_count AS complaints_last_1h, {_TRAIL_SQL} AS complaints_last_24h FROM hb""")
def trailing_counts(spark, d):
    hb = _hourly_base(spark, d)
    return hb.select("city", "event_hour", F.col("requests_count").alias("complaints_last_1h"),
                     TL.trailing_sum_rows("city", "event_hour", "requests_count", 24).alias("complaints_last_24h"))


@register("lead_labels", with_ctes(EV, SP, WH, AO, RC, HB) + f"SELECT city, event_hour, {_NEXT_SQL} FROM hb")
def lead_labels(spark, d):
    hb = _hourly_base(spark, d)
    return hb.select("city", "event_hour",
                     TL.lead_value("city", "event_hour", "requests_count", 1).alias("label_complaints_next_1h"),
                     TL.lead_value("city", "event_hour", "overall_aqi", 6).alias("label_aqi_next_6h"))


def _fill_sql(col: str, default: float) -> str:
    so_far = ("OVER (PARTITION BY city, year(event_hour), month(event_hour) ORDER BY event_hour "
              "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    return (f"round(coalesce(last_value({col} IGNORE NULLS) OVER (PARTITION BY city ORDER BY event_hour ROWS BETWEEN "
            f"6 PRECEDING AND CURRENT ROW), sum(round({col} * 1000000)::BIGINT) {so_far} / (count({col}) {so_far} * 1000000.0::DOUBLE), "
            f"{default}), 6)")


_ORD_SQL = ("least(CASE WHEN {a} <= 50 THEN 1 WHEN {a} <= 100 THEN 2 WHEN {a} <= 150 THEN 3 WHEN {a} <= 200 THEN 4 "
            "WHEN {a} <= 300 THEN 5 WHEN {a} <= 500 THEN 6 END, 4)")


@register("ml_features", with_ctes(EV, SP, WH, AO, RC, HB) + f"""
, f AS (SELECT city, event_hour, hour(event_hour)::BIGINT AS hour_of_day, (dayofweek(event_hour) + 1)::BIGINT AS day_of_week,
  dayofweek(event_hour) IN (0, 6) AS is_weekend, month(event_hour)::BIGINT AS month,
  {_fill_sql('temperature_c', 15.0)} AS temperature_c, {_fill_sql('precipitation_mm', 0.0)} AS precipitation_mm,
  {_fill_sql('overall_aqi', 50.0)} AS overall_aqi,
  requests_count AS complaints_last_1h, {_TRAIL_SQL} AS complaints_last_24h, {_NEXT_SQL} FROM hb)
SELECT md5(city || '|' || strftime(event_hour, '%Y-%m-%d %H:%M:%S')) AS feature_id, *,
  {_ORD_SQL.format(a='overall_aqi')}::BIGINT AS aqi_category_code FROM f""")
def ml_features(spark, d):
    return normalize(M.feature_table(_hourly_base(spark, d), "city", "event_hour", "requests_count"))


# ---------------------------------------------------------------------------
# SCD2 (H1–H3)
# ---------------------------------------------------------------------------

SCD = """c AS (SELECT user_id, event_type, ts, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
v AS (SELECT user_id, event_type, ts AS valid_from FROM c WHERE prev IS NULL OR prev <> event_type),
h AS (SELECT md5(user_id::VARCHAR || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id, user_id, event_type,
  valid_from, lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS valid_to FROM v)"""
_SCD_OUT = "SELECT scd_id, user_id, event_type, valid_from, valid_to, valid_to IS NULL AS is_current FROM h"
MERGE_CUTOFF = "2024-01-20 00:00:00"


@register("scd2_history", with_ctes(SCD) + _SCD_OUT)
def scd2_history(spark, d):
    return H.scd2_history(tbl(spark, d, "events"), "user_id", ["event_type"], "ts")


DELETED_AT = "2024-02-15 00:00:00"


@register("scd2_merge", with_ctes(SCD) + f"""
SELECT scd_id, user_id, event_type, valid_from, CASE WHEN valid_to IS NULL AND user_id % 50 = 7 THEN TIMESTAMP '{DELETED_AT}'
  ELSE valid_to END AS valid_to, valid_to IS NULL AND user_id % 50 <> 7 AS is_current,
  valid_to IS NULL AND user_id % 50 = 7 AS is_deleted FROM h""")
def scd2_merge(spark, d):
    """The history up to a cutoff as a stored table, into which the later
    changes and the deletion of some users are merged."""
    ev = tbl(spark, d, "events").select("user_id", "event_type", "ts")
    cutoff = F.lit(MERGE_CUTOFF).cast("timestamp_ntz")
    path = work_path(spark, "scd-history")
    before = ev.filter(F.col("ts") < cutoff)
    H.write_scd2_table(H.scd2_history(before, "user_id", ["event_type"], "ts"), path, before, "ts", buckets=8)
    gone = ev.where("user_id % 50 = 7").select("user_id", F.lit(DELETED_AT).cast("timestamp_ntz").alias("ts")).distinct()
    H.merge_scd2_table(spark, path, ev.filter(F.col("ts") >= cutoff), "user_id", ["event_type"], "ts", deletes=gone)
    return H.read_scd2_table(spark, path)


@register("state_transitions", with_ctes(SCD) + """
SELECT user_id, prev AS from_state, event_type AS to_state, ts AS changed_at FROM c
WHERE prev = 'view' AND event_type = 'error'""")
def state_transitions(spark, d):
    return H.state_transitions(tbl(spark, d, "events"), "user_id", "event_type", "ts", "view", "error")


