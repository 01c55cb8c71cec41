"""Intermediate and mart operators: resolution times, SLA, advisories,
conditional daily metrics, modes, correlations and leakage-free features
(F1, F2, F9, F13, G1–G5, G9–G11).

Every join here is between tables already aggregated to their grain (city ×
hour, city × day, request): inputs are pre-aggregated *before* joining, so no
join fans out and no wide join is aggregated afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroframe.functions.columns import hours_between
from metroframe.operators.staging import AQI_BANDS
from metroframe.operators.upsert import _folder


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def resolution(created="created_at", closed="closed_at") -> dict[str, Column]:
    """is_open, hours_to_close (F1): null while open; a negative duration
    (closed before created) is a data error and yields null."""
    hrs = hours_between(created, closed)
    return {
        "is_open": _c(closed).isNull(),
        "hours_to_close": F.when(_c(closed) >= _c(created), F.round(hrs, 4)),
    }


def apply_sla(df: DataFrame, sla: DataFrame, type_col: str, sla_type: str = "complaint_type",
              hours_col: str = "hours_to_close", closed_col: str = "closed_at") -> DataFrame:
    """SLA target by type (G4): left join on lower(trim(type)), a broadcast for
    the seed table and by the planner's size check for any other;
    met_sla is three-valued (D8): closed → hours ≤ target, open or no target
    → null."""
    s = sla.select(F.lower(F.trim(F.col(sla_type))).alias("_sla_key"), "sla_hours")
    out = df.join(s, F.lower(F.trim(df[type_col])) == s["_sla_key"], "left").drop("_sla_key")
    met = F.when(F.col(closed_col).isNotNull() & F.col("sla_hours").isNotNull(),
                 F.col(hours_col) <= F.col("sla_hours"))
    return out.withColumn("met_sla", met)


def sla_summary(df: DataFrame, group_cols: list[str]) -> DataFrame:
    """SLA compliance per group (G5). Partial aggregation before the shuffle
    keeps a hot borough from landing in one task."""
    n_eval = F.count("met_sla")
    n_met = F.count_if(F.col("met_sla"))
    return (df.groupBy(*group_cols)
            .agg(F.count(F.lit(1)).alias("n_requests"), F.count_if("is_open").alias("n_open"),
                 n_eval.alias("n_evaluated"), n_met.alias("n_met"),
                 F.avg("hours_to_close").alias("avg_hours_to_close"),
                 F.percentile_approx("hours_to_close", 0.5).alias("median_hours_to_close"))
            .withColumn("sla_compliance",
                        F.when(F.col("n_evaluated") > 0, F.col("n_met") / F.col("n_evaluated"))))


#: size parameter of the quantile sketches of a day
SKETCH_SIZE = 800


def sketch_rank_error(size: int = SKETCH_SIZE) -> float:
    """How far the rank of a sketched quantile may be off, as a share of the
    values, with 99 % confidence (published for KLL sketches; merging keeps it)."""
    return 2.296 / size ** 0.9723


def sla_days(df: DataFrame, day_col: str, group_cols: list[str], size: int = SKETCH_SIZE) -> DataFrame:
    """What a day adds to the SLA summary of each group (G5): counts, the sum
    of the hours in ten-thousandths (exact, in any order) and a quantile sketch
    of a few KB. Rows of any days merge with ``merge_sla_days``, so a summary
    does not read closed requests again. Sketches are built before the shuffle."""
    return (df.groupBy(day_col, *group_cols)
            .agg(F.count(F.lit(1)).alias("n_requests"), F.count_if("is_open").alias("n_open"),
                 F.count("met_sla").alias("n_evaluated"), F.count_if("met_sla").alias("n_met"),
                 F.count("hours_to_close").alias("n_hours"),
                 F.sum(F.round(F.col("hours_to_close") * 10_000).cast("bigint")).alias("hours_e4"),
                 F.kll_sketch_agg_double(F.col("hours_to_close").cast("double"), size).alias("hours_sketch")))


def merge_sla_days(days: DataFrame, group_cols: list[str]) -> DataFrame:
    """The columns of ``sla_summary`` from rows of ``sla_days``. The median is a
    value whose rank is within ``sketch_rank_error`` of the middle, null without
    a closed request."""
    counts = ["n_requests", "n_open", "n_evaluated", "n_met", "n_hours", "hours_e4"]
    merged = days.groupBy(*group_cols).agg(*[F.sum(c).alias(c) for c in counts],
                                           F.kll_merge_agg_double("hours_sketch").alias("hours_sketch"))
    some = F.col("n_hours") > 0
    return merged.select(
        *group_cols, *counts[:4],
        F.when(some, F.col("hours_e4") / F.lit(10_000) / F.col("n_hours")).alias("avg_hours_to_close"),
        F.when(some, F.kll_sketch_get_quantile_double("hours_sketch", F.lit(0.5))).alias("median_hours_to_close"),
        F.when(F.col("n_evaluated") > 0, F.col("n_met") / F.col("n_evaluated")).alias("sla_compliance"))


def refresh_sla_days(mart: DataFrame, path: str, day_col: str, group_cols: list[str], days: list | None = None) -> DataFrame:
    """Write the rows of ``sla_days`` to ``path``, a folder per day, and return
    the whole table. With ``days`` only these days of ``mart`` are read, and
    their folders alone are replaced, or removed if no request of the day is left."""
    spark = mart.sparkSession
    part = mart if days is None else mart.filter(F.col(day_col).isin(days))
    mode = "static" if days is None else "dynamic"
    (sla_days(part, day_col, group_cols).repartition(F.col(day_col)).write.mode("overwrite").option("partitionOverwriteMode", mode)
     .partitionBy(day_col).parquet(path))
    if days is not None:
        left = {str(r[0]) for r in part.select(day_col).distinct().collect()}  # at most the days asked for
        for day in {str(d) for d in days} - left:
            fs, folder = _folder(spark, f"{path.rstrip('/')}/{day_col}={day}")
            fs.delete(folder, True)
    return spark.read.parquet(path)


# Health advisory by AQI (upper bounds, inclusive).
ADVISORY_BANDS = [(100, "None"), (150, "Sensitive Groups"), (200, "All Groups")]
ADVISORY_ABOVE = "Avoid Outdoor"


def health_advisory(aqi) -> Column:
    a = _c(aqi)
    out = None
    for upper, name in ADVISORY_BANDS:
        out = F.when(a <= upper, F.lit(name)) if out is None else out.when(a <= upper, F.lit(name))
    return out.when(a.isNotNull(), F.lit(ADVISORY_ABOVE))


def category_ordinal(aqi, cap: int = 4) -> Column:
    """1 = Good … 6 = Hazardous, capped."""
    a = _c(aqi)
    out = None
    for i, (upper, _) in enumerate(AQI_BANDS, start=1):
        out = F.when(a <= upper, F.lit(i)) if out is None else out.when(a <= upper, F.lit(i))
    return F.least(out, F.lit(cap))


def conditional(metric, condition: Column) -> Column:
    """The metric on days where the condition holds, else null."""
    return F.when(condition, _c(metric))


def mode_of(df: DataFrame, group_cols: list[str], value: str, out: str, count_out: str | None = None) -> DataFrame:
    """Most frequent value per group (G2); ties go to the alphabetically
    first value. Two aggregations, both combined map-side."""
    counts = df.groupBy(*group_cols, value).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min_by(F.struct(F.col(value), F.col("_n")), F.struct(-F.col("_n"), F.col(value)))
    res = counts.groupBy(*group_cols).agg(best.alias("_m"))
    cols = [*group_cols, F.col("_m")[value].alias(out)]
    if count_out:
        cols.append(F.col("_m._n").alias(count_out))
    return res.select(*cols)


def correlations(df: DataFrame, group_cols: list[str], pairs: dict[str, tuple[str, str]], digits: int = 6) -> DataFrame:
    """Pearson correlation per group for named column pairs."""
    aggs = [F.round(F.corr(x, y), digits).alias(name) for name, (x, y) in pairs.items()]
    return df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n_obs"), *aggs)


def fill_recent_then_mean(key: str, ts: str, value: str, default, lookback_rows: int = 6,
                          mean_keys: list[Column] | None = None) -> Column:
    """Feature default (D14): the last observation within ``lookback_rows``
    rows of a dense hourly spine, else the mean over ``mean_keys`` (city, year
    and month) of what was observed up to this row, else a constant. Nothing
    after the row is read."""
    recent = F.last(value, ignorenulls=True).over(
        Window.partitionBy(key).orderBy(ts).rowsBetween(-lookback_rows, 0))
    # summed as whole millionths: the same to the last bit in whatever order rows are added
    so_far = Window.partitionBy(*(mean_keys or [F.col(key)])).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    mean = F.sum(F.round(F.col(value) * 1_000_000).cast("bigint")).over(so_far) / (F.count(value).over(so_far) * F.lit(1e6))
    return F.coalesce(recent, mean, F.lit(default))


def line_day_performance(polls: DataFrame, episodes: DataFrame, key: str, ts: str,
                         weather_flag: str | None = "is_weather_related", day: str = "service_date") -> DataFrame:
    """Per line and day (G6): episodes starting that day, weather-related
    ones among them, disrupted minutes (episodes split at midnight; an open
    episode runs to the line's last poll), observed minutes (the line's
    polling span clipped to the day) and the good-service share
    100 · (1 − disrupted / observed). Both inputs are reduced to (line, day)
    before they meet, so the join is one row per line-day on each side."""
    from metroframe.operators.timeline import split_by_day

    cov = polls.groupBy(key).agg(F.min(ts).alias("_s"), F.max(ts).alias("_e"))
    obs = (split_by_day(cov, "_s", "_e", day).groupBy(key, day)
           .agg(F.sum("minutes_in_day").alias("observed_minutes")))
    eps = episodes.withColumn("_end", F.coalesce("ended_at", "last_seen_at"))
    split = split_by_day(eps, "started_at", "_end", day)
    starts_today = F.to_date("started_at") == F.col(day)
    aggs = [F.count_if(starts_today).alias("disruption_events"),
            F.sum("minutes_in_day").alias("disruption_minutes")]
    if weather_flag:
        aggs.append(F.count_if(starts_today & F.col(weather_flag)).alias("weather_related_events"))
    dis = split.groupBy(key, day).agg(*aggs)
    out = obs.join(dis, [key, day], "left")
    dm = F.coalesce("disruption_minutes", F.lit(0))
    cols = [key, day, F.coalesce("disruption_events", F.lit(0)).alias("disruption_events")]
    if weather_flag:
        cols.append(F.coalesce("weather_related_events", F.lit(0)).alias("weather_related_events"))
    cols += [dm.alias("disruption_minutes"), "observed_minutes",
             F.when(F.col("observed_minutes") > 0, 100 * (1 - dm / F.col("observed_minutes"))).alias("pct_good_service")]
    return out.select(*cols)


def weather_related(category, precipitation, rain_mm: float) -> Column:
    """is_weather_related (F5, D10): a 'planned' reason never counts, a
    'weather' reason always does, otherwise precipitation ≥ ``rain_mm`` in
    the start hour does. Never null."""
    cat = _c(category)
    return (F.when(cat == "planned", F.lit(False))
            .otherwise((cat == "weather") | F.coalesce(_c(precipitation) >= rain_mm, F.lit(False))))


# Feature defaults when nothing recent nor a monthly mean exists.
FEATURE_DEFAULTS = {"temperature_c": 15.0, "precipitation_mm": 0.0, "overall_aqi": 50.0}


def feature_table(hourly: DataFrame, key: str, ts: str, count_col: str, aqi_col: str = "overall_aqi",
                  fills: dict[str, float] | None = None, lookback_hours: int = 6) -> DataFrame:
    """ML feature table on a dense (key, hour) spine (G11–G13): calendar
    features, weather/AQI filled without nulls (D14: last value within
    ``lookback_hours``, else the key's mean of the month so far, else a
    constant), the AQI
    category as an ordinal capped at 4, trailing request counts (this hour,
    last 24 hours) and the two labels (next hour's requests, AQI six hours
    ahead; null at the end of the series). No feature reads past its hour."""
    from metroframe.functions.columns import calendar_features, surrogate_key
    from metroframe.operators.timeline import lead_value, trailing_sum_rows

    fills = fills or FEATURE_DEFAULTS
    month_key = [F.col(key), F.year(ts), F.month(ts)]
    filled = {name: F.round(fill_recent_then_mean(key, ts, name, default, lookback_hours, month_key), 6)
              for name, default in fills.items()}
    out = hourly.select(
        key, ts, *[c.alias(n) for n, c in calendar_features(ts).items()], *[c.alias(n) for n, c in filled.items()],
        F.col(count_col).alias("complaints_last_1h"),
        trailing_sum_rows(key, ts, count_col, 24).alias("complaints_last_24h"),
        lead_value(key, ts, count_col, 1).alias("label_complaints_next_1h"),
        lead_value(key, ts, aqi_col, 6).alias("label_aqi_next_6h"))
    return out.select(surrogate_key(key, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).alias("feature_id"), "*",
                      category_ordinal(aqi_col).alias("aqi_category_code"))


def air_quality_indexed(hourly: DataFrame, key: str = "city", ts: str = "event_hour", aqi: str = "overall_aqi",
                        dominant: str = "dominant_pollutant") -> DataFrame:
    """int_air_quality_indexed (F6–F9, F14) over an hourly (key, hour)
    table: 24-hour rolling mean on a time-range frame (missing hours shrink
    the window), the day's peak on every hour, the dominant pollutant, the
    category band and the health advisory."""
    from metroframe.functions.columns import surrogate_key
    from metroframe.operators.staging import aqi_band
    from metroframe.operators.timeline import partition_max, rolling_mean_hours

    h = hourly.withColumn("observation_date", F.to_date(ts))
    return h.select(
        surrogate_key(key, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).alias("observation_id"),
        F.col(ts).alias("observed_at"), "observation_date", key, aqi, aqi_band(F.col(aqi)).alias("aqi_category"),
        F.round(rolling_mean_hours(key, ts, aqi, 24), 4).alias("aqi_24h_rolling_avg"),
        partition_max(aqi, key, "observation_date").alias("daily_peak_aqi"), dominant,
        health_advisory(aqi).alias("health_advisory"))


def air_quality_trends(daily: DataFrame, key: str, day: str, avg_col: str = "avg_aqi", max_col: str = "max_aqi",
                       unhealthy_above: int = 100) -> DataFrame:
    """mart_air_quality_trends (G7, G8) over a daily (key, day) table:
    7- and 30-day rolling means of the daily mean and the count of unhealthy
    days (max AQI above the threshold, D7) in the trailing 30 days, all on
    day-range frames."""
    from metroframe.operators.timeline import rolling_days

    bad = F.sum(F.when(F.col(max_col) > unhealthy_above, 1).otherwise(0))
    return daily.select(
        key, day, avg_col, max_col,
        F.round(rolling_days(key, day, F.avg(avg_col), 7), 6).alias("aqi_7d_avg"),
        F.round(rolling_days(key, day, F.avg(avg_col), 30), 6).alias("aqi_30d_avg"),
        rolling_days(key, day, bad, 30).alias("unhealthy_days_30d"))


def conditional_counts(df: DataFrame, group_cols: list[str], conditions: dict[str, Column]) -> DataFrame:
    """Counts of rows meeting each condition per group, in one aggregation
    (F11: all requests, noise requests, incidents per city-hour)."""
    return df.groupBy(*group_cols).agg(*[F.count_if(cond).alias(name) for name, cond in conditions.items()])


def enrich_left(df: DataFrame, tables: list[DataFrame], keys: list[str]) -> DataFrame:
    """Left-join tables that are each unique on ``keys`` (already aggregated
    to that grain, F2/F13): the row count of ``df`` is kept, no join fans
    out. Small right sides become broadcasts by the planner's size check."""
    out = df
    for t in tables:
        out = out.join(t, keys, "left")
    return out
