"""Time-series operators: hour spine, gaps-and-islands episodes, range
windows, interval splitting, trailing counts and lead labels (F3, F6, F7,
F10, F12, G6–G8, G12, G13).

Scale notes:

* Windows over per-city *hourly* tables are cheap: aggregate to the hour
  first, never window raw rows by city.
* Episode detection on raw polls must not sort a whole line in one task (one
  line may carry a third of all polls). It runs as two levels: windows
  inside (line, day) buckets, plus a per-(line, day) summary — a few bytes
  per bucket — that carries the previous state, the next change and the
  line's last poll across bucket borders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroframe.functions.columns import hour_trunc


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """Seconds since 1970-01-01 on the wall clock: no session time zone (and
    so no DST jump) enters range frames or gap tests."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, _c(ts).cast("timestamp_ntz"))


def minutes_floor(start, end) -> Column:
    """Whole minutes from start to end (truncated)."""
    return F.timestamp_diff("MINUTE", _c(start), _c(end))


# ---------------------------------------------------------------------------
# Spine
# ---------------------------------------------------------------------------

def hour_spine(df: DataFrame, key: str, ts: str, out_ts: str = "event_hour") -> DataFrame:
    """Dense (key, hour) rows from each key's first to last hour.

    Built per key from its own bounds (one small aggregation + explode), so
    no cross join is needed."""
    bounds = df.groupBy(key).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    hours = F.sequence(hour_trunc("_lo"), hour_trunc("_hi"), F.expr("INTERVAL 1 HOUR"))
    return bounds.select(key, F.explode(hours).alias(out_ts))


def day_spine(df: DataFrame, key: str, day: str, out: str = "event_date") -> DataFrame:
    bounds = df.groupBy(key).agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    return bounds.select(key, F.explode(F.sequence("_lo", "_hi")).alias(out))


# ---------------------------------------------------------------------------
# Gaps and islands
# ---------------------------------------------------------------------------

def islands(df: DataFrame, key: str, ts: str, state: list[str], max_gap_seconds: int | None = None,
            bucket: str = "day", start: str = "started_at", end: str = "ended_at",
            carry: list[str] | None = None, with_previous: bool = False) -> DataFrame:
    """Maximal runs of equal state per key: (key, state…, carry…, start, end,
    last_seen_at[, previous state]). A run ends where the state differs from the
    previous poll, or where the gap to it exceeds ``max_gap_seconds``. ``end``
    is when it stopped (the next differing poll, or the last poll before an
    over-long gap); null while ongoing. Rows without a key or time have no run.

    One pass over the raw rows, sorted inside (key, bucket), keeps the changes
    within a bucket and each bucket's first and last row. What crosses bucket
    borders (the state and time before a bucket, the next change after it) is
    worked out on one row per bucket. Nothing runs before an action asks for it;
    both uses of the kept rows read the same columns, so they share one shuffle."""
    carry = carry or []
    b = F.date_trunc(bucket, F.col(ts)).cast("timestamp_ntz")
    st = F.struct(*[F.col(s) for s in state])
    tie = F.xxhash64(*[F.col(s) for s in state])  # rows of one time keep one order in every run
    rows = (df.select(F.col(key), F.col(ts), *[F.col(s) for s in state], *[F.col(c) for c in carry])
            .withColumn("_b", b).withColumn("_st", st).withColumn("_tie", tie)
            .where(F.col(key).isNotNull() & F.col("_b").isNotNull()))

    def too_long(since: Column, until: Column) -> Column:
        if max_gap_seconds is None:
            return F.lit(False)
        return F.coalesce((epoch_seconds(until) - epoch_seconds(since)) > F.lit(max_gap_seconds), F.lit(False))

    wl = Window.partitionBy(key, "_b").orderBy(F.col(ts), "_tie")
    local = rows.select("*", F.lag("_st").over(wl).alias("_before_st"), F.lag(ts).over(wl).alias("_before"), F.lead(ts).over(wl).isNull().alias("_last"))
    first = F.col("_before").isNull()
    gap = too_long(F.col("_before"), F.col(ts))
    changed = ~first & (gap | ~F.col("_before_st").eqNullSafe(F.col("_st")))
    kept = local.withColumn("_changed", changed).filter(first | F.col("_last") | F.col("_changed"))
    # where the run before this row ends, should this row begin another
    marker = F.when(gap, F.col("_before")).otherwise(F.col(ts))

    at = F.struct(F.col(ts), F.col("_tie"))
    every = F.bit_xor(F.xxhash64(*[F.col(c) for c in kept.columns]))  # reads all columns, so that the shuffle is the same one
    days = kept.groupBy(key, "_b").agg(
        F.min(ts).alias("_first_ts"), F.min_by("_st", at).alias("_first_st"), F.max(ts).alias("_last_ts"), F.max_by("_st", at).alias("_last_st"),
        F.min_by(marker, F.when(F.col("_changed"), at)).alias("_local"), every.alias("_every"))
    wk = Window.partitionBy(key).orderBy("_b")
    days = days.select("*", F.lag("_last_st").over(wk).alias("_carry_st"), F.lag("_last_ts").over(wk).alias("_carry_ts"),
                       F.max("_last_ts").over(Window.partitionBy(key)).alias("_key_last_ts"))
    new_gap = too_long(F.col("_carry_ts"), F.col("_first_ts"))
    begins = F.col("_carry_ts").isNull() | new_gap | ~F.col("_carry_st").eqNullSafe(F.col("_first_st"))
    days = days.withColumn("_begins", begins).withColumn("_mark", F.when(new_gap, F.col("_carry_ts")).otherwise(F.col("_first_ts")))
    opening = F.when(F.col("_begins"), F.col("_mark")).otherwise(F.col("_local"))
    later = wk.rowsBetween(1, Window.unboundedFollowing)
    days = days.select(key, "_b", "_carry_st", "_begins", "_mark", "_key_last_ts", "_every", F.first(opening, ignorenulls=True).over(later).alias("_next"))

    runs = kept.join(days, [key, "_b"]).filter((F.col("_before").isNull() & F.col("_begins")) | F.col("_changed"))
    opened = F.col("_before").isNull()
    runs = runs.withColumn("_end", F.when(opened, F.col("_mark")).otherwise(marker))
    runs = runs.withColumn("_stop", F.coalesce(F.lead("_end").over(wl), F.col("_next")))
    previous = F.when(opened, F.col("_carry_st")).otherwise(F.col("_before_st"))
    prev = [previous.getField(s).alias(f"previous_{s}") for s in state] if with_previous else []
    return runs.where(F.col("_every").isNotNull()).select(
        key, *state, *carry, F.col(ts).alias(start), F.col("_stop").alias(end), F.col("_key_last_ts").alias("last_seen_at"), *prev)


def episodes(df: DataFrame, key: str, ts: str, flag: str, extra_state: list[str] | None = None,
             max_gap_seconds: int | None = None, bucket: str = "day", carry: list[str] | None = None, as_of: Column | None = None) -> DataFrame:
    """Disruption episodes (F3): runs where ``flag`` is true. A change of any
    ``extra_state`` column (severity) starts a new episode (D20); ``carry``
    keeps attributes of the first poll (reason). With ``as_of``, the time the
    feed has reached, the open episode of a line that has been silent for longer
    than ``max_gap_seconds`` ends at its last poll."""
    state = [flag] + (extra_state or [])
    runs = islands(df, key, ts, state, max_gap_seconds, bucket, carry=carry)
    if as_of is not None and max_gap_seconds is not None:
        silent = epoch_seconds(as_of) - epoch_seconds("last_seen_at") > F.lit(max_gap_seconds)
        runs = runs.withColumn("ended_at", F.coalesce("ended_at", F.when(silent, F.col("last_seen_at"))))
    return (runs.filter(F.col(flag)).drop(flag)
            .withColumn("duration_minutes", minutes_floor("started_at", "ended_at")))


# ---------------------------------------------------------------------------
# Range windows on aggregated time series
# ---------------------------------------------------------------------------

def rolling_mean_hours(key: str, ts: str, value: str, hours: int) -> Column:
    """Mean over the trailing ``hours`` hours including the current row, on
    a time range frame: missing hours shrink the window instead of
    stretching it (F6)."""
    w = Window.partitionBy(key).orderBy(epoch_seconds(ts)).rangeBetween(-(hours - 1) * 3600, 0)
    return F.avg(value).over(w)


def rolling_days(key: str, day: str, agg: Column, days: int) -> Column:
    """Aggregate over the trailing ``days`` days including today."""
    w = Window.partitionBy(key).orderBy(F.unix_date(F.col(day))).rangeBetween(-(days - 1), 0)
    return agg.over(w)


def partition_max(value: str, *keys) -> Column:
    """Daily peak attached to each row."""
    return F.max(value).over(Window.partitionBy(*keys))


def trailing_sum_rows(key: str, ts: str, value: str, n: int) -> Column:
    """Sum over the current and previous ``n-1`` rows of a dense spine."""
    return F.sum(value).over(Window.partitionBy(key).orderBy(ts).rowsBetween(-(n - 1), 0))


def lead_value(key: str, ts: str, value: str, n: int) -> Column:
    """Value ``n`` rows ahead on a dense spine; null past the end."""
    return F.lead(value, n).over(Window.partitionBy(key).orderBy(ts))


# ---------------------------------------------------------------------------
# Interval splitting
# ---------------------------------------------------------------------------

def split_by_day(df: DataFrame, start: str, end: str, out_day: str = "service_date") -> DataFrame:
    """One row per calendar day an interval touches, with the minutes that
    fall in that day (G6). The interval is [start, end); an empty interval
    keeps one row for its start day with 0 minutes."""
    last_day = F.greatest(F.to_date(start), F.to_date(F.col(end) - F.expr("INTERVAL 1 MICROSECOND")))
    days = F.sequence(F.to_date(start), last_day)
    exploded = df.withColumn(out_day, F.explode(days))
    day_start = F.col(out_day).cast("timestamp_ntz")
    day_end = F.date_add(F.col(out_day), 1).cast("timestamp_ntz")
    lo = F.greatest(F.col(start), day_start)
    hi = F.least(F.col(end), day_end)
    return exploded.withColumn("minutes_in_day", minutes_floor(lo, hi))


def _clock_hours(episodes: DataFrame, key: str) -> DataFrame:
    """(key, first and last clock hour of each episode). An open episode runs to
    its key's last poll; an empty one counts in its start hour."""
    end = F.coalesce("ended_at", "last_seen_at")
    last = F.greatest(hour_trunc("started_at"), hour_trunc(end - F.expr("INTERVAL 1 MICROSECOND")))
    return episodes.select(F.col(key), hour_trunc("started_at").alias("_first"), last.alias("_last"))


def lines_per_hour(episodes: DataFrame, key: str, hour_col: str = "event_hour") -> DataFrame:
    """Distinct disrupted keys per clock hour and their sorted, comma-separated
    ids (F12). An episode counts in every hour it overlaps.

    What is shuffled is a row per key and day with the day's hours as bits, not
    a row per hour. A day's list holds each id once, so it is bounded by the
    number of lines. Without a need for ids, ``line_counts_per_hour`` is cheaper."""
    hours = _clock_hours(episodes, key)
    hours = hours.withColumn("_day", F.explode(F.sequence(F.to_date("_first"), F.to_date("_last"))))
    low = F.when(F.to_date("_first") == F.col("_day"), F.hour("_first")).otherwise(0)
    high = F.when(F.to_date("_last") == F.col("_day"), F.hour("_last")).otherwise(23)
    rows = hours.select("_day", F.col(key).cast("string").alias("_id"), low.alias("_low"), high.alias("_high"))
    bits = F.expr("shiftleft(1, _high + 1) - shiftleft(1, _low)")
    days = rows.groupBy("_day", "_id").agg(F.bit_or(bits).alias("_bits")).groupBy("_day").agg(F.array_sort(F.collect_list(F.struct("_id", "_bits"))).alias("_keys"))

    each = F.inline(F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.struct(
        h.alias("_hour"), F.transform(F.filter("_keys", lambda k: F.getbit(k["_bits"], h) == 1), lambda k: k["_id"]).alias("_ids"))))
    start = F.col("_day").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("_hour"))
    return (days.select("_day", each).where(F.size("_ids") > 0)
            .select(start.alias(hour_col), F.size("_ids").cast("bigint").alias("disrupted_lines"), F.array_join("_ids", ",").alias("disrupted_line_ids")))


def line_counts_per_hour(episodes: DataFrame, key: str, hour_col: str = "event_hour") -> DataFrame:
    """Distinct disrupted keys per clock hour by a sweep over boundaries (F12);
    a key's episodes do not overlap, as those of ``episodes``.

    An episode is carried into every hour after its first: +1 there, -1 after
    its last, and a running sum over the hours counts the keys carried in. A key
    that begins an episode in an hour is new there unless one of its episodes is
    carried in, which then ends in that hour. So two rows per episode are
    shuffled, however long it lasts, and the running sum reads a row per hour."""
    hours = _clock_hours(episodes, key)
    hour = F.expr("INTERVAL 1 HOUR")
    tail = F.when(F.col("_last") > F.col("_first"), F.struct(F.col("_last").alias("h"), F.lit(False).alias("begins")))
    marks = hours.select(key, F.explode(F.array_compact(F.array(F.struct(F.col("_first").alias("h"), F.lit(True).alias("begins")), tail))).alias("_m"))
    own = marks.groupBy(key, F.col("_m.h").alias(hour_col)).agg(F.bool_and("_m.begins").alias("_new"))
    new = own.groupBy(hour_col).agg(F.count_if("_new").alias("_new"))
    steps = hours.where(F.col("_last") > F.col("_first")).select(F.explode(F.array(
        F.struct((F.col("_first") + hour).alias(hour_col), F.lit(1).alias("_step")), F.struct((F.col("_last") + hour).alias(hour_col), F.lit(-1).alias("_step")))).alias("_s"))
    steps = steps.groupBy(F.col(f"_s.{hour_col}").alias(hour_col)).agg(F.sum("_s._step").alias("_step"))
    both = new.join(steps, hour_col, "full_outer")
    line = Window.orderBy(hour_col)  # a row per hour in which something begins or ends
    run = both.select(hour_col, F.coalesce("_new", F.lit(0)).alias("_new"), F.sum(F.coalesce("_step", F.lit(0))).over(line).alias("_carried"),
                      F.lead(hour_col).over(line).alias("_until"))
    each = F.explode(F.sequence(F.col(hour_col), F.coalesce(F.col("_until") - hour, F.col(hour_col)), hour)).alias("_at")
    out = run.select(hour_col, "_new", "_carried", each)
    count = F.col("_carried") + F.when(F.col("_at") == F.col(hour_col), F.col("_new")).otherwise(0)
    return out.select(F.col("_at").alias(hour_col), count.cast("bigint").alias("disrupted_lines")).where("disrupted_lines > 0")
