"""Structured Streaming over the poll feed.

Files land in a folder; ``poll_stream`` reads them as an unbounded source
with an explicit schema. Every operator has a batch twin that must give the
same answer on the same input (streaming = batch tests):

* I1 ``stream_dedup``: watermark + dropDuplicatesWithinWatermark on
  (key, time bucket) — state is bounded by the watermark.
* I2 ``episode_events``: per-line stateful processor (applyInPandasWithState)
  emitting closed disruption episodes, with event-time timers for lines that
  fall silent, and late polls as rows of their own; batch twin ``timeline.episodes``.
* I3 ``stream_hourly``: tumbling hourly counts in append mode (a window is
  emitted once the watermark passes its end).
* I4 late rows: the raw sink keeps everything, the watermark drops late rows
  from state; ``operators.corrections`` mends the episodes of the lines that
  late polls touch.

Sinks are Parquet folders with checkpoints in the shared work folder, so a
restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

import sys
import warnings
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from metroframe.session import work_path

# The stateful processor below runs in Python workers, which need not have
# this package installed (e.g. a driver-only checkout): its code is shipped
# by value; it only depends on pandas.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# PySpark's own Arrow-to-pandas step for grouped state concatenates empty
# frames and pandas flags that; it is noise, not a problem in this module.
warnings.filterwarnings("ignore", category=FutureWarning, module="pyspark.sql.pandas.serializers")


def poll_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None,
                event_time: str | None = None) -> DataFrame:
    """Unbounded scan of a landing folder (A8). ``event_time`` is cast to
    TIMESTAMP so watermarks apply (timestamp_ntz is rejected by them)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(path)
    if event_time:
        df = df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return df


def run_to_parquet(stream: DataFrame, name: str, mode: str = "append", path: str | None = None,
                   checkpoint: str | None = None, partition_by: list[str] | None = None, dropped: list[int] | None = None) -> str:
    """Drain everything available (``availableNow``) into a Parquet sink and
    wait; returns the sink folder. Re-running with the same folders resumes
    from the checkpoint."""
    spark = stream.sparkSession
    path = path or work_path(spark, f"stream-{name}")
    checkpoint = checkpoint or f"{path}-checkpoint"
    q = (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
         .partitionBy(*(partition_by or [])).outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
    if dropped is not None:  # rows behind the watermark, as the last progress reports count them
        dropped.append(sum(int(op.numRowsDroppedByWatermark) for p in q.recentProgress for op in p.stateOperators))
    if q.exception() is not None:
        raise q.exception()
    return path


def stream_dedup(stream: DataFrame, key: str, ts: str, width: str, delay: str,
                 bucket_col: str = "bucket_start") -> DataFrame:
    """First poll per (key, bucket) within the watermark."""
    with_bucket = stream.withColumn(bucket_col, F.window(ts, width).start)
    return with_bucket.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key, bucket_col])


def stream_hourly(stream: DataFrame, ts: str, group_cols: list[str], delay: str, width: str = "1 hour") -> DataFrame:
    """Tumbling-window counts (I3), append mode."""
    return (stream.withWatermark(ts, delay).groupBy(F.window(ts, width), *group_cols)
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select(*group_cols, F.col("window.start").alias("window_start"), "n_events"))


def event_schema(key_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("line_id", key_type),
        T.StructField("severity_level", T.LongType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("ended_at", T.TimestampType()),
        T.StructField("kind", T.StringType()),
    ])


EPISODE_STATE = T.StructType([
    T.StructField("last_ts", T.TimestampType()),
    T.StructField("disrupted", T.BooleanType()),
    T.StructField("severity", T.LongType()),
    T.StructField("open_start", T.TimestampType()),
])


def _episode_processor(max_gap_seconds: int | None, timers: bool = False):
    """Per-line state machine over polls sorted by time. It keeps the last
    poll's state and the start of the open episode, and finds the changes of a
    micro-batch by comparing its arrays with themselves, shifted. An episode is
    emitted when the line leaves a disrupted state, changes severity, or was not
    polled for over ``max_gap_seconds`` (it then ends at the last poll seen).
    With ``timers`` that gap closes the episode once the watermark has passed
    it, without a next poll. A poll not later than the last seen one is late: it
    changes nothing and is emitted as a row of kind ``late`` (the raw sink has
    it too, and a correction run mends the episodes)."""
    columns = ["line_id", "severity_level", "started_at", "ended_at", "kind"]

    def process(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last_ts, disrupted, severity, open_start = state.get if state.exists else (None, None, None, None)
        if timers and state.hasTimedOut:
            state.update((last_ts, disrupted, severity, None))
            if disrupted and open_start is not None:
                yield pd.DataFrame([(key[0], int(severity), open_start, last_ts, "episode")], columns=columns)
            return
        polls = pd.concat(list(batches), ignore_index=True)
        late = polls[polls["ts"] <= last_ts] if last_ts is not None else polls.iloc[:0]
        # One state per poll time: the worst status (disrupted first, then the
        # lowest code) — the same rule as the batch path's collapse_statuses.
        polls = (polls.drop(late.index).sort_values(["ts", "disrupted", "severity"], ascending=[True, False, True], kind="stable")
                 .drop_duplicates("ts", keep="first"))
        rows = [(key[0], None if pd.isna(s) else int(s), t, None, "late") for t, s in zip(late["ts"], late["severity"])]
        if len(polls):
            # a poll without statuses: a state of its own, not disrupted
            ts, sev, dis = polls["ts"].tolist(), polls["severity"].fillna(-1).astype("int64").tolist(), polls["disrupted"].fillna(False).astype(bool).tolist()
            start = [] if last_ts is None else [last_ts]
            times = pd.Series(start + ts)
            states = pd.DataFrame({"d": ([] if last_ts is None else [disrupted]) + dis, "s": ([] if last_ts is None else [severity]) + sev})
            gap = (times.diff().dt.total_seconds() > max_gap_seconds) if max_gap_seconds is not None else pd.Series(False, index=times.index)
            change = gap | (states != states.shift()).any(axis=1)
            change.iloc[0] = last_ts is None
            begin = open_start if last_ts is not None else None
            on, code = (bool(disrupted), severity) if last_ts is not None else (False, None)
            for i in change.index[change]:
                if on and begin is not None:
                    rows.append((key[0], int(code), begin, times[i - 1] if gap[i] else times[i], "episode"))
                on, code = bool(states["d"][i]), int(states["s"][i])
                begin = times[i] if on else None
            state.update((ts[-1], dis[-1], sev[-1], begin))
            if timers:
                due = int(ts[-1].timestamp() * 1000) + max_gap_seconds * 1000 + 1
                state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        if rows:
            yield pd.DataFrame(rows, columns=columns).astype({"severity_level": "Int64"})

    return process


def episode_events(stream: DataFrame, key: str = "line_id", ts: str = "ts", flag: str = "disrupted",
                   severity: str = "severity", max_gap_seconds: int | None = None, delay: str | None = None) -> DataFrame:
    """Closed disruption episodes (kind ``episode``) and late polls (kind
    ``late``, their time in started_at) from the poll stream (I2). With
    ``delay`` and ``max_gap_seconds`` a line that falls silent has its episode
    closed when the watermark, ``delay`` behind the feed's newest poll, passes
    the gap; polls behind the watermark are then dropped by Spark, which counts
    them (``run_to_parquet``'s ``dropped``). Polls without a time are left out."""
    polls = stream.where(F.col(ts).isNotNull()).select(
        F.col(key).alias("line_id"), F.col(ts).alias("ts"),
        F.col(flag).alias("disrupted"), F.col(severity).cast("long").alias("severity"))
    timers = delay is not None and max_gap_seconds is not None
    if timers:
        polls = polls.withWatermark("ts", delay)
    return polls.groupBy("line_id").applyInPandasWithState(
        _episode_processor(max_gap_seconds, timers), event_schema(polls.schema["line_id"].dataType), EPISODE_STATE, "append",
        GroupStateTimeout.EventTimeTimeout if timers else GroupStateTimeout.NoTimeout)


def stream_episodes(stream: DataFrame, key: str = "line_id", ts: str = "ts", flag: str = "disrupted",
                    severity: str = "severity", max_gap_seconds: int | None = None, delay: str | None = None) -> DataFrame:
    """The episodes alone; they equal the closed rows of the batch
    ``timeline.episodes`` with the same gap rule on the same polls."""
    return episode_events(stream, key, ts, flag, severity, max_gap_seconds, delay).where("kind = 'episode'").drop("kind")
