"""Correction of episodes by late polls (I4).

The stream drops polls that come after a later one of their line; the raw sink
has them. The episode table is split by line hash, so a correction reads and
rewrites the buckets of the lines that late polls name: their runs are rebuilt
from the raw polls, and afterwards equal the batch build over all polls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroframe.operators import timeline as TL
from metroframe.operators import upsert as U


def write_episodes(episodes: DataFrame, path: str, key: str, buckets: int = U.BUCKETS) -> None:
    """An episode table split by line hash."""
    U.recover(episodes.sparkSession, path)
    U.check_layout(episodes.sparkSession, path, buckets)
    U.replace_buckets(episodes.withColumn("_bucket", U.bucket([key], buckets)), path, buckets)


def correct_episodes(spark: SparkSession, path: str, polls: DataFrame, late: DataFrame, key: str, ts: str, flag: str,
                     extra_state: list[str] | None = None, max_gap_seconds: int | None = None, buckets: int = U.BUCKETS) -> dict[str, int]:
    """Rebuild the episodes of the lines in ``late`` from ``polls`` (the raw
    sink with all polls, late ones included) and put them in the place of the
    stored ones. ``late`` needs the line only; lines without a stored bucket are
    added. Repeating a correction changes nothing."""
    U.recover(spark, path)
    U.check_layout(spark, path, buckets)
    lines = late.select(F.col(key)).where(F.col(key).isNotNull()).distinct().withColumn("_bucket", U.bucket([key], buckets))
    some = U.touched(lines)
    if not some:
        return {"buckets": buckets, "rewritten": 0}
    names = lines.select(key)
    rebuilt = TL.episodes(polls.join(names, key, "left_semi"), key, ts, flag, extra_state, max_gap_seconds).withColumn("_bucket", U.bucket([key], buckets))
    stored = U.read_buckets(spark, path, some, keep_bucket=True)
    others = stored.join(names, key, "left_anti").select(rebuilt.columns)
    U.replace_buckets(others.unionByName(rebuilt), path, buckets)
    return {"buckets": buckets, "rewritten": len(some)}
