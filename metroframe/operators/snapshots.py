"""SCD Type 2 history, incremental merge and transition queries (H1–H3).

A version opens only when a tracked column changes (null-safe), not on every
re-ingested copy (D9). History is built with the same bucketed
gaps-and-islands operator as transit episodes, so a hot key never sorts in
a single task. The incremental merge touches only the keys of the new batch;
late rows split the versions that hold their time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroframe.functions.columns import surrogate_key
from metroframe.operators import upsert as U
from metroframe.operators.timeline import islands
from metroframe.session import cut_lineage


def _finish(runs: DataFrame, key: str, tracked: list[str], *more) -> DataFrame:
    return runs.select(
        surrogate_key(key, F.date_format("valid_from", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("scd_id"),
        key, *tracked, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"), *more)


def scd2_history(df: DataFrame, key: str, tracked: list[str], updated_at: str, bucket: str = "day") -> DataFrame:
    """Full build (H1): one row per (key, version) with valid_from (first
    time the state was seen), valid_to (next version's valid_from; null =
    current) and a deterministic scd_id = md5(key | valid_from)."""
    runs = islands(df, key, updated_at, tracked, bucket=bucket, start="valid_from", end="valid_to")
    return _finish(runs, key, tracked)


def _rows(df: DataFrame, key: str, tracked: list[str], updated_at: str, time: str | None = None) -> DataFrame:
    return df.select(key, *tracked, F.col(time or updated_at).alias(updated_at), F.lit(False).alias("_gone"))


def _gone_rows(deletes: DataFrame, like: DataFrame, key: str, tracked: list[str], updated_at: str, time: str) -> DataFrame:
    """Deletions as a state of their own, in the columns of ``like``."""
    return deletes.select(F.col(key), *[F.lit(None).cast(like.schema[c].dataType).alias(c) for c in tracked], F.col(time).alias(updated_at), F.lit(True).alias("_gone"))


def _starts(history: DataFrame, key: str, tracked: list[str], updated_at: str) -> DataFrame:
    """What a history says was seen: each version's start, and deletions."""
    seen = _rows(history, key, tracked, updated_at, "valid_from")
    if "is_deleted" in history.columns:
        seen = seen.unionByName(_gone_rows(history.where("is_deleted"), history, key, tracked, updated_at, "valid_to"))
    return seen


def _versions(rows: DataFrame, key: str, tracked: list[str], updated_at: str, bucket: str, keep: list[str]) -> DataFrame:
    """Versions of rows with ``_gone``: a version that a deletion ends is
    marked is_deleted; the time without the key is no version. ``_last_seen``
    is the key's last time."""
    runs = islands(rows, key, updated_at, [*tracked, "_gone"], bucket=bucket, start="valid_from", end="valid_to", carry=keep)
    ends = runs.where("_gone").select(F.col(key).alias("_dead"), F.col("valid_from").alias("_at"))
    live = runs.where("not _gone").withColumnRenamed("last_seen_at", "_last_seen")
    out = live.join(ends, (F.col(key) == F.col("_dead")) & (F.col("valid_to") == F.col("_at")), "left")
    return _finish(out, key, tracked, F.col("_dead").isNotNull().alias("is_deleted"), "_last_seen", *keep)


def scd2_merge(history: DataFrame, updates: DataFrame, key: str, tracked: list[str], updated_at: str,
               bucket: str = "day", deletes: DataFrame | None = None) -> DataFrame:
    """Incremental merge (H2) of a batch into an existing history. Versions of
    the keys in the batch are split where its rows fall, late ones too: a late
    row ends the version that holds its time and itself ends at the next
    version's start. Other keys are carried over unchanged. With ``deletes``
    (key, ``updated_at``) the version that holds that time is closed and marked
    ``is_deleted``; a later update opens the key again."""
    rows = _rows(updates, key, tracked, updated_at)
    if deletes is not None:
        rows = rows.unionByName(_gone_rows(deletes, history, key, tracked, updated_at, updated_at))
    keys = rows.select(key).distinct()
    changed = _starts(history.join(keys, key, "left_semi"), key, tracked, updated_at).unionByName(rows)
    merged = _versions(changed, key, tracked, updated_at, bucket, []).drop("_last_seen")
    out = history.join(keys, key, "left_anti").select(*history.columns).unionByName(merged, allowMissingColumns=True)
    marked = deletes is not None or "is_deleted" in history.columns
    out = out.withColumn("is_deleted", F.coalesce("is_deleted", F.lit(False))) if marked else out.drop("is_deleted")
    return out.select("scd_id", key, *tracked, "valid_from", "valid_to", "is_current", *(["is_deleted"] if marked else []))


def merge_scd2_table(spark, path: str, updates: DataFrame, key: str, tracked: list[str], updated_at: str, bucket: str = "day",
                     deletes: DataFrame | None = None, batch_id: str | None = None) -> dict[str, int]:
    """The merge on a stored table of two parts, both split by key hash: the
    ``versions``, and what was ``seen`` (key, tracked columns, time), a folder
    per batch. Only the buckets of the batch's keys are read and rewritten.

    A key whose batch rows are all later than its last time is played on from
    its open version. The other keys, with late rows, are rebuilt from what was
    seen of them, so batches give the same table in whatever order they come.
    Repeating a batch changes nothing; after a broken attempt it gives the same
    table (give the same ``batch_id`` to keep its seen rows once)."""
    versions, seen = f"{path}/versions", f"{path}/seen"
    U.recover(spark, versions)
    buckets = _bucket_count(spark, versions)
    like = read_scd2_table(spark, path)
    rows = _rows(updates, key, tracked, updated_at)
    if deletes is not None:
        rows = rows.unionByName(_gone_rows(deletes, like, key, tracked, updated_at, updated_at))
    rows = rows.where(F.col(key).isNotNull() & F.col(updated_at).isNotNull()).distinct().withColumn("_bucket", U.bucket([key], buckets))
    rows = _add_seen(rows, seen, updated_at, batch_id or uuid.uuid4().hex)
    some = U.touched(rows)
    if not some:
        return {"buckets": buckets, "rewritten": 0, "late_keys": 0}
    old = U.read_buckets(spark, versions, some, keep_bucket=True).drop("_buckets")
    batch = rows.groupBy(key).agg(F.min(updated_at).alias("_from"))
    known = old.groupBy(key).agg(F.max("_last_seen").alias("_until"))
    keys = cut_lineage(batch.join(known, key, "left").select(key, F.coalesce(F.col("_from") <= F.col("_until"), F.lit(False)).alias("_late")), spark, "scd2-keys")
    late, on = keys.where("_late").select(key), keys.where("not _late").select(key)
    open_rows = old.where("valid_to is null").join(on, key, "left_semi")
    again = spark.read.parquet(seen).where(F.col("_bucket").isin(some)).withColumnRenamed("_seen_at", updated_at).join(late, key, "left_semi")
    columns = [key, *tracked, updated_at, "_gone", "_bucket"]
    replay = (open_rows.withColumns({updated_at: F.col("valid_from"), "_gone": F.lit(False)}).select(columns)
              .unionByName(rows.join(on, key, "left_semi").select(columns)).unionByName(again.select(columns).distinct()))
    new = _versions(replay, key, tracked, updated_at, bucket, ["_bucket"])
    # what stays: other keys' versions, and the closed ones of keys that are played on
    kept = old.join(keys, key, "left").where("_late is null or (not _late and valid_to is not null)").drop("_late")
    U.replace_buckets(kept.select(new.columns).unionByName(new), versions, buckets)
    return {"buckets": buckets, "rewritten": len(some), "late_keys": late.count()}


def _add_seen(rows: DataFrame, path: str, updated_at: str, batch_id: str) -> DataFrame:
    """The rows, written under the batch's name and read back."""
    (rows.withColumnRenamed(updated_at, "_seen_at").withColumn("_batch", F.lit(batch_id)).hint("rebalance", "_bucket")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch", "_bucket").parquet(path))
    stored = T.StructType([*(f for f in rows.withColumnRenamed(updated_at, "_seen_at").schema), T.StructField("_batch", T.StringType())])
    back = rows.sparkSession.read.schema(stored).parquet(path).where(F.col("_batch") == batch_id)
    return back.withColumnRenamed("_seen_at", updated_at).select(rows.columns)


def _bucket_count(spark, versions: str) -> int:
    return int(spark.read.parquet(versions).select(F.max("_buckets")).first()[0])


def write_scd2_table(history: DataFrame, path: str, observations: DataFrame | None = None, updated_at: str | None = None,
                     buckets: int = U.BUCKETS) -> None:
    """A full history (its columns in the order of ``scd2_history``) as the
    table that ``merge_scd2_table`` keeps. ``observations`` are the rows it was
    built from (key, tracked columns, ``updated_at``); without them only the
    versions' starts count as seen, so a late row then lasts to the next start."""
    columns = history.columns
    key, tracked = columns[1], columns[2:columns.index("valid_from")]
    whole = history if "is_deleted" in columns else history.withColumn("is_deleted", F.lit(False))
    if observations is None:
        seen = _starts(whole, key, tracked, "_seen_at")
    else:
        seen = _rows(observations.where(F.col(key).isNotNull() & F.col(updated_at).isNotNull()), key, tracked, "_seen_at", updated_at)
        if "is_deleted" in columns:
            seen = seen.unionByName(_gone_rows(history.where("is_deleted"), history, key, tracked, "_seen_at", "valid_to"))
    seen = _add_seen(seen.distinct().withColumn("_bucket", U.bucket([key], buckets)), f"{path}/seen", "_seen_at", "start")
    last = seen.groupBy(key).agg(F.max("_seen_at").alias("_last_seen"))
    whole = whole.join(last, key).withColumn("_bucket", U.bucket([key], buckets)).withColumn("_buckets", F.lit(buckets))
    (whole.hint("rebalance", "_bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_buckets", "_bucket")
     .parquet(f"{path}/versions"))


def read_scd2_table(spark, path: str) -> DataFrame:
    return U.read_buckets(spark, f"{path}/versions").drop("_last_seen")


def mark_deleted(history: DataFrame, deleted: DataFrame, key: str, deleted_at: str) -> DataFrame:
    """Close the open version of keys reported deleted and flag them; of
    several reports of a key the first counts."""
    d = deleted.groupBy(F.col(key).alias("_dk")).agg(F.min(deleted_at).alias("_dat"))
    out = history.join(d, (history[key] == d["_dk"]) & history["valid_to"].isNull(), "left")
    return out.select(
        *[c for c in history.columns if c not in ("valid_to", "is_current", "is_deleted")],
        F.coalesce("valid_to", "_dat").alias("valid_to"),
        (F.col("valid_to").isNull() & F.col("_dat").isNull()).alias("is_current"),
        F.col("_dat").isNotNull().alias("is_deleted"))


def state_transitions(df: DataFrame, key: str, state: str, updated_at: str, from_state: str, to_state: str,
                      bucket: str = "day") -> DataFrame:
    """When did a key move from one state to another (H3)?"""
    runs = islands(df, key, updated_at, [state], bucket=bucket, start="changed_at", with_previous=True)
    return (runs.filter((F.col(f"previous_{state}") == from_state) & (F.col(state) == to_state))
            .select(key, F.col(f"previous_{state}").alias("from_state"), F.col(state).alias("to_state"),
                    "changed_at"))
