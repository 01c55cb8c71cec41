"""Tables split by key hash, of which a batch rewrites the buckets it touches
(E1 incrementally; the SCD2 table uses the same layout).

A key's rows lie in ``_buckets=<n>/_bucket=<hash of the key modulo n>``. A batch
reads the buckets of its own keys (partition filters, at most n numbers reach
the driver), merges them and writes them to a pending folder first. Then each
finished bucket folder takes the place of the old one. A job that breaks before
the pending folder is whole has changed nothing; one that breaks later is
finished by the next call, so repeating a broken batch gives the same table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metroframe.operators.staging import dedup_latest
from metroframe.session import cut_lineage

BUCKETS = 256


def bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder for Hadoop's own file calls."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _folder(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(p)) if fs.exists(p) else []


def _pending(path: str) -> str:
    return path.rstrip("/") + "_pending"


def read_buckets(spark: SparkSession, path: str, only: list[int] | None = None, keep_bucket: bool = False) -> DataFrame:
    """The table, or the buckets ``only`` of it (the other folders are not listed as input)."""
    table = spark.read.parquet(path)
    if only is not None:
        table = table.where(F.col("_bucket").isin(only))
    return table if keep_bucket else table.drop("_buckets", "_bucket")


def touched(rows: DataFrame) -> list[int]:
    """The bucket numbers in ``rows``: at most as many as there are buckets."""
    return sorted(r[0] for r in rows.select("_bucket").distinct().collect())


def recover(spark: SparkSession, path: str) -> None:
    """Finish what a broken call left: whole pending batches are put in place."""
    for batch in _children(spark, _pending(path)):
        if exists(spark, f"{batch}/_SUCCESS"):
            _put_in_place(spark, path, batch)
        fs, p = _folder(spark, batch)
        fs.delete(p, True)


def _put_in_place(spark: SparkSession, path: str, batch: str) -> None:
    for group in _children(spark, batch):
        if "_buckets=" not in group.rsplit("/", 1)[1]:
            continue
        for folder in _children(spark, group):
            place = f"{path.rstrip('/')}/{group.rsplit('/', 1)[1]}/{folder.rsplit('/', 1)[1]}"
            fs, target = _folder(spark, place)
            fs.delete(target, True)  # its rows are in the pending folder, which a broken call leaves behind
            fs.mkdirs(target.getParent())
            fs.rename(_folder(spark, folder)[1], target)


def replace_buckets(rows: DataFrame, path: str, buckets: int) -> None:
    """Write the whole buckets that ``rows`` (with ``_bucket``) hold and let
    them take the place of the stored ones."""
    spark = rows.sparkSession
    batch = f"{_pending(path)}/{uuid.uuid4().hex}"
    # the hint splits a large bucket over tasks and brings a small one to one file
    rows.withColumn("_buckets", F.lit(buckets)).hint("rebalance", "_bucket").write.partitionBy("_buckets", "_bucket").parquet(batch)
    recover(spark, path)


def check_layout(spark: SparkSession, path: str, buckets: int) -> None:
    names = [c.rsplit("/", 1)[1] for c in _children(spark, path)]
    if any(n.startswith("_buckets=") and n != f"_buckets={buckets}" for n in names):
        raise ValueError(f"{path} is split into another number of buckets than {buckets}")


def upsert_latest(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], order: list[str], buckets: int = BUCKETS) -> dict[str, int]:
    """Merge a batch into the stored table of the latest row per key (E1):
    afterwards the table equals ``dedup_latest`` over all batches so far, in
    whatever order and however often they came. Returns how many buckets there
    are and how many were rewritten; an empty batch rewrites none."""
    recover(spark, path)
    check_layout(spark, path, buckets)
    fresh = cut_lineage(dedup_latest(batch, keys, order).withColumn("_bucket", bucket(keys, buckets)), spark, "upsert")
    some = touched(fresh)
    if some:
        merged = fresh
        if _children(spark, path):
            old = read_buckets(spark, path, some, keep_bucket=True).select(fresh.columns)
            merged = dedup_latest(old.unionByName(fresh), [*keys, "_bucket"], order)
        replace_buckets(merged, path, buckets)
    elif not _children(spark, path):
        fresh.withColumn("_buckets", F.lit(buckets)).limit(0).write.mode("append").parquet(f"{path}/_buckets={buckets}/_bucket=0")
    return {"buckets": buckets, "rewritten": len(some)}
