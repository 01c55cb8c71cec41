"""Which landed files a job has read (A3 as a read protocol).

A job asks for the files under a date-partitioned folder that its log does not
list yet, reads them, and records them when its own output is in place. A job
that breaks in between reads the same files again, so what it writes must give
the same table when a batch is repeated (``operators.upsert`` does).

The log keeps each file's date, and its newest date less ``days`` is the high-
water mark: only files of date folders from there on are considered, and only the
same dates of the log are read. A file that lands later than that in an older folder is
found by a call with more ``days`` (or None: all dates).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroframe.operators.upsert import exists

LOOKBACK_DAYS = 7


@dataclass(frozen=True)
class Unread:
    """The unread files of a folder: their rows, how many there are, and a name
    for this batch that is the same when it is asked for again."""
    rows: DataFrame
    files: tuple[str, ...]
    batch_id: str
    log_path: str
    date_col: str

    def done(self) -> None:
        """Record the files as read; call it when the batch's output is in place."""
        if self.files:
            spark = self.rows.sparkSession
            listed = spark.createDataFrame([(f, self.batch_id, _date_of(f, self.date_col)) for f in self.files], "file string, batch_id string, date string")
            listed.select("file", "batch_id", F.to_date("date").alias("date")).coalesce(1).write.mode("append").partitionBy("date").parquet(self.log_path)


def _date_of(file: str, date_col: str) -> str | None:
    parts = [p.split("=", 1)[1] for p in file.split("/") if p.startswith(f"{date_col}=")]
    return parts[-1] if parts else None


def unread_files(spark: SparkSession, path: str, log_path: str, date_col: str = "_ingestion_date", days: int | None = LOOKBACK_DAYS) -> Unread:
    """The files under ``path`` that the log does not list, from ``days`` before
    its newest date on. Spark lists the folder's file names when it opens the
    table; of them and of the log only those dates are looked at, and the rows
    come from the unread files only, with the date as a partition filter."""
    table = spark.read.parquet(path)
    log = spark.read.schema("file string, batch_id string, date date").parquet(log_path) if exists(spark, log_path) else None
    mark = log.agg(F.max("date")).first()[0] if log is not None else None
    since = mark - timedelta(days=days) if mark is not None and days is not None else None
    if since is not None:
        log = log.where(F.col("date") >= F.lit(since))
    known = {r.file for r in log.select("file").collect()} if log is not None else set()
    files = tuple(sorted(f for f in table.inputFiles() if f not in known and (since is None or (_date_of(f, date_col) or "") >= since.isoformat())))
    rows = spark.read.schema(table.schema).option("basePath", path).parquet(*files) if files else table.limit(0)
    if files and since is not None:
        rows = rows.where(F.col(date_col) >= F.lit(since))
    return Unread(rows, files, hashlib.md5("\n".join(files).encode()).hexdigest(), log_path, date_col)
