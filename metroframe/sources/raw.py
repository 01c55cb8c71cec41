"""Scans and sinks.

* Driver tables are Parquet: ``load`` reads them with column pruning and
  filter push-down left to Catalyst.
* The raw zone is NDJSON: ``read_raw_json`` keeps each source line as
  ``raw_json`` (exact text) and parses it with an explicit schema, so no
  schema inference pass runs over the data.
* Sinks partition by date so that lookback reads prune directories.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# Raw NDJSON
# ---------------------------------------------------------------------------

def parse_json_lines(lines: DataFrame, schema: T.StructType, line_col: str = "value",
                     keep_raw: bool = True, carry: list[str] | None = None) -> DataFrame:
    """Parse NDJSON text lines with an explicit schema (A1). Unknown fields
    are ignored; malformed lines give nulls (no failure)."""
    parsed = F.from_json(F.col(line_col), schema, {"mode": "PERMISSIVE"}).alias("_rec")
    extra = [*(carry or []), *(["raw_json"] if keep_raw else [])]
    cols = [parsed, *(carry or [])] + ([F.col(line_col).alias("raw_json")] if keep_raw else [])
    return lines.select(*cols).select("_rec.*", *extra)


def read_raw_json(spark: SparkSession, path: str, schema: T.StructType, with_file: bool = True) -> DataFrame:
    """Scan a raw-zone folder (``source/YYYY/MM/DD/run.ndjson`` or a
    ``year=/month=/day=`` layout) with one explicit schema per source."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    if with_file:
        lines = lines.withColumn("_source_file", F.col("_metadata.file_path"))
    parsed = F.from_json(F.col("value"), schema, {"mode": "PERMISSIVE"}).alias("_rec")
    extra = ["_source_file"] if with_file else []
    return lines.select(parsed, F.col("value").alias("raw_json"), *extra).select("_rec.*", "raw_json", *extra)


def raw_key(source: str, run_id: str, year: int, month: int, day: int) -> str:
    """Object key of one run's file: ``source/YYYY/MM/DD/run_id.ndjson``."""
    return f"{source}/{year:04d}/{month:02d}/{day:02d}/{run_id}.ndjson"


def observed_counts(seen: Observation, names: list[str]) -> dict[str, int]:
    """Counts observed on a finished write. A plan that the optimizer proves
    empty carries no metrics, and PySpark cannot turn their empty row into a
    Row: all counts are 0 then."""
    try:
        found = seen.get
    except Py4JJavaError as error:
        if "assertion failed" not in str(error.java_exception):
            raise
        found = {}
    return {n: int(found.get(n) or 0) for n in names}


def write_ndjson(df: DataFrame, path: str, date_col: str) -> str:
    """Append a run to the raw zone, partitioned by year/month/day of
    ``date_col`` (A10), rebalanced so a heavy day is split over several
    tasks. An empty input leaves no data files and returns ''; the row count
    is observed on the write itself, not by a second run of the plan."""
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows")).withColumns({
        "year": F.date_format(date_col, "yyyy"),
        "month": F.date_format(date_col, "MM"),
        "day": F.date_format(date_col, "dd"),
    })
    (out.hint("rebalance", "year", "month", "day")
        .write.mode("append").partitionBy("year", "month", "day").json(path))
    return path if observed_counts(seen, ["rows"])["rows"] else ""


def append_rows(df: DataFrame, path: str, columns: list[str], fmt: str = "parquet", required: list[str] | None = None
                ) -> dict[str, int]:
    """Append to a raw table keeping only its declared columns (A11): unknown
    source columns are ignored, missing ones are written as null. Rows that
    lack a ``required`` value are not appended. Returns the accepted and
    failed row counts, observed on the same pass."""
    present = set(df.columns)
    cols = [F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in columns]
    complete = F.lit(True)
    for c in required or []:
        complete = complete & F.col(c).isNotNull()
    seen = Observation()
    rows = df.select(*cols).observe(seen, F.count_if(complete).alias("accepted"), F.count_if(~complete).alias("failed"))
    rows.where(complete).write.mode("append").format(fmt).save(path)
    return observed_counts(seen, ["accepted", "failed"])


def write_mart(df: DataFrame, path: str, partition_col: str, cluster_cols: list[str], rebuild: bool = False) -> str:
    """Mart sink (A12): rows of one date go to few tasks (few files per
    partition folder), but the ``rebalance`` hint lets AQE split a date that
    holds a large share of the data over several tasks instead of one; rows
    are sorted within tasks by the cluster keys (min/max row-group
    skipping). Dynamic partition overwrite replaces only the dates written; a
    full ``rebuild`` replaces the table, so that a date without rows keeps no
    old files."""
    (df.hint("rebalance", partition_col)
       .sortWithinPartitions(partition_col, *cluster_cols)
       .write.mode("overwrite").option("partitionOverwriteMode", "static" if rebuild else "dynamic")
       .partitionBy(partition_col).parquet(path))
    return path


# ---------------------------------------------------------------------------
# Bounded and incremental reads
# ---------------------------------------------------------------------------

def incremental_lookback(df: DataFrame, ts: str, as_of, hours: int | None = None, days: int | None = None,
                         partition_date: str | None = None) -> DataFrame:
    """Rows with event time at or after ``as_of`` minus the lookback (A3).
    ``as_of`` is passed in (a literal or column), never read from the clock
    inside the plan, so a rerun sees the same window. With
    ``partition_date`` (the raw zone's ``_ingestion_date`` partition) the
    same bound prunes whole date folders before any file is opened."""
    width = F.make_dt_interval(F.lit(days or 0), F.lit(hours or 0), F.lit(0), F.lit(0))
    since = (F.lit(as_of).cast("timestamp_ntz") if not isinstance(as_of, Column) else as_of) - width
    out = df.filter(F.col(ts) >= since)
    if partition_date:
        out = out.filter(F.col(partition_date) >= F.to_date(since))
    return out


def recent_top_k(df: DataFrame, ts: str, tiebreak: str, n: int, offset: int = 0) -> DataFrame:
    """Most-recent-first page (A4): total order (ts desc, tiebreak desc),
    then ``offset``/``limit``. Plans as a top-k (TakeOrderedAndProject)
    without a global sort of the input."""
    ordered = df.orderBy(F.col(ts).desc(), F.col(tiebreak).desc())
    if offset:
        return ordered.limit(offset + n).offset(offset)
    return ordered.limit(n)


def dataset_probe(df: DataFrame, ts: str) -> DataFrame:
    """Row count and event-time range in one aggregation (A5)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def unpack_arrays(df: DataFrame, key: list[str], time_array: str, arrays: dict[str, str],
                  pos_col: str = "pos", time_col: str = "time") -> DataFrame:
    """Columnar payload → rows (A6): one row per element of ``time_array``;
    the other arrays are read at the same index, null when shorter, and
    their extra tail is ignored."""
    exploded = df.select(*key, *arrays.values(), F.posexplode(time_array).alias(pos_col, time_col))
    return exploded.select(*key, pos_col, time_col,
                           *[F.get(F.col(src), F.col(pos_col)).alias(out) for out, src in arrays.items()])


def city_union(parts: dict[str, DataFrame], coords: DataFrame | None = None, city_col: str = "city") -> DataFrame:
    """Per-city frames labelled and unioned by name (A7), coordinates from a
    city table."""
    out = None
    for city, frame in parts.items():
        labelled = frame.withColumn(city_col, F.lit(city))
        out = labelled if out is None else out.unionByName(labelled, allowMissingColumns=True)
    if coords is not None:
        out = out.join(coords, city_col, "left")
    return out


def ingest_metadata(df: DataFrame, run_id: str, run_ts: str, payload_cols: list[str | Column] | None = None) -> DataFrame:
    """_ingestion_id / _ingestion_timestamp / _ingestion_date / _source_file
    (B7). The id is a hash of (run id, record) — stable across task retries,
    unlike uuid(). ``payload_cols`` gives the record another form (names or
    columns); it should hold every column, or records that differ in the others
    only get one id."""
    payload = F.to_json(F.struct(*[F.col(c) if isinstance(c, str) else c for c in (payload_cols or df.columns)]))
    return df.withColumns({
        "_ingestion_id": F.sha2(F.concat_ws("|", F.lit(run_id), payload), 256),
        "_ingestion_timestamp": F.lit(run_ts).cast("timestamp_ntz"),
        "_ingestion_date": F.to_date(F.lit(run_ts)),
        "_source_file": F.col("_metadata.file_path"),
    })


def raw_projection(df: DataFrame, mapping: list[tuple[str, Column]]) -> DataFrame:
    """Project onto a raw table's column list, in its fixed order."""
    return df.select(*[c.alias(name) for name, c in mapping])


def explode_nested(df: DataFrame, array_col: str, keep: list[str]) -> DataFrame:
    """Nested status array → one row per element (A9); empty or null arrays
    keep their parent row with null fields."""
    return df.select(*keep, F.explode_outer(array_col).alias("_el")).select(*keep, "_el.*")

