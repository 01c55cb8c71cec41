"""Session settings in one place, plus the shared work folder.

The settings are the ones every builder relies on: UTC session zone, AQE
with skew-join handling, dynamic partition overwrite. A cluster owns its
session, so ``configure`` only sets what the builder needs and never
overrides ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Streaming state off the JVM heap, checkpointed incrementally: dedup keys
    # and per-line episode state scale with keys, not with heap size.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "metroframe") -> SparkSession:
    """Local session for tests and the benchmark (not used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Only a local master (tests, laptops) gets a
    private folder when it is unset: on a cluster a machine-local folder would
    be invisible to the other machines, so that is an error."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "local")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="metroframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables
    (sinks, round trips, lineage cuts). Unique per call so retries and
    concurrent jobs never collide."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/metroframe/{name}-{uuid.uuid4().hex}"


def cut_lineage(df, spark: SparkSession | None = None, name: str = "stage"):
    """Materialise ``df`` as Parquet in the shared folder and read it back.

    Downstream jobs restart from files rather than recomputing the lineage
    when executors are lost, and a join of two such tables has a plain
    exchange on each side, which adaptive execution can split when a key is
    hot."""
    spark = spark or df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
