"""Invariants of the operators on the driver tables (sf0.001, where hourly
data has gaps) and stream = batch equalities."""

from pyspark.sql import functions as F

import __spark_entry__ as entry

Q = entry.queries()


def run(spark, key, sf):
    return Q[key](spark, sf)


def test_dedup_key_unique(spark, sf_small):
    df = run(spark, "dedup_latest", sf_small)
    assert df.count() == df.select("l_orderkey", "l_linenumber").distinct().count()
    raw = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    assert df.count() == raw.select("l_orderkey", "l_linenumber").distinct().count()


def test_enrichment_keeps_row_count(spark, sf_small):
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    n_req = ev.filter(F.col("event_type").isin("purchase", "click")).count()
    assert run(spark, "complaints_enriched", sf_small).count() == n_req
    assert run(spark, "enrich_hourly", sf_small).count() == n_req


def test_scd_intervals(spark, sf_small):
    h = run(spark, "scd2_history", sf_small)
    assert h.filter("is_current").groupBy("user_id").count().filter("count <> 1").count() == 0
    assert h.filter(F.col("valid_to") <= F.col("valid_from")).count() == 0
    assert h.count() == h.select("scd_id").distinct().count()
    merged = run(spark, "scd2_merge", sf_small).where("not is_deleted")
    h = h.where("not (is_current and user_id % 50 = 7)")  # deleted by the merge
    cols = ["scd_id", "user_id", "event_type", "valid_from", "valid_to", "is_current"]
    assert sorted(merged.select(cols).collect()) == sorted(h.select(cols).collect())


def test_transit_minutes_bounded(spark, sf_small):
    t = run(spark, "transit_performance", sf_small)
    assert t.filter((F.col("observed_minutes") > 1440) | (F.col("disruption_minutes") > F.col("observed_minutes"))
                    ).count() == 0


def test_features_no_nulls_outside_labels(spark, sf_small):
    f = run(spark, "ml_features", sf_small)
    feature_cols = [c for c in f.columns if not c.startswith("label_")]
    nulls = f.select([F.count_if(F.col(c).isNull()).alias(c) for c in feature_cols]).collect()[0].asDict()
    assert all(v == 0 for v in nulls.values()), nulls


def test_spine_is_dense(spark, sf_small):
    sp = run(spark, "hour_spine", sf_small)
    bounds = sp.groupBy("city").agg(F.min("event_hour").alias("lo"), F.max("event_hour").alias("hi"),
                                    F.count(F.lit(1)).alias("n")).collect()
    for b in bounds:
        assert b.n == int((b.hi - b.lo).total_seconds() // 3600) + 1


def test_stream_episodes_equal_batch(spark, sf_small):
    s = run(spark, "stream_episodes", sf_small)
    b = run(spark, "disruption_episodes", sf_small).filter(F.col("ended_at").isNotNull())
    cols = ["line_id", "severity_level", "started_at", "ended_at", "duration_minutes"]
    assert sorted(s.select(cols).collect()) == sorted(b.select(cols).collect())


def test_stream_dedup_equals_batch_keys(spark, sf_small):
    s = run(spark, "stream_dedup", sf_small)
    b = run(spark, "dedup_window", sf_small).select("user_id", "bucket_start")
    assert sorted(s.collect()) == sorted(b.collect())


def test_late_rows_kept_raw_dropped_from_state(spark, sf_small):
    hourly = run(spark, "stream_late_rows", sf_small)
    late = F.col("window_start") < F.lit("2024-01-15").cast("timestamp_ntz")
    assert hourly.filter(late & F.col("n_events").isNotNull()).count() == 0
    assert hourly.agg(F.sum("raw_events")).first()[0] == spark.read.parquet(f"{sf_small}/events.parquet").count()


def test_sla_by_borough_counts_all_orders(spark, sf_small):
    s = run(spark, "sla_by_borough", sf_small)
    n = spark.read.parquet(f"{sf_small}/orders.parquet").count()
    assert s.agg(F.sum("n_requests")).collect()[0][0] == n


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "sla_compliance" in df.columns


def test_stream_episodes_state_across_micro_batches(spark, sf_small, tmp_path):
    """Polls arrive as one file per 5 days, one file per micro-batch: the
    per-line state carried between batches must give the batch answer."""
    from metroframe.plans.bind_timeline import line_episodes, line_polls
    from metroframe.streaming import polls as P

    polls = line_polls(spark, sf_small).select("line_id", "ts", "disrupted", "severity")
    landing = tmp_path / "landing"
    for start in range(1, 31, 5):
        lo = F.lit(f"2024-01-{start:02d}").cast("timestamp_ntz")
        hi = F.lit(f"2024-01-{start + 5:02d}" if start + 5 <= 31 else "2024-02-01").cast("timestamp_ntz")
        # one small file per chunk so the files arrive in time order (test fixture only)
        polls.filter((F.col("ts") >= lo) & (F.col("ts") < hi)).coalesce(1).write.mode("append").parquet(str(landing))
    stream = P.poll_stream(spark, str(landing), polls.schema, max_files_per_trigger=1, event_time="ts")
    out = P.run_to_parquet(P.stream_episodes(stream), "multi", path=str(tmp_path / "out"))
    got = spark.read.parquet(out).select("line_id", "severity_level", F.col("started_at").cast("timestamp_ntz"),
                                         F.col("ended_at").cast("timestamp_ntz"))
    want = line_episodes(spark, sf_small).filter(F.col("ended_at").isNotNull()).select(
        "line_id", F.col("severity_level").cast("long"), "started_at", "ended_at")
    assert sorted(got.collect()) == sorted(want.collect())


def test_stream_processor_ships_by_value(tmp_path):
    """Python workers need not have the package: the stateful processor
    unpickles in a process that cannot import metroframe."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from metroframe.streaming import polls as P
    blob = tmp_path / "fn.pkl"
    blob.write_bytes(cloudpickle.dumps(P._episode_processor))
    code = ("import pickle, sys; sys.path = [p for p in sys.path if 'repo' not in p]; "
            "f = pickle.load(open(sys.argv[1], 'rb')); "
            "import importlib.util; assert importlib.util.find_spec('metroframe') is None; print(f.__name__)")
    out = subprocess.run([sys.executable, "-c", code, str(blob)], cwd=tmp_path, capture_output=True, text=True,
                         timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.strip() == "_episode_processor"


def test_composed_queries_scan_events_once(spark, sf_small):
    """All domains of a (city, hour) or (city, day) are conditional aggregates
    of one scan; shared subtrees are exchanged once."""
    import contextlib
    import io
    for key in ("cross_domain_daily", "correlations", "lead_labels", "ml_features"):
        df = run(spark, key, sf_small)
        df.collect()
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            df.explain()
        final = text.getvalue().split("== Initial Plan ==")[0]
        assert final.count("FileScan parquet") <= 2, (key, final)
