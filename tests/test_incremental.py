"""Operators that keep up with new and late rows: each must equal the full
build, whatever the order in which rows arrive."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from metroframe.operators import corrections as X
from metroframe.operators import marts as M
from metroframe.operators import quality as Q
from metroframe.operators import snapshots as H
from metroframe.operators import staging as S
from metroframe.operators import timeline as TL
from metroframe.operators import upsert as U
from metroframe.sources.progress import unread_files
from metroframe.streaming import polls as PS


def polls(seed: int, lines: int = 4, n: int = 400, hours: int = 200):
    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    return [(f"l{rng.randrange(lines)}", base + dt.timedelta(minutes=rng.randrange(hours * 60)), rng.random() < 0.4, rng.choice([6, 9])) for _ in range(n)]


def islands_brute(rows, gap=None):
    """(line, flag, severity, start, end, last seen) from a plain loop per line."""
    out = []
    for line in sorted({r[0] for r in rows}):
        own = sorted({r[1:] for r in rows if r[0] == line})
        times = [t for t, *_ in own]
        held = None
        for i, (t, *state) in enumerate(own):
            broken = held and gap is not None and (t - times[i - 1]).total_seconds() > gap
            if held is None or broken or state != held[0]:
                if held:
                    out.append((line, *held[0], held[1], times[i - 1] if broken else t, times[-1]))
                held = (state, t)
        out.append((line, *held[0], held[1], None, times[-1]))
    return sorted(out, key=str)


@pytest.mark.parametrize("gap", [None, 3600 * 5])
@pytest.mark.parametrize("bucket", ["day", "month"])
def test_islands_equal_a_plain_loop(spark, gap, bucket):
    one_time = {}  # a state per line and time
    for r in polls(1):
        one_time[r[:2]] = r
    rows = list(one_time.values())
    df = spark.createDataFrame([(*r, 1) for r in [*rows, *rows[:50]]], "line string, t timestamp_ntz, flag boolean, severity int, x int").repartition(3)
    got = TL.islands(df, "line", "t", ["flag", "severity"], max_gap_seconds=gap, bucket=bucket).collect()
    assert sorted((tuple(r) for r in got), key=str) == islands_brute(rows, gap)
    nulls = df.unionByName(spark.createDataFrame([(None, rows[0][1], True, 6, 1), ("l0", None, True, 6, 1)], df.schema))
    assert TL.islands(nulls, "line", "t", ["flag", "severity"], max_gap_seconds=gap, bucket=bucket).count() == len(got)
    assert TL.islands(df.limit(0), "line", "t", ["flag"]).count() == 0


def test_islands_run_nothing_until_asked(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("islands-plan", "plan only")
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("t"), (F.col("id") % 3).alias("s"))
    plan = TL.islands(df, "k", "t", ["s"])._jdf.queryExecution().toString()
    assert not tracker.getJobIdsForGroup("islands-plan") and "ExistingRDD" not in plan
    spark.sparkContext.setJobGroup("", "")


def test_lines_per_hour_equal_a_plain_loop(spark):
    rows = {r[:2]: r for r in polls(3, lines=5, n=700)}
    runs = [r for r in islands_brute(list(rows.values())) if r[1]]
    base = dt.datetime(2024, 1, 1)
    runs += [("long", True, 6, base, base + dt.timedelta(days=40), base + dt.timedelta(days=40)), ("empty", True, 6, base, base, base),
             ("open", True, 6, base + dt.timedelta(hours=3), None, base + dt.timedelta(hours=5, minutes=1)),
             ("edge", True, 6, base + dt.timedelta(hours=1), base + dt.timedelta(hours=2), base + dt.timedelta(hours=2))]
    df = spark.createDataFrame(runs, "line string, flag boolean, severity int, started_at timestamp_ntz, ended_at timestamp_ntz, last_seen_at timestamp_ntz")
    want = {}
    for line, _, _, start, end, seen in runs:
        at, stop = start.replace(minute=0, second=0), end or seen
        while at == start.replace(minute=0, second=0) or at < stop:
            want.setdefault(at, set()).add(line)
            at += dt.timedelta(hours=1)
    got = TL.lines_per_hour(df, "line").collect()
    assert {r.event_hour: (r.disrupted_lines, r.disrupted_line_ids) for r in got} == {h: (len(s), ",".join(sorted(s))) for h, s in want.items()} and len(got) == len(want)
    counts = TL.line_counts_per_hour(df, "line").collect()
    assert {r.event_hour: r.disrupted_lines for r in counts} == {h: len(s) for h, s in want.items()} and len(counts) == len(want)
    assert TL.lines_per_hour(df.limit(0), "line").count() == 0 and TL.line_counts_per_hour(df.limit(0), "line").count() == 0


# ---- upsert into buckets

def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, at timestamp_ntz, x int")


def day(n, h=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=h)


def files(path):
    return {str(f.relative_to(path)) for f in path.rglob("*.parquet")}


def test_upsert_equals_full_dedup_and_touches_few_buckets(spark, tmp_path):
    rng = random.Random(7)
    path = tmp_path / "stg"
    first = [(f"k{rng.randrange(200)}", f"v{i}", day(0, rng.randrange(24)), i) for i in range(500)]
    later = [(f"k{rng.randrange(10)}", f"w{i}", day(rng.choice([-1, 1]), rng.randrange(24)), i) for i in range(60)] + [("new", "n", day(1), 1), (None, "null key", day(1), 1)]
    assert U.upsert_latest(spark, str(path), frame(spark, first[:0]), ["k"], ["at"], buckets=32) == {"buckets": 32, "rewritten": 0}
    done = U.upsert_latest(spark, str(path), frame(spark, first), ["k"], ["at"], buckets=32)
    assert done["rewritten"] > 25
    before = files(path)
    done = U.upsert_latest(spark, str(path), frame(spark, later), ["k"], ["at"], buckets=32)
    assert 0 < done["rewritten"] <= 12 and len(before & files(path)) >= 20  # untouched buckets keep their files
    want = S.dedup_latest(frame(spark, first + later), ["k"], ["at"])
    columns = want.columns
    assert sorted(map(str, U.read_buckets(spark, str(path)).select(columns).collect())) == sorted(map(str, want.collect()))
    for again in (later, first):  # repeated and late batches change nothing
        U.upsert_latest(spark, str(path), frame(spark, again), ["k"], ["at"], buckets=32)
        assert sorted(map(str, U.read_buckets(spark, str(path)).select(columns).collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError, match="another number"):
        U.upsert_latest(spark, str(path), frame(spark, later), ["k"], ["at"], buckets=16)


@pytest.mark.parametrize("breaks_at", ["first", "middle"])
def test_broken_upsert_is_finished_by_the_next(spark, tmp_path, monkeypatch, breaks_at):
    path = str(tmp_path / "stg")
    first, later = [(f"k{i}", "old", day(0), i) for i in range(40)], [(f"k{i}", "new", day(1), i) for i in range(20)]
    U.upsert_latest(spark, path, frame(spark, first), ["k"], ["at"], buckets=8)
    real, calls = U._children, []

    def broken(s, p):
        calls.append(p)
        out = real(s, p)
        if "_buckets=" in p and "pending" in p:
            raise RuntimeError("lost") if breaks_at == "first" else None
            for folder in out[:2]:  # some buckets are in place, one is gone already, then the driver dies
                fs, target = U._folder(s, f"{path}/_buckets=8/{folder.rsplit('/', 1)[1]}")
                fs.delete(target, True)
                if folder != out[1]:
                    fs.rename(U._folder(s, folder)[1], target)
            raise RuntimeError("lost")
        return out

    monkeypatch.setattr(U, "_children", broken)
    with pytest.raises((RuntimeError, TypeError)):
        U.upsert_latest(spark, path, frame(spark, later), ["k"], ["at"], buckets=8)
    monkeypatch.undo()
    U.upsert_latest(spark, path, frame(spark, later[:1]), ["k"], ["at"], buckets=8)
    assert {r.k: r.v for r in U.read_buckets(spark, path).collect()} == {f"k{i}": "new" if i < 20 else "old" for i in range(40)}


# ---- SCD2: late rows, any order of batches

def seen(spark, rows):
    return spark.createDataFrame(rows, "k string, s string, t timestamp_ntz")


def plain(df):
    return sorted((r.k, r.s, r.valid_from, str(r.valid_to), r.is_current) for r in df.collect())


def test_late_row_splits_the_version_that_holds_its_time(spark):
    history = H.scd2_history(seen(spark, [("u", "a", day(0)), ("u", "b", day(9)), ("w", "z", day(3))]), "k", ["s"], "t")
    got = plain(H.scd2_merge(history, seen(spark, [("u", "c", day(4))]), "k", ["s"], "t"))
    assert got == [("u", "a", day(0), str(day(4)), False), ("u", "b", day(9), "None", True), ("u", "c", day(4), str(day(9)), False), ("w", "z", day(3), "None", True)]


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 0, 1], [1, 2, 0]])
def test_scd_table_equals_full_build_in_any_order(spark, tmp_path, order):
    rng = random.Random(11)
    rows = list({r[::2]: r for r in ((f"u{rng.randrange(12)}", rng.choice("abc"), day(rng.randrange(30), rng.randrange(24))) for _ in range(260))}.values())
    rng.shuffle(rows)
    parts = [rows[:150], [r for r in rows[150:200] if r[0] in ("u1", "u2", "u3")], rows[200:]]
    full = H.scd2_history(seen(spark, [r for p in parts for r in p]), "k", ["s"], "t")
    path = str(tmp_path / "scd")
    start = seen(spark, parts[order[0]])
    H.write_scd2_table(H.scd2_history(start, "k", ["s"], "t"), path, start, "t", buckets=16)
    for i in order[1:]:
        for _ in range(2):
            done = H.merge_scd2_table(spark, path, seen(spark, parts[i]), "k", ["s"], "t", batch_id=f"b{i}")
            assert done["late_keys"] > 0 and (i != 1 or done["rewritten"] <= 3)
    assert plain(H.read_scd2_table(spark, path)) == plain(full)
    ids = lambda df: sorted(r.scd_id for r in df.collect())
    assert ids(H.read_scd2_table(spark, path)) == ids(full)


def test_scd_table_deletes_and_reopens(spark, tmp_path):
    path = str(tmp_path / "scd")
    start = seen(spark, [("u", "a", day(0)), ("v", "a", day(0)), ("w", "a", day(0))])
    H.write_scd2_table(H.scd2_history(start, "k", ["s"], "t"), path, start, "t", buckets=4)
    gone = lambda rows: spark.createDataFrame(rows, "k string, t timestamp_ntz")
    H.merge_scd2_table(spark, path, start.limit(0), "k", ["s"], "t", deletes=gone([("u", day(5)), ("u", day(6)), ("v", day(5))]))
    H.merge_scd2_table(spark, path, seen(spark, [("u", "a", day(8)), ("v", "b", day(2)), (None, "a", day(1)), ("w", "b", None)]), "k", ["s"], "t")
    got = sorted((r.k, r.s, r.valid_from, str(r.valid_to), r.is_current, r.is_deleted) for r in H.read_scd2_table(spark, path).collect())
    assert got == [("u", "a", day(0), str(day(5)), False, True), ("u", "a", day(8), "None", True, False), ("v", "a", day(0), str(day(2)), False, False),
                   ("v", "b", day(2), str(day(5)), False, True), ("w", "a", day(0), "None", True, False)]
    assert H.merge_scd2_table(spark, path, start.limit(0), "k", ["s"], "t")["rewritten"] == 0


# ---- reading each landed file once (A3), and the nightly job on top of it

def land(spark, path, rows, date):
    df = spark.createDataFrame(rows, "k string, v string, at timestamp_ntz, x int")
    df.withColumn("_ingestion_date", F.lit(date).cast("date")).write.mode("append").partitionBy("_ingestion_date").parquet(path)


def test_each_file_is_read_once(spark, tmp_path):
    raw, log = str(tmp_path / "raw"), str(tmp_path / "log")
    land(spark, raw, [("a", "1", day(0), 1)], "2024-01-01")
    land(spark, raw, [("b", "1", day(1), 1)], "2024-01-20")
    first = unread_files(spark, raw, log)
    assert sorted(r.k for r in first.rows.collect()) == ["a", "b"]
    assert unread_files(spark, raw, log).batch_id == first.batch_id  # not done: the same batch again
    first.done()
    assert unread_files(spark, raw, log).files == () and unread_files(spark, raw, log).rows.count() == 0
    land(spark, raw, [("c", "1", day(2), 1)], "2024-01-18")  # late, within the lookback
    land(spark, raw, [("d", "1", day(2), 1)], "2024-01-21")
    land(spark, raw, [("e", "1", day(2), 1)], "2024-01-02")  # before the mark
    second = unread_files(spark, raw, log)
    assert sorted((r.k, str(r._ingestion_date)) for r in second.rows.collect()) == [("c", "2024-01-18"), ("d", "2024-01-21")]
    assert "PartitionFilters: [isnotnull(_ingestion_date" in second.rows._jdf.queryExecution().executedPlan().toString()
    second.done()
    third = unread_files(spark, raw, log, days=None)
    assert [r.k for r in third.rows.collect()] == ["e"] and len({*first.files, *second.files, *third.files}) == len(first.files + second.files + third.files)
    third.done()
    assert unread_files(spark, raw, log, days=None).files == ()


def test_nightly_job_reads_new_files_and_equals_a_full_rebuild(spark, tmp_path):
    import json

    from metroframe.plans import city_pipeline as P

    def request(i, **more):
        return {"unique_key": str(i), "created_date": "2024-03-15T08:00:00.000", "closed_date": None, "agency": "HPD", "complaint_type": "Rodent",
                "incident_zip": "10301", "incident_address": f"{i} MAIN STREET", "status": "Open", **more}

    def ingest(base, requests, n):
        raw = P.raw_requests(spark.createDataFrame([(json.dumps(r),) for r in requests], "value string"))
        P.ingest_batch(raw, f"{base}/r", f"r{n}", f"2024-03-{15 + n} 10:00:00", "nyc_311")
        hours = json.dumps({"hourly": {"time": [f"2024-03-{14 + n}T{h:02d}:00" for h in range(24)], "precipitation": [float(n)] * 24, "weather_code": [61] * 24}})
        P.ingest_batch(P.weather_rows(spark.createDataFrame([("nyc", hours)], "city string, value string")), f"{base}/w", f"w{n}", f"2024-03-{15 + n} 00:05:00", "weather")
        air = [{"DateObserved": f"2024-03-{14 + n}", "HourObserved": h, "LocalTimeZone": "EDT", "ReportingArea": "NYC", "ParameterName": "PM2.5", "AQI": 40 + h} for h in range(3)]
        P.ingest_batch(P.raw_air(spark.createDataFrame([(json.dumps(a),) for a in air], "value string")), f"{base}/a", f"a{n}", f"2024-03-{15 + n} 00:10:00", "airnow")

    base = str(tmp_path / "raw")
    run = lambda out: P.run_sla_job(spark, f"{base}/r", f"{base}/w", f"{base}/a", str(tmp_path / out), "salt", buckets=16)
    ingest(base, [request(i) for i in range(30)] + [request(99, agency=None)], 1)
    paths = run("kept")
    before = files(tmp_path / "kept" / "latest_nyc_311")
    ingest(base, [request(3, status="Closed", closed_date="2024-03-15T12:00:00.000"), request(40), request(98, status=None)], 2)
    again = run("kept")
    assert again == paths and len(before & files(tmp_path / "kept" / "latest_nyc_311")) >= 8
    untouched = files(tmp_path / "kept" / "latest_nyc_311")
    run("kept")  # nothing new: nothing merged
    assert files(tmp_path / "kept" / "latest_nyc_311") == untouched
    full = run("rebuilt")
    for name in ("stg_nyc_311", "stg_weather", "stg_airnow", "mart_complaint_sla", "sla_by_borough"):
        a, b = spark.read.parquet(paths[name]), spark.read.parquet(full[name])
        assert sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(map(str, b.select(sorted(b.columns)).collect())), name
    reasons = lambda p: sorted(r.quarantine_reason for r in spark.read.parquet(p["quarantine_requests"]).collect())
    assert reasons(paths) == reasons(full) == ["missing agency", "missing status"]
    for salt in ("", None):
        with pytest.raises(ValueError, match="salt"):
            P.run_sla_job(spark, f"{base}/r", f"{base}/w", f"{base}/a", str(tmp_path / "x"), salt)


def test_ids_tell_records_apart(spark):
    from metroframe.sources import raw as R
    rows = [(1, 1, "a", day(0), 1.0, "{}"), (1, 1, "a", day(1), 1.0, "{}"), (1, 1, "a", day(0), 2.0, "{}"), (1, 1, "a", day(0), 1.0, "{1}"), (1, 1, "a", day(0), None, "{}")]
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, ts timestamp_ntz, value double, props string")
    df.write.parquet(path := U.cut_lineage(df, spark, "ids").inputFiles()[0].rsplit("/", 1)[0] + "-copy")
    ids = [r._ingestion_id for r in R.ingest_metadata(spark.read.parquet(path), "r", "2024-01-01 00:00:00").collect()]
    assert len(set(ids)) == len(rows)


# ---- JSON profiles: no line lost, days merge

def test_every_line_is_profiled_or_counted(spark):
    deep = '{"a":' * 20_000 + "1" + "}" * 20_000
    lines = ['{"a": 1}', deep, "{bad", "[1]", "5", None, "", '{"a": 1}', "{}"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = {r.outcome: r.n_lines for r in Q.json_line_counts(df, "line").collect()}
    assert got == {"profiled": 3, "too_deep": 1, "invalid": 2, "not_object": 2, "missing": 1} and sum(got.values()) == len(lines)
    assert [tuple(r) for r in Q.json_profile(df, "line").collect()] == [("a", "integer", 2, 0, "1")]
    assert Q.json_line_counts(df.limit(0), "line").count() == 0


@pytest.mark.parametrize("value, name", [
    ("1", "integer"), ("-1", "integer"), ("2.00", "float"), ("1e5", "float"), ("true", "boolean"), ("null", "null"), ('"x"', "string"), ('"[x"', "string"), ('""', "string"),
    ('"2024-01-02"', "timestamp_string"), ('"2024-01-0"', "string"), ('"null"', "string"), ("[]", "array[empty]"), ('["[a"]', "array[string]"), ("[[1.5]]", "array[array[float]]"),
    ("[[]]", "array[array[empty]]"), ('[{"a":1}]', "array[object]"), ('["2024-01-02T00"]', "array[timestamp_string]"), ("[null, 1]", "array[null]"), ('"a\\nb-cd-ef"', "string"),
    ('"a\\nbc-de-fg"', "timestamp_string")])
def test_type_names(spark, value, name):
    df = spark.createDataFrame([(f'{{"k": {value}}}',)], "line string")
    assert Q.json_profile(df, "line").first().types == name


def test_daily_profiles_merge_and_drift_reads_two(spark, tmp_path):
    path, days = str(tmp_path / "profiles"), {"2024-01-01": ['{"a": 1, "b": "x"}', '{"a": null}', "{bad"], "2024-01-02": ['{"a": 1.5, "c": [1]}'], "2024-01-03": ['{"a": 2}']}
    frames = {d: spark.createDataFrame([(x,) for x in lines], "line string") for d, lines in days.items()}
    for _ in range(2):  # a repeated day replaces its own profile
        for d, df in frames.items():
            Q.store_profile(df, "line", path, "requests", d)
    Q.store_profile(frames["2024-01-03"], "line", path, "other", "2024-01-01")
    whole = spark.createDataFrame([(x,) for lines in days.values() for x in lines], "line string")
    columns = ["path", "types", "n_present", "n_null", "sample"]
    merged = Q.stored_profile(spark, path, "requests", "2024-01-01", "2024-01-03").select(columns)
    assert sorted(merged.collect()) == sorted(Q.json_profile(whole, "line").select(columns).collect())
    drift = Q.stored_drift(spark, path, "requests", "2024-01-01", "2024-01-02")
    assert {(r.field_name, r.change_type) for r in drift.collect()} == {("a", "type_change"), ("b", "field_removed"), ("c", "new_field")}
    assert "PartitionFilters: [isnotnull(feed" in drift._jdf.queryExecution().executedPlan().toString()
    assert sum(r.n_lines for r in spark.read.parquet(f"{path}/lines").where("feed = 'requests'").collect()) == 5


# ---- poll stream: silent lines, late polls, corrections

def poll_files(spark, landing, batches):
    for rows in batches:
        spark.createDataFrame(rows, "line_id string, ts timestamp_ntz, disrupted boolean, severity int").coalesce(1).write.mode("append").parquet(str(landing))
    return PS.poll_stream(spark, str(landing), spark.read.parquet(str(landing)).schema, max_files_per_trigger=1, event_time="ts")


def minute(n):
    return dt.datetime(2024, 3, 1) + dt.timedelta(minutes=n)


def closed(df):
    return sorted((r.line_id, r[1], str(r.started_at), str(r.ended_at)) for r in df.collect() if r.ended_at is not None)


def test_a_silent_line_has_its_episode_closed(spark, tmp_path):
    batches = [[("a", minute(0), True, 6), ("b", minute(0), True, 9)], [("a", minute(1), True, 6), ("b", minute(1), True, 9), ("c", minute(1), True, 3)],
               [("b", minute(n), n % 7 != 0, 9) for n in range(2, 40)], [("b", minute(41), True, 9), ("c", minute(41), False, 10)]]
    stream = poll_files(spark, tmp_path / "in", batches)
    got = spark.read.parquet(PS.run_to_parquet(PS.stream_episodes(stream, max_gap_seconds=600, delay="1 minute"), "silent"))
    polls = spark.createDataFrame([r for b in batches for r in b], "line_id string, ts timestamp_ntz, disrupted boolean, severity int")
    want = TL.episodes(polls, "line_id", "ts", "disrupted", ["severity"], 600, as_of=F.lit(minute(40)).cast("timestamp_ntz"))
    assert closed(got.select("line_id", "severity_level", "started_at", "ended_at")) == closed(want.select("line_id", "severity", "started_at", "ended_at"))
    assert ("a", 6, str(minute(0)), str(minute(1))) in closed(got)


def test_late_polls_are_rows_and_corrections_equal_the_batch_build(spark, tmp_path):
    rng = random.Random(3)
    polls = sorted({(f"l{rng.randrange(9)}", minute(n)): (f"l{rng.randrange(9)}", minute(n), rng.random() < 0.5, rng.choice([6, 9])) for n in range(300)}.values(), key=lambda r: r[1])
    late = [p for p in polls[:200] if p[0] in ("l1", "l2")][3:12]
    on_time = [p for p in polls if p not in late]
    stream = poll_files(spark, tmp_path / "in", [on_time[:150], on_time[150:], late])
    events = spark.read.parquet(PS.run_to_parquet(PS.episode_events(stream), "events", partition_by=["kind"]))
    assert sorted((r.line_id, str(r.started_at)) for r in events.where("kind = 'late'").collect()) == sorted((p[0], str(p[1])) for p in late)
    frame_of = lambda rows: spark.createDataFrame(rows, "line_id string, ts timestamp_ntz, disrupted boolean, severity int")
    build = lambda rows: TL.episodes(frame_of(rows), "line_id", "ts", "disrupted", ["severity"])
    before = build(on_time)
    assert closed(events.where("kind = 'episode'").select("line_id", "severity_level", "started_at", "ended_at")) == closed(before.select("line_id", "severity", "started_at", "ended_at"))
    path = tmp_path / "episodes"
    X.write_episodes(before, str(path), "line_id", buckets=32)
    kept = files(path)
    for _ in range(2):
        done = X.correct_episodes(spark, str(path), frame_of(polls), events.where("kind = 'late'"), "line_id", "ts", "disrupted", ["severity"], buckets=32)
        assert 0 < done["rewritten"] <= 2 and len(kept & files(path)) >= len(kept) - 2
        columns = before.columns
        assert sorted(map(str, U.read_buckets(spark, str(path)).select(columns).collect())) == sorted(map(str, build(polls).select(columns).collect()))
    assert X.correct_episodes(spark, str(path), frame_of(polls), events.limit(0), "line_id", "ts", "disrupted", ["severity"], buckets=32)["rewritten"] == 0


# ---- replay of the quarantine

def test_replay_adds_what_the_corrected_contract_takes_once(spark, tmp_path):
    import json

    from metroframe.operators import contracts as K
    from metroframe.plans import city_pipeline as P

    def request(i, **more):
        return {"unique_key": str(i), "created_date": "2024-03-15T08:00:00.000", "agency": "HPD", "complaint_type": "Rodent", "status": "Open", **more}

    rows = [request(1), request(2, created_date=None, closed_date="2024-03-15T09:00:00.000"), request(3, created_date=None), request(4, unique_key=None)]
    path = str(tmp_path / "raw")
    P.ingest_batch(P.raw_requests(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")), path, "r1", "2024-03-16 10:00:00", "nyc_311")
    before = {r.unique_key: r._ingestion_id for r in spark.read.parquet(path).where("_route = 'quarantine'").collect()}
    assert set(before) == {"2", "3", None}

    def mended(held):  # a request that only tells when it was closed counts from then
        return K.validate_requests(held.withColumn("created_date", F.coalesce("created_date", "closed_date")))

    assert P.replay_quarantine(spark, path, mended) == {"quarantined": 3, "accepted": 1, "still_rejected": 2, "added": 1}
    for since in (None, "2024-03-16"):
        assert P.replay_quarantine(spark, path, mended, since)["added"] == 0
    assert P.replay_quarantine(spark, path, mended, "2024-03-17") == {"quarantined": 0, "accepted": 0, "still_rejected": 0, "added": 0}
    valid = {r.unique_key: r for r in spark.read.parquet(path).where("_route = 'valid'").collect()}
    assert set(valid) == {"1", "2"} and valid["2"]._ingestion_id == before["2"] and str(valid["2"]._ingestion_date) == "2024-03-16"
    assert valid["2"].is_valid and valid["2"].created_date == "2024-03-15T09:00:00.000"
    assert spark.read.parquet(path).where("_route = 'quarantine'").count() == 3


# ---- SLA summaries merged from days

def requests(seed: int, n: int = 6000, days: int = 20):
    """One borough holds most rows; some are open, some have no target."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        hours = None if rng.random() < 0.2 else round(rng.expovariate(0.05), 4)
        borough = rng.choice(["BRONX", "QUEENS", None]) if rng.random() < 0.3 else "BROOKLYN"
        rows.append((dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(days)), borough, hours, hours is None,
                     None if hours is None or rng.random() < 0.1 else hours <= 24))
    return rows + [(dt.date(2024, 1, 3), "OPEN ONLY", None, True, None)]


REQUESTS = "day date, borough string, hours_to_close double, is_open boolean, met_sla boolean"


def check_summary(days, rows):
    got = {r.borough: r for r in M.merge_sla_days(days, ["borough"]).collect()}
    assert set(got) == {r[1] for r in rows}
    for borough, r in got.items():
        mine = [x for x in rows if x[1] == borough]
        hours = sorted(x[2] for x in mine if x[2] is not None)
        met = [x[4] for x in mine if x[4] is not None]
        assert (r.n_requests, r.n_open, r.n_evaluated, r.n_met) == (len(mine), sum(x[3] for x in mine), len(met), sum(met))
        assert r.sla_compliance == (sum(met) / len(met) if met else None)
        if not hours:
            assert r.avg_hours_to_close is None and r.median_hours_to_close is None
            continue
        assert r.avg_hours_to_close == pytest.approx(sum(hours) / len(hours))
        error = M.sketch_rank_error() * len(hours) + 1
        below, up_to = sum(h < r.median_hours_to_close for h in hours), sum(h <= r.median_hours_to_close for h in hours)
        assert below <= len(hours) / 2 + error and up_to >= len(hours) / 2 - error


def test_summary_from_merged_days(spark, tmp_path):
    rows = requests(1)
    df = spark.createDataFrame(rows, REQUESTS)
    path = str(tmp_path / "days")
    check_summary(M.refresh_sla_days(df, path, "day", ["borough"]), rows)
    # two days change: their folders alone are rewritten
    changed = [dt.date(2024, 1, 3), dt.date(2024, 1, 5)]
    rows = [r for r in rows if r[0] not in changed] + [r for r in requests(2) if r[0] in changed]
    before = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
    check_summary(M.refresh_sla_days(spark.createDataFrame(rows, REQUESTS), path, "day", ["borough"], changed), rows)
    after = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
    kept = {f for f in before if f.parent.name not in {f"day={d}" for d in changed}}
    assert len(kept) == 18 and all(after[f] == before[f] for f in kept) and {f.parent.name for f in after if f not in kept} == {f"day={d}" for d in changed}
    # a day loses all its requests
    rows = [r for r in rows if r[0] != changed[0]]
    check_summary(M.refresh_sla_days(spark.createDataFrame(rows, REQUESTS), path, "day", ["borough"], changed), rows)
    assert M.sla_days(df.limit(0), "day", ["borough"]).count() == 0
    # a day alone, and no day
    check_summary(M.sla_days(df, "day", ["borough"]).filter(F.col("day") == changed[0]), [r for r in requests(1) if r[0] == changed[0]])
    assert M.merge_sla_days(M.sla_days(df.limit(0), "day", ["borough"]), ["borough"]).count() == 0
