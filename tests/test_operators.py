"""Operator edge cases from SURVEY §2.9 / FIXTURES A.8: ties, null key parts,
zone labels and DST, out-of-range AQI, episodes across midnight and still
open, missing hours, JSON type lattice, drift."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from metroframe.functions import columns as C
from metroframe.operators import marts as M
from metroframe.operators import quality as Q
from metroframe.operators import snapshots as H
from metroframe.operators import staging as S
from metroframe.operators import timeline as TL


def ts(s):
    return datetime.fromisoformat(s)


def test_dedup_ties_are_deterministic(spark):
    rows = [("k", ts("2024-03-15 10:00:00"), p) for p in ["a", "b", "c", "d"]] + [("j", ts("2024-03-15 09:00:00"), "x")]
    df = spark.createDataFrame(rows, "key string, t timestamp_ntz, payload string")
    first = S.dedup_latest(df, ["key"], ["t"]).orderBy("key").collect()
    again = S.dedup_latest(df.repartition(3).orderBy(F.rand(7)), ["key"], ["t"]).orderBy("key").collect()
    assert first == again and len(first) == 2


def test_dedup_hot_key_many_copies(spark):
    df = spark.range(0, 50000).select((F.col("id") % 3 == 0).cast("int").alias("key"), F.col("id").alias("v"))
    out = {r.key: r.v for r in S.dedup_latest(df, ["key"], ["v"]).collect()}
    assert out == {1: 49998, 0: 49999}


def test_surrogate_key_null_parts_do_not_collide(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    keys = [r[0] for r in df.select(C.surrogate_key("x", "y", "z")).collect()]
    assert keys[0] != keys[1]


def test_zone_labels(spark):
    df = spark.createDataFrame([(ts("2024-03-15 14:00:00"), lab) for lab in ["EST", "EDT", "BST", "gmt", "XYZ"]],
                               "t timestamp_ntz, lab string")
    out = [r[0] for r in df.select(C.local_to_utc("t", label=F.col("lab"))).collect()]
    assert out == [ts("2024-03-15 19:00:00"), ts("2024-03-15 18:00:00"), ts("2024-03-15 13:00:00"),
                   ts("2024-03-15 14:00:00"), None]


def test_dst_hours_new_york(spark):
    df = spark.createDataFrame([(ts("2024-03-10 02:30:00"),), (ts("2024-11-03 01:30:00"),),
                                (ts("2024-07-01 12:00:00"),), (ts("2024-01-15 12:00:00"),)], "t timestamp_ntz")
    out = [r[0] for r in df.select(C.local_to_utc("t", zone="America/New_York")).collect()]
    assert out[2] == ts("2024-07-01 16:00:00") and out[3] == ts("2024-01-15 17:00:00")
    assert out[0] is not None and out[1] is not None  # gap and overlap hours resolve, never null


def test_out_of_range_aqi_ignored(spark):
    df = spark.createDataFrame([("a", "PM2.5", 999), ("a", "O3", 40), ("a", "NO2", -1)], "area string, p string, aqi long")
    df = df.withColumn("aqi", S.valid_aqi("aqi")).filter(F.col("aqi").isNotNull())
    r = S.pivot_measures(df, ["area"], "p", "aqi", ["PM2.5", "O3"], names={"PM2.5": "pm25", "O3": "o3"},
                         overall="overall", argmax="dominant").collect()[0]
    assert (r.pm25, r.o3, r.overall, r.dominant) == (None, 40, 40, "O3")


def _polls(spark, rows):
    return spark.createDataFrame([(k, ts(t), d) for k, t, d in rows], "k string, t timestamp_ntz, d boolean")


def test_episode_across_midnight_and_open(spark):
    polls = _polls(spark, [("L", "2024-03-15 23:00:00", False), ("L", "2024-03-15 23:30:00", True),
                           ("L", "2024-03-16 00:30:00", True), ("L", "2024-03-16 01:00:00", False),
                           ("L", "2024-03-16 05:00:00", True)])
    eps = TL.episodes(polls, "k", "t", "d").orderBy("started_at").collect()
    assert [(e.started_at, e.ended_at, e.duration_minutes) for e in eps] == [
        (ts("2024-03-15 23:30:00"), ts("2024-03-16 01:00:00"), 90), (ts("2024-03-16 05:00:00"), None, None)]
    closed = TL.episodes(polls, "k", "t", "d").filter(F.col("ended_at").isNotNull())
    split = TL.split_by_day(closed, "started_at", "ended_at").orderBy("service_date").collect()
    assert [(str(r.service_date), r.minutes_in_day) for r in split] == [("2024-03-15", 30), ("2024-03-16", 60)]


def test_islands_bucket_border_equals_single_bucket(spark):
    rows = [("L", f"2024-03-{d:02d} {h:02d}:00:00", (d + h) % 3 == 0) for d in range(1, 6) for h in range(0, 24, 5)]
    polls = _polls(spark, rows)
    by_day = sorted(TL.islands(polls, "k", "t", ["d"], bucket="day").collect())
    by_year = sorted(TL.islands(polls, "k", "t", ["d"], bucket="year").collect())
    assert by_day == by_year


def test_rolling_range_skips_missing_hours(spark):
    df = spark.createDataFrame([("c", ts("2024-01-01 00:00:00"), 10.0), ("c", ts("2024-01-01 01:00:00"), 20.0),
                                ("c", ts("2024-01-02 02:00:00"), 30.0)], "city string, h timestamp_ntz, v double")
    out = [r[0] for r in df.orderBy("h").select(TL.rolling_mean_hours("city", "h", "v", 24)).collect()]
    assert out == [10.0, 15.0, 30.0]


def test_mode_tie_alphabetical(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("g", "a"), ("g", "c")], "g string, v string")
    assert M.mode_of(df, ["g"], "v", "mode").collect()[0]["mode"] == "a"


def test_sla_three_valued(spark):
    df = spark.createDataFrame([("Noise - Residential", 5.0, "x"), ("noise - residential ", 9.0, "x"),
                                ("Noise - Residential", None, None), ("Unknown", 1.0, "x")],
                               "complaint_type string, hours_to_close double, closed_at string")
    sla = spark.createDataFrame([("Noise - Residential", 8)], "complaint_type string, sla_hours long")
    assert [r.met_sla for r in M.apply_sla(df, sla, "complaint_type").collect()] == [True, False, None, None]


def test_scd_merge_equals_full_build(spark):
    rows = [("u1", "open", "2024-01-01 00:00:00"), ("u1", "open", "2024-01-02 00:00:00"),
            ("u1", "closed", "2024-01-03 00:00:00"), ("u2", "open", "2024-01-01 00:00:00"),
            ("u1", "closed", "2024-01-05 00:00:00"), ("u1", "open", "2024-01-06 00:00:00"),
            ("u2", "open", "2024-01-07 00:00:00"), ("u3", "new", "2024-01-08 00:00:00")]
    df = spark.createDataFrame([(k, s, ts(t)) for k, s, t in rows], "k string, s string, t timestamp_ntz")
    full = H.scd2_history(df, "k", ["s"], "t")
    cut = F.lit("2024-01-04").cast("timestamp_ntz")
    hist = H.scd2_history(df.filter(F.col("t") < cut), "k", ["s"], "t")
    merged = H.scd2_merge(hist, df.filter(F.col("t") >= cut), "k", ["s"], "t")
    assert sorted(merged.collect()) == sorted(full.collect())
    assert full.filter("is_current").count() == 3 and full.count() == 5


def test_json_profile_type_lattice(spark):
    recs = [{"a": 1, "b": 2.5, "c": "2024-03-15T10:00", "d": "x", "e": None, "f": [1, 2], "g": [], "h": True,
             "n": {"m": 1, "o": {}}}, {"a": None, "d": "y"}]
    lines = spark.createDataFrame([(json.dumps(r),) for r in recs], "line string")
    prof = {r.path: r for r in Q.json_profile(lines, "line").collect()}
    assert prof["a"].types == "integer,null" and prof["a"].n_null == 1 and prof["a"].n_present == 2
    assert prof["b"].types == "float" and prof["c"].types == "timestamp_string" and prof["d"].types == "string"
    assert prof["e"].types == "null" and prof["f"].types == "array[integer]" and prof["g"].types == "array[empty]"
    assert prof["h"].types == "boolean" and prof["n.m"].types == "integer" and "n.o" not in prof and "n" not in prof


def test_schema_drift(spark):
    old = spark.createDataFrame([("a", "integer"), ("b", "string"), ("c", "float,null")], "path string, types string")
    new = spark.createDataFrame([("a", "string"), ("c", "float"), ("d", "boolean")], "path string, types string")
    out = {r.field_name: (r.change_type, r.action_taken) for r in Q.schema_drift(old, new).collect()}
    assert out == {"a": ("type_change", "auto_cast"), "b": ("field_removed", "pipeline_paused"),
                   "d": ("new_field", "logged_only")}


def test_expectations_and_suite(spark):
    df = spark.createDataFrame([(1, "A"), (1, "B"), (None, "Z")], "k int, v string")
    checks = [Q.Check("k_nn", "not_null", ("k",)), Q.Check("k_u", "unique", ("k",)),
              Q.Check("v_in", "accepted_values", ("v",), ("A", "B"))]
    res = {r.check_name: r.failed_rows for r in Q.expectations(df, checks).collect()}
    assert res == {"k_nn": 1, "k_u": 1, "v_in": 1}
    suite = Q.suite_results(Q.expectations(df, checks), "s", "t").collect()[0]
    assert suite.success_pct == 0.0 and suite.failed_checks_detail == "k_nn,k_u,v_in"


def test_trailing_and_lead_on_dense_spine(spark):
    df = spark.createDataFrame([("c", i, float(i)) for i in range(30)], "city string, h int, n double")
    rows = df.select("h", TL.trailing_sum_rows("city", "h", "n", 24).alias("s"),
                     TL.lead_value("city", "h", "n", 6).alias("l")).orderBy("h").collect()
    assert rows[23].s == sum(range(24)) and rows[29].s == sum(range(6, 30))
    assert rows[0].l == 6.0 and rows[24].l is None


def test_exact_mean_order_independent(spark):
    vals = [0.1, 0.2, 0.3, 1.15, 2.25, 3.35]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    a = df.agg(S.exact_mean("v", 2)).collect()[0][0]
    b = df.repartition(4).agg(S.exact_mean("v", 2)).collect()[0][0]
    assert a == b == pytest.approx(sum(vals) / len(vals))


def test_dry_run_counts_without_writing(spark):
    from metroframe.operators import contracts as K
    df = spark.createDataFrame([("1",), (None,), ("3",)], "unique_key string")
    annotated = K.apply_contract(df, [K.missing("unique_key", hard=True)])
    assert K.dry_run(annotated) == {"records_read": 3, "records_valid": 2, "records_rejected": 1}


def test_mark_deleted_closes_open_version(spark):
    rows = [("u1", "open", "2024-01-01 00:00:00"), ("u1", "closed", "2024-01-03 00:00:00"),
            ("u2", "open", "2024-01-02 00:00:00")]
    df = spark.createDataFrame([(k, s, ts(t)) for k, s, t in rows], "k string, s string, t timestamp_ntz")
    hist = H.scd2_history(df, "k", ["s"], "t")
    gone = spark.createDataFrame([("u2", ts("2024-01-05 00:00:00"))], "k string, deleted_at timestamp_ntz")
    out = {(r.k, r.s): r for r in H.mark_deleted(hist, gone, "k", "deleted_at").collect()}
    assert out[("u2", "open")].is_deleted and out[("u2", "open")].valid_to == ts("2024-01-05 00:00:00")
    assert not out[("u2", "open")].is_current and out[("u1", "closed")].is_current
    assert not out[("u1", "open")].is_deleted


def test_range_frames_ignore_session_zone(spark):
    df = spark.createDataFrame([("c", ts("2024-03-09 12:00:00"), 10.0), ("c", ts("2024-03-10 11:00:00"), 20.0)],
                               "city string, h timestamp_ntz, v double")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # DST starts 2024-03-10
    try:
        out = [r[0] for r in df.orderBy("h").select(TL.rolling_mean_hours("city", "h", "v", 24)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert out == [10.0, 15.0]  # 23 wall-clock hours apart: inside the 24-hour frame


def test_scd_table_merge_rewrites_open_versions_only(spark, tmp_path):
    """Merging a batch twice (a broken attempt, then its repetition) gives the
    same table; deleted keys are closed and marked."""
    from metroframe.operators import snapshots as H
    path = str(tmp_path / "scd")

    def rows(data):
        df = spark.createDataFrame(data, "k string, s string, t string")
        return df.select("k", "s", F.col("t").cast("timestamp_ntz").alias("t"))

    old = rows([("a", "x", "2024-01-01 00:00:00"), ("b", "x", "2024-01-01 00:00:00"), ("a", "y", "2024-01-02 00:00:00"), ("c", "z", "2024-01-02 00:00:00")])
    new = rows([("a", "y", "2024-01-03 00:00:00"), ("b", "y", "2024-01-03 00:00:00"), ("d", "n", "2024-01-03 00:00:00")])
    gone = rows([("c", "", "2024-01-04 00:00:00"), ("c", "", "2024-01-05 00:00:00")]).drop("s")
    H.write_scd2_table(H.scd2_history(old, "k", ["s"], "t"), path)
    for _ in range(2):
        H.merge_scd2_table(spark, path, new, "k", ["s"], "t", deletes=gone)
        got = sorted((r.k, r.s, str(r.valid_from)[8:10], str(r.valid_to)[8:10], r.is_current, r.is_deleted) for r in H.read_scd2_table(spark, path).collect())
        assert got == [("a", "x", "01", "02", False, False), ("a", "y", "02", "", True, False), ("b", "x", "01", "03", False, False),
                       ("b", "y", "03", "", True, False), ("c", "z", "02", "04", False, True), ("d", "n", "03", "", True, False)]
