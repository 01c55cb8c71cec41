"""End-to-end slice on fixture NDJSON: requests → contract → staging →
enrichment with weather and air quality → SLA mart → borough summary."""

import json
import os

import pytest
from pyspark.sql import functions as F

from metroframe.operators import timeline as TL
from metroframe.plans import city_pipeline as P
from metroframe.session import work_path

BASE = {"unique_key": "rq-41", "created_date": "2024-03-15T14:41:00.000", "closed_date": "2024-03-16T09:30:00.000",
        "agency": "DEP", "complaint_type": "Noise - Commercial", "descriptor": "Late music", "incident_zip": "10029",
        "incident_address": "12 OAK LANE", "borough": "manhattan", "latitude": "40.79", "longitude": "-73.94", "status": "Closed"}


SALT = "test salt"


def _requests(spark, tmp):
    early = dict(BASE, status="Open", closed_date=None)
    no_borough = dict(BASE, unique_key="2", borough=None, incident_zip="10451-1234", complaint_type="HEAT/HOT WATER",
                      created_date="2024-03-15T10:00:00.000", closed_date=None)
    broken = dict(BASE, unique_key=None)
    runs = [("2024-03-15 19:00:00", [early, no_borough, broken]), ("2024-03-16 10:00:00", [BASE])]
    for run_ts, recs in runs:
        d = tmp / run_ts[:10]
        d.mkdir(parents=True, exist_ok=True)
        (d / "run.ndjson").write_text("\n".join(json.dumps(r) for r in recs) + "\n")
    frames = []
    for run_ts, _ in runs:
        lines = P.load_raw_lines(spark, str(tmp / run_ts[:10]))
        frames.append(P.with_ingest_metadata(P.raw_requests(lines), "run-" + run_ts, run_ts))
    return frames[0].unionByName(frames[1])


def _weather(spark):
    hours = [f"2024-03-15T{h:02d}:00" for h in range(24)]
    payload = json.dumps({"hourly": {"time": hours, "temperature_2m": [10.0] * 24,
                                     "precipitation": [0.0] * 18 + [2.0] * 6, "weather_code": [61] * 24}})
    raw = P.weather_rows(spark.createDataFrame([("nyc", payload)], "city string, value string"))
    return P.stg_weather(P.with_ingest_metadata(raw, "w1", "2024-03-16 00:05:00"))


def _air(spark):
    recs = [{"DateObserved": "2024-03-15 ", "HourObserved": 14, "LocalTimeZone": "EDT",
             "ReportingArea": "New York City - Manhattan", "ParameterName": p, "AQI": a,
             "Category": {"Number": 1, "Name": n}} for p, a, n in [("PM2.5", 42, "Good"), ("OZONE", 61, "Moderate"),
                                                                   ("CO", 999, "Bad")]]
    lines = spark.createDataFrame([(json.dumps(r),) for r in recs], "value string")
    return P.stg_airnow(P.with_ingest_metadata(P.raw_air(lines), "a1", "2024-03-15 19:10:00"))


def test_sla_slice(spark, tmp_path):
    raw = _requests(spark, tmp_path)
    assert raw.filter(~F.col("is_valid")).count() == 1
    stg = P.stg_nyc_311(raw, SALT)
    rows = {r.source_unique_key: r for r in stg.collect()}
    assert set(rows) == {"rq-41", "2"}
    latest = rows["rq-41"]
    assert latest.status == "Closed"  # the later ingestion wins
    assert str(latest.created_at) == "2024-03-15 18:41:00"  # EDT -> UTC
    assert rows["2"].borough == "BRONX" and rows["2"].neighborhood == "Highbridge/South Bronx"  # ZIP+4 filled

    enriched = P.int_complaints_enriched(stg, _weather(spark), _air(spark))
    assert enriched.count() == stg.count()
    e = {r.complaint_id: r for r in enriched.collect()}
    r = e[latest.complaint_id]
    assert r.hours_to_close == pytest.approx(18.8167, abs=1e-4)
    assert r.weather_precipitation_mm == 2.0 and r.is_wet and r.weather_description == "Slight rain"
    assert r.air_quality_aqi == 61 and r.air_quality_category == "Moderate"

    mart = P.mart_complaint_sla(enriched)
    m = {x.complaint_id: x for x in mart.collect()}
    assert m[latest.complaint_id].sla_hours == 8 and m[latest.complaint_id].met_sla is False
    assert m[rows["2"].complaint_id].met_sla is None  # open
    summary = P.sla_by_borough(mart).collect()
    assert sum(s.n_requests for s in summary) == 2


def test_stg_crime_tags_pii_adjacent(spark):
    rec = {"cmplnt_num": "1", "cmplnt_fr_dt": "03/15/2024", "cmplnt_fr_tm": None, "law_cat_cd": "felony",
           "susp_race": "X"}
    lines = spark.createDataFrame([(json.dumps(rec),)], "value string")
    stg = P.stg_nyc_crime(P.with_ingest_metadata(P.raw_incidents(lines), "c1", "2024-03-16 06:00:00"))
    r = stg.collect()[0]
    assert str(r.occurred_at) == "2024-03-15 04:00:00"  # midnight local (D3) in UTC
    assert r.law_category == "FELONY"
    from metroframe.operators.staging import drop_pii
    assert "susp_race" not in drop_pii(stg).columns


def test_transit_episodes_with_gap(spark):
    polls = [("central", "Central", t, s, r) for t, s, r in [
        ("2024-03-15 23:50:00", 10, None), ("2024-03-15 23:55:00", 9, "Signal failure at Bank"),
        ("2024-03-16 00:00:00", 9, "Signal failure at Bank"), ("2024-03-16 00:20:00", 9, "Signal failure"),
        ("2024-03-16 00:25:00", 10, None), ("2024-03-16 00:30:00", 6, "Flooding")]]
    df = spark.createDataFrame(polls, "line_id string, line_name string, observed_at string, status_severity long, "
                                      "reason string").withColumn("observed_at", F.col("observed_at").cast("timestamp_ntz"))
    eps = P.disruption_episodes(P.stg_tfl_line_status(df), max_gap_seconds=300).orderBy("started_at").collect()
    assert [(str(e.started_at), str(e.ended_at)) for e in eps] == [
        ("2024-03-15 23:55:00", "2024-03-16 00:00:00"),  # gap of 20 min ends it at the last seen poll
        ("2024-03-16 00:20:00", "2024-03-16 00:25:00"),
        ("2024-03-16 00:30:00", "None")]
    assert eps[0].disruption_category == "signal_failure" and eps[2].disruption_category == "weather"
    assert eps[2].severity_level == 6


def test_work_path_is_under_checkpoint_dir(spark):
    assert work_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))


def test_ingest_batch_single_pass_accounting(spark, tmp_path):
    good = dict(BASE)
    bad = dict(BASE, unique_key=None)
    lines = spark.createDataFrame([(json.dumps(good),), (json.dumps(bad),), (json.dumps(good),)], "value string")
    log = P.ingest_batch(P.raw_requests(lines), str(tmp_path / "raw311"), "run-7", "2024-03-15 15:00:00", "nyc_311")
    assert (log["records_read"], log["records_written"], log["records_rejected"], log["status"]) == (3, 2, 1, "partial")
    q = spark.read.parquet(str(tmp_path / "raw311" / "_route=quarantine"))
    row = q.collect()[0]
    assert row.validation_errors == ["missing unique_key"] and json.loads(row.raw_json)["unique_key"] is None


def test_min_rows_expectation(spark):
    from metroframe.operators import quality as Q
    empty = spark.createDataFrame([], "a int")
    r = Q.expectations(empty, [Q.Check("enough", "min_rows", (), (1,))]).collect()[0]
    assert r.failed_rows == 1 and not r.success


def test_read_raw_json_layout(spark, tmp_path):
    from metroframe.sources import raw as R
    rec = dict(BASE, extra_field="kept in raw_json only")
    key = R.raw_key("nyc/311", "run-9", 2024, 3, 15)
    f = tmp_path / key
    f.parent.mkdir(parents=True)
    line = json.dumps(rec)
    f.write_text(line + "\n" + "not json\n")
    df = R.read_raw_json(spark, str(tmp_path / "nyc"), P.REQUEST_SCHEMA)
    rows = sorted(df.collect(), key=lambda r: r.raw_json)
    assert len(rows) == 2 and rows[0].raw_json == "not json" and rows[0].unique_key is None
    assert rows[1].raw_json == line and rows[1].unique_key == "rq-41"
    assert rows[1]._source_file.endswith("nyc/311/2024/03/15/run-9.ndjson")


def test_wmo_code_missing_from_seed_and_precip_flag(spark):
    hours = ["2024-03-15T14:00", "2024-03-15T15:00"]
    payload = json.dumps({"hourly": {"time": hours, "precipitation": [0.05, 0.2], "weather_code": [56, 61]}})
    raw = P.weather_rows(spark.createDataFrame([("nyc", payload)], "city string, value string"))
    rows = sorted(P.stg_weather(P.with_ingest_metadata(raw, "w", "2024-03-15 16:00:00")).collect(),
                  key=lambda r: r.observed_at)
    assert rows[0].weather_description is None and rows[0].is_precipitation is False  # 56 not in seed; 0.05 mm
    assert rows[1].weather_description == "Slight rain" and rows[1].is_precipitation is True


def test_severity_seed_wins_and_unknown_code(spark):
    polls = [("l1", "L1", "2024-03-15 10:00:00", 5, None), ("l1", "L1", "2024-03-15 10:05:00", 9, None),
             ("l1", "L1", "2024-03-15 10:10:00", 42, None), ("l1", "L1", "2024-03-15 10:10:10", 42, None)]
    df = spark.createDataFrame(polls, "line_id string, line_name string, observed_at string, status_severity long, "
                                      "reason string").withColumn("observed_at", F.col("observed_at").cast("timestamp_ntz"))
    rows = sorted(P.stg_tfl_line_status(df).collect(), key=lambda r: r.observed_at)
    assert [r.status_description for r in rows] == ["Part Closure", "Minor Delays", "Unknown"]  # 30 s window dedup
    assert [r.is_disrupted for r in rows] == [True, True, False]


def test_run_sla_job_from_raw_tables(spark, tmp_path):
    reqs = [dict(BASE), dict(BASE, unique_key="3", incident_zip="10301", borough=None, complaint_type="Rodent",
                             created_date="2024-03-15T08:00:00.000", closed_date="2024-03-15T12:00:00.000"),
            dict(BASE, unique_key=None)]
    lines = spark.createDataFrame([(json.dumps(r),) for r in reqs], "value string")
    raw311 = str(tmp_path / "raw" / "nyc_311")
    log = P.ingest_batch(P.raw_requests(lines), raw311, "r1", "2024-03-16 10:00:00", "nyc_311")
    assert log["records_rejected"] == 1
    hours = [f"2024-03-15T{h:02d}:00" for h in range(24)]
    payload = json.dumps({"hourly": {"time": hours, "precipitation": [1.0] * 24, "weather_code": [61] * 24}})
    w = P.weather_rows(spark.createDataFrame([("nyc", payload)], "city string, value string"))
    raw_w = str(tmp_path / "raw" / "weather")
    P.ingest_batch(w, raw_w, "w1", "2024-03-16 00:05:00", "weather")
    air = [{"DateObserved": "2024-03-15", "HourObserved": h, "LocalTimeZone": "EDT", "ReportingArea": "NYC",
            "ParameterName": "PM2.5", "AQI": 40 + h} for h in range(24)]
    raw_a = str(tmp_path / "raw" / "air")
    P.ingest_batch(P.raw_air(spark.createDataFrame([(json.dumps(a),) for a in air], "value string")), raw_a, "a1",
                   "2024-03-16 00:10:00", "airnow")
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        P.stg_nyc_311(spark.read.parquet(raw311), SALT).explain()
    assert "raw_json" not in buf.getvalue()  # pruned at the scan, never in the dedup shuffle
    paths = P.run_sla_job(spark, raw311, raw_w, raw_a, str(tmp_path / "warehouse"), SALT)
    mart = {r.complaint_type: r for r in spark.read.parquet(paths["mart_complaint_sla"]).collect()}
    assert mart["Rodent"].borough == "STATEN ISLAND" and mart["Rodent"].met_sla is True  # 4 h within 10 h
    assert mart["Rodent"].air_quality_aqi == 48  # 08:00 EDT = 12:00 UTC = local hour 8 of the EDT feed
    assert mart["Noise - Commercial"].met_sla is False
    summary = spark.read.parquet(paths["sla_by_borough"]).collect()
    assert sum(r.n_requests for r in summary) == 2 and all(r.is_wet for r in summary)


def test_cross_domain_hourly_domain_tables(spark):
    hours = [f"2024-03-15T{h:02d}:00" for h in range(12, 16)]
    payload = json.dumps({"hourly": {"time": hours, "temperature_2m": [5.0] * 4, "weather_code": [3] * 4}})
    w = P.weather_rows(spark.createDataFrame([("nyc", payload), ("london", payload)], "city string, value string"))
    stg_w = P.stg_weather(P.with_ingest_metadata(w, "w", "2024-03-16 00:05:00"))
    reqs = [dict(BASE, unique_key=str(i), created_date="2024-03-15T09:10:00.000") for i in range(3)]
    stg311 = P.stg_nyc_311(P.with_ingest_metadata(
        P.raw_requests(spark.createDataFrame([(json.dumps(r),) for r in reqs], "value string")), "r", "2024-03-16 00:00:00"), SALT)
    crime = {"cmplnt_num": "1", "cmplnt_fr_dt": "03/15/2024", "cmplnt_fr_tm": "10:30:00"}
    stg_crime = P.stg_nyc_crime(P.with_ingest_metadata(
        P.raw_incidents(spark.createDataFrame([(json.dumps(crime),)], "value string")), "c", "2024-03-16 00:00:00"))
    air = P.stg_airnow(P.with_ingest_metadata(P.raw_air(spark.createDataFrame(
        [(json.dumps({"DateObserved": "2024-03-15", "HourObserved": 9, "LocalTimeZone": "EDT", "ReportingArea": "NYC",
                      "ParameterName": "O3", "AQI": 77}),)], "value string")), "a", "2024-03-16 00:00:00"))
    status = spark.createDataFrame(
        [("central", "Central", "2024-03-15 13:50:00", 9, "signal"), ("central", "Central", "2024-03-15 14:20:00", 10, None)],
        "line_id string, line_name string, observed_at string, status_severity long, reason string"
    ).withColumn("observed_at", F.col("observed_at").cast("timestamp_ntz"))
    eps = P.disruption_episodes(P.stg_tfl_line_status(status), max_gap_seconds=None)
    out = {(r.city, r.event_hour.hour): r for r in
           P.int_cross_domain_hourly(stg311, stg_crime, stg_w, air, eps).collect()}
    assert len(out) == 8
    assert out[("nyc", 13)].nyc_311_complaints_count == 3 and out[("nyc", 13)].nyc_311_noise_complaints == 3
    assert out[("nyc", 14)].nyc_crime_incidents_count == 1 and out[("nyc", 12)].nyc_crime_incidents_count == 0
    assert out[("nyc", 13)].overall_aqi == 77 and out[("nyc", 13)].weather_description == "Overcast"
    assert out[("london", 13)].london_transit_disrupted_lines == "central"
    assert out[("london", 14)].london_transit_disruptions == 1 and out[("london", 15)].london_transit_disruptions == 0
    assert out[("london", 13)].nyc_311_complaints_count is None
    feats = P.mart_ml_features(P.int_cross_domain_hourly(stg311, stg_crime, stg_w, air, eps))
    cols = [c for c in feats.columns if not c.startswith("label_")]
    nulls = feats.select([F.count_if(F.col(c).isNull()).alias(c) for c in cols]).collect()[0].asDict()
    assert all(v == 0 for v in nulls.values()), nulls
    f = {(r.city, r.hour_of_day): r for r in feats.collect()}
    assert f[("nyc", 12)].aqi == 50.0  # nothing observed yet: the constant, never a later hour's value
    assert f[("london", 12)].aqi == 50.0  # no AQI at all for the city -> constant default
    assert f[("nyc", 13)].aqi == 77.0 and f[("nyc", 14)].aqi == 77.0  # last value within 6 h
    assert f[("london", 13)].london_lines_disrupted == 1 and f[("nyc", 13)].london_lines_disrupted == 0
    assert str(f[("nyc", 12)].feature_date) == "2024-03-15" and f[("nyc", 12)].is_raining is False


def test_transit_marts(spark):
    rows = [("central", "Central", t, s, r) for t, s, r in [
        ("2024-03-15 22:00:00", 10, None), ("2024-03-15 23:30:00", 9, "Heavy rain"),
        ("2024-03-16 00:30:00", 9, "Heavy rain"), ("2024-03-16 01:00:00", 10, None),
        ("2024-03-16 02:00:00", 4, "Planned engineering works"), ("2024-03-16 03:00:00", 10, None)]]
    status = P.stg_tfl_line_status(spark.createDataFrame(
        rows, "line_id string, line_name string, observed_at string, status_severity long, reason string"
    ).withColumn("observed_at", F.col("observed_at").cast("timestamp_ntz")))
    eps = P.disruption_episodes(status, max_gap_seconds=None)
    hours = ["2024-03-15T23:00", "2024-03-16T02:00"]
    payload = json.dumps({"hourly": {"time": hours, "precipitation": [0.0, 9.0]}})
    stg_w = P.stg_weather(P.with_ingest_metadata(P.weather_rows(
        spark.createDataFrame([("london", payload)], "city string, value string")), "w", "2024-03-17 00:00:00"))
    delays = {str(r.started_at): r for r in P.int_transit_delays(eps, stg_w).collect()}
    assert delays["2024-03-15 23:30:00"].is_weather_related  # reason text says rain
    assert not delays["2024-03-16 02:00:00"].is_weather_related  # planned wins over 9 mm of rain
    air = P.stg_airnow(P.with_ingest_metadata(P.raw_air(spark.createDataFrame(
        [(json.dumps({"DateObserved": "2024-03-16", "HourObserved": 1, "LocalTimeZone": "GMT",
                      "ReportingArea": "London Central", "ParameterName": "NO2", "AQI": 30}),)], "value string")),
        "a", "2024-03-17 00:00:00"))
    perf = {str(r.performance_date): r for r in
            P.mart_transit_performance(status, P.int_transit_delays(eps, stg_w), air).collect()}
    assert (perf["2024-03-15"].total_disruption_minutes, perf["2024-03-15"].observed_minutes) == (30, 120)
    assert (perf["2024-03-16"].total_disruption_minutes, perf["2024-03-16"].observed_minutes) == (120, 180)
    assert perf["2024-03-16"].total_disruption_events == 1 and perf["2024-03-16"].weather_related_disruptions == 0
    assert perf["2024-03-15"].weather_related_disruptions == 1
    assert perf["2024-03-16"].avg_aqi_on_disruption_days == 30.0 and perf["2024-03-15"].avg_aqi_on_disruption_days is None
    assert perf["2024-03-15"].line_name == "Central" and perf["2024-03-15"].most_common_disruption_reason == "Heavy rain"
    assert perf["2024-03-16"].most_common_disruption_reason == "Planned engineering works"
    scd = P.scd_tfl_line_status(status).orderBy("valid_from").collect()
    assert [r.status_severity for r in scd] == [10, 9, 10, 4, 10] and scd[-1].is_current


def test_air_quality_marts(spark):
    recs = [{"DateObserved": f"2024-03-{d:02d}", "HourObserved": h, "LocalTimeZone": "EST", "ReportingArea": area,
             "ParameterName": "PM2.5", "AQI": a} for d, h, area, a in [
        (1, 10, "New York City - Manhattan", 40), (1, 10, "NYC Queens", 120), (1, 12, "NYC Queens", 60),
        (2, 10, "NYC Queens", 180), (9, 10, "NYC Queens", 30)]]
    air = P.stg_airnow(P.with_ingest_metadata(P.raw_air(spark.createDataFrame(
        [(json.dumps(r),) for r in recs], "value string")), "a", "2024-03-10 00:00:00"))
    idx = {str(r.observed_at): r for r in P.int_air_quality_indexed(air).collect()}
    r = idx["2024-03-01 15:00:00"]
    assert (r.overall_aqi, r.daily_peak_aqi, r.health_advisory) == (120, 120, "Sensitive Groups")  # max over areas
    assert idx["2024-03-01 17:00:00"].aqi_24h_rolling_avg == 90.0
    payload = json.dumps({"hourly": {"time": ["2024-03-02T15:00", "2024-03-02T16:00"], "temperature_2m": [4.0, 6.0], "precipitation": [0.0, 3.0]}})
    stg_w = P.stg_weather(P.with_ingest_metadata(P.weather_rows(
        spark.createDataFrame([("nyc", payload)], "city string, value string")), "w", "2024-03-10 00:00:00"))
    trends = {str(t.observation_date): t for t in P.mart_air_quality_trends(air, stg_w).collect()}
    assert trends["2024-03-02"].days_unhealthy_last_30d == 2 and trends["2024-03-09"].days_unhealthy_last_30d == 2
    assert trends["2024-03-09"].aqi_7d_rolling_avg == 30.0  # 7-day range frame drops March 1–2
    assert trends["2024-03-02"].dominant_pollutant == "PM2.5" and trends["2024-03-09"].avg_temperature_c is None
    assert (trends["2024-03-02"].avg_temperature_c, trends["2024-03-02"].avg_precipitation_mm) == (5.0, 1.5)


def test_daily_summary_and_correlations(spark):
    hours = [f"2024-03-{d:02d}T{h:02d}:00" for d in (15, 16) for h in (10, 11, 12)]
    payload = json.dumps({"hourly": {"time": hours, "temperature_2m": [10.0, 12.0, 14.0, 1.0, 2.0, 3.0],
                                     "precipitation": [0.0, 30.0, 0.0, 0.0, 0.0, 1.0],
                                     "weather_code": [61, 61, 3, 3, 3, 0]}})
    w = P.weather_rows(spark.createDataFrame([("nyc", payload), ("london", payload)], "city string, value string"))
    stg_w = P.stg_weather(P.with_ingest_metadata(w, "w", "2024-03-17 00:05:00"))
    reqs = [dict(BASE, unique_key=str(i), created_date="2024-03-15T08:00:00.000") for i in range(4)]
    stg311 = P.stg_nyc_311(P.with_ingest_metadata(
        P.raw_requests(spark.createDataFrame([(json.dumps(r),) for r in reqs], "value string")), "r", "2024-03-17"), SALT)
    crimes = [{"cmplnt_num": str(i), "cmplnt_fr_dt": "03/15/2024", "cmplnt_fr_tm": "09:00:00",
               "law_cat_cd": "FELONY" if i else "VIOLATION"} for i in range(3)]
    stg_crime = P.stg_nyc_crime(P.with_ingest_metadata(
        P.raw_incidents(spark.createDataFrame([(json.dumps(c),) for c in crimes], "value string")), "c", "2024-03-17"))
    air = P.stg_airnow(P.with_ingest_metadata(P.raw_air(spark.createDataFrame(
        [(json.dumps({"DateObserved": "2024-03-15", "HourObserved": 7, "LocalTimeZone": "EDT", "ReportingArea": "NYC",
                      "ParameterName": "O3", "AQI": 130}),)], "value string")), "a", "2024-03-17"))
    status = spark.createDataFrame([("jub", "Jubilee", "2024-03-16 10:00:00", 6, "x"),
                                    ("jub", "Jubilee", "2024-03-16 11:00:00", 10, None)],
                                   "line_id string, line_name string, observed_at string, status_severity long, "
                                   "reason string").withColumn("observed_at", F.col("observed_at").cast("timestamp_ntz"))
    eps = P.disruption_episodes(P.stg_tfl_line_status(status), max_gap_seconds=None)
    daily = P.mart_city_daily_summary(stg311, stg_crime, stg_w, air, eps)
    d = {(r.city, str(r.summary_date)): r for r in daily.collect()}
    assert len(d) == 4
    nyc15 = d[("nyc", "2024-03-15")]
    assert nyc15.avg_temperature_c == 12.0 and nyc15.total_precipitation_mm == 30.0
    assert nyc15.dominant_weather == "Slight rain" and nyc15.max_aqi == 130
    assert nyc15.worst_aqi_category == "Unhealthy for Sensitive Groups"
    assert (nyc15.nyc_total_311_complaints, nyc15.nyc_total_crime_incidents, nyc15.nyc_felony_count) == (4, 3, 2)
    assert nyc15.nyc_open_311_complaints == 0 and nyc15.nyc_avg_resolution_hours == 25.5
    london16 = d[("london", "2024-03-16")]
    assert london16.london_transit_disruption_events == 1 and nyc15.london_transit_disruption_events is None
    assert (london16.london_avg_disruption_minutes, london16.london_lines_disrupted_count) == (60.0, 1)
    per_day, corr = P.mart_cross_domain_correlations(daily)
    p = {(r.city, str(r.correlation_date)): r for r in per_day.collect()}
    assert p[("nyc", "2024-03-15")].complaints_per_bad_air_day == 4.0 and p[("nyc", "2024-03-15")].avg_temperature_c == 12.0
    assert p[("nyc", "2024-03-15")].crime_on_extreme_weather_days == 3
    assert p[("nyc", "2024-03-16")].complaints_per_bad_air_day is None
    assert p[("london", "2024-03-16")].transit_disruptions_on_rain_days == 1  # 1 mm of rain
    assert {r.city for r in corr.collect()} == {"nyc", "london"}


def test_poll_stream_job_equals_batch(spark, tmp_path):
    def poll(line, t, statuses):
        return {"id": line, "name": line.title(), "polled_at": t,
                "lineStatuses": [{"statusSeverity": s, "statusSeverityDescription": "", "reason": r}
                                 for s, r in statuses]}
    files = [
        [poll("central", "2024-03-15T10:00:00", [(10, None)]), poll("jubilee", "2024-03-15T10:00:00", [(10, None)])],
        [poll("central", "2024-03-15T10:01:00", [(9, "signal"), (3, "signal")]),  # worst of two statuses: 3
         poll("jubilee", "2024-03-15T10:01:00", [])],
        [poll("central", "2024-03-15T10:02:00", [(3, "signal")]), poll("jubilee", "2024-03-15T10:02:00", [(6, "x")])],
        [poll("central", "2024-03-15T10:03:00", [(10, None)]), poll("jubilee", "2024-03-15T10:03:00", [(10, None)])],
    ]
    landing = tmp_path / "landing"
    landing.mkdir()
    for i, recs in enumerate(files):
        f = landing / f"poll-{i}.json"
        f.write_text("\n".join(json.dumps(r) for r in recs) + "\n")
        os.utime(f, (1_700_000_000 + 60 * i, 1_700_000_000 + 60 * i))  # files land one minute apart
    paths = P.run_poll_stream(spark, str(landing), str(tmp_path / "out"), max_files_per_trigger=1)
    raw = spark.read.parquet(paths["raw_line_status"])
    assert raw.count() == 9  # one row per status; a poll without statuses keeps one null row
    got = sorted((r.line_id, r.severity_level, str(r.started_at), str(r.ended_at))
                 for r in spark.read.parquet(paths["episodes"]).collect())
    batch_polls = P.collapse_statuses(P.line_status_rows(spark.read.schema(P.LINE_STATUS_SCHEMA).json(str(landing))))
    want = sorted((r.line_id, r.status_severity, str(r.started_at), str(r.ended_at)) for r in
                  TL.episodes(batch_polls, "line_id", "observed_at", "is_disrupted", extra_state=["status_severity"])
                  .filter(F.col("ended_at").isNotNull()).collect())
    assert got == want == [("central", 3, "2024-03-15 10:01:00", "2024-03-15 10:03:00"),
                           ("jubilee", 6, "2024-03-15 10:02:00", "2024-03-15 10:03:00")]


def test_pii_tag_blocks_marts(spark):
    from metroframe.operators import staging as S
    df = S.tag_pii(spark.createDataFrame([("x", 1)], "addr string, n int"), {"addr": "direct"})
    with pytest.raises(ValueError):
        S.assert_no_pii(df)
    assert S.drop_pii(df).columns == ["n"]
    assert S.assert_no_pii(df.groupBy().agg(F.count("addr").alias("c"))).columns == ["c"]  # derived: no tag


def test_pipeline_sla_breaches_by_cadence(spark):
    log = spark.createDataFrame([
        ("nyc_311", "2024-03-15 10:16:00", "2024-03-15 10:29:00"),   # slot 10:15, due 10:30: on time
        ("nyc_311", "2024-03-15 10:31:00", "2024-03-15 10:52:00"),   # slot 10:30, due 10:45: 7 min late
        ("nyc_crime", "2024-03-15 06:02:00", "2024-03-15 07:30:00"),  # slot 06:00, due 07:00: 30 min late
        ("weather", "2024-03-15 11:06:00", "2024-03-15 11:20:00"),   # slot 11:05, due 11:35: on time
    ], "pipeline_name string, started_at string, completed_at string").select(
        "pipeline_name", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("started_at", "completed_at")])
    out = sorted((r.pipeline_name, str(r.expected_completion), r.breach_minutes)
                 for r in P.pipeline_sla_breaches(log).collect())
    assert out == [("nyc_311", "2024-03-15 10:45:00", 7), ("nyc_crime", "2024-03-15 07:00:00", 30)]


def test_complaint_status_scd(spark):
    def run(recs, ts):
        lines = spark.createDataFrame([(json.dumps(r),) for r in recs], "value string")
        return P.request_observations(P.with_ingest_metadata(P.raw_requests(lines), "r", ts))
    open_ = dict(BASE, status="Open", closed_date=None)
    day1 = run([open_], "2024-03-15 15:00:00").unionByName(run([open_], "2024-03-15 15:15:00"))  # re-ingested copy
    day2 = run([BASE], "2024-03-16 10:00:00").unionByName(run([BASE], "2024-03-16 10:15:00"))
    full = P.scd_311_complaint_status(day1.unionByName(day2))
    rows = full.orderBy("valid_from").collect()
    assert [r.status for r in rows] == ["Open", "Closed"]  # copies do not open versions
    assert str(rows[0].valid_to) == "2024-03-16 10:00:00" and rows[1].is_current
    merged = P.scd_311_complaint_status(day2, history=P.scd_311_complaint_status(day1))
    assert sorted(merged.collect()) == sorted(full.collect())


def test_stg_arrivals_latest_poll_wins(spark):
    base = {"vehicleId": "201", "lineId": "central", "lineName": "Central", "stationName": "Bank",
            "naptanId": "940GZZLUBNK", "direction": "outbound", "destinationName": "Epping",
            "expectedArrival": "2024-03-15T10:05:00Z"}
    polls = [(dict(base, timeToStation=120), "2024-03-15 10:03:00"), (dict(base, timeToStation=60), "2024-03-15 10:04:00"),
             (dict(base, naptanId=None, timeToStation=5), "2024-03-15 10:04:00")]
    df = None
    for rec, t in polls:
        part = P.with_ingest_metadata(P.parse_lines(spark.createDataFrame([(json.dumps(rec),)], "value string"),
                                                    P.ARRIVAL_SCHEMA), "p", t)
        df = part if df is None else df.unionByName(part)
    rows = P.stg_tfl_arrivals(df).collect()
    assert len(rows) == 1 and rows[0].time_to_station_seconds == 60
    assert str(rows[0].expected_arrival_at) == "2024-03-15 10:05:00"


# --- the rules a reader of the marts relies on -------------------------------

def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@pytest.mark.parametrize("text,category", [
    ("GOOD SERVICE on the rest of the line", "unknown"), ("faulty train", "signal_failure"), ("Police investigation", "unknown"),
    ("Planned engineering works, no service", "planned"), ("Strike: no service", "staffing"), ("Heavy rain and flooding", "weather"),
    ("SIGNAL FAILURE at Bank", "signal_failure"), ("Ice on the rails", "weather"), ("shortage of train crew", "staffing"),
    ("a points failure caused by heat", "signal_failure"), ("industrial action", "staffing"), (None, "unknown"), ("", "unknown")])
def test_reason_classes(spark, text, category):
    from metroframe.operators import staging as S
    df = spark.createDataFrame([(text,)], "reason string")
    assert df.select(S.classify_reason("reason")).first()[0] == category


@pytest.mark.parametrize("text,masked", [
    ("ssn 123-45-6789.", "ssn [SSN]."), ("on 2024-03-15 14:00 run 1234567890", "on 2024-03-15 14:00 run 1234567890"),
    ("call (212) 555-0188 or +1 212-555-0188", "call [PHONE] or [PHONE]"), ("a.b+c@mail.example.org!", "[EMAIL]!"),
    ("at 12 Oak Lane today", "at [ADDRESS] today"), ("card 4556-7375-8689-9855-12", "card 4556-7375-8689-9855-12")])
def test_pii_masks(spark, text, masked):
    from metroframe.operators import staging as S
    assert spark.createDataFrame([(text,)], "t string").select(S.mask_text("t")).first()[0] == masked


def test_dates_are_the_city_s(spark):
    rec = dict(BASE, created_date="2024-03-15T22:30:00.000")
    stg = P.stg_nyc_311(P.with_ingest_metadata(P.raw_requests(spark.createDataFrame([(json.dumps(rec),)], "value string")), "r", "2024-03-16"), SALT)
    row = P.int_complaints_enriched(stg, _weather(spark), _air(spark)).first()
    assert str(row.created_at) == "2024-03-16 02:30:00" and str(row.complaint_date) == "2024-03-15"
    from metroframe.functions import columns as C
    df = _ntz(spark.createDataFrame([("london", "2024-06-30 23:30:00"), ("oslo", "2024-06-30 23:30:00"), ("nyc", None)], "city string, t string"), "t")
    assert [str(r[0]) for r in df.select(C.city_local_date("t", "city")).collect()] == ["2024-07-01", "2024-06-30", "None"]


def test_no_input_is_lost_by_the_spine(spark):
    """Requests before, incidents after the weather's hours are all counted."""
    payload = json.dumps({"hourly": {"time": ["2024-03-15T12:00", "2024-03-15T13:00"], "temperature_2m": [5.0, 5.0]}})
    stg_w = P.stg_weather(P.with_ingest_metadata(P.weather_rows(spark.createDataFrame([("nyc", payload)], "city string, value string")), "w", "2024-03-16"))
    reqs = [dict(BASE, unique_key=str(i), created_date=t) for i, t in enumerate(["2024-03-14T23:00:00.000", "2024-03-15T08:10:00.000", "2024-03-15T08:50:00.000"])]
    stg311 = P.stg_nyc_311(P.with_ingest_metadata(P.raw_requests(spark.createDataFrame([(json.dumps(r),) for r in reqs], "value string")), "r", "2024-03-16"), SALT)
    crime = {"cmplnt_num": "1", "cmplnt_fr_dt": "03/16/2024", "cmplnt_fr_tm": "23:30:00", "law_cat_cd": "FELONY"}
    stg_crime = P.stg_nyc_crime(P.with_ingest_metadata(P.raw_incidents(spark.createDataFrame([(json.dumps(crime),)], "value string")), "c", "2024-03-17"))
    eps = P.disruption_episodes(P.stg_tfl_line_status(_ntz(spark.createDataFrame(
        [("jub", "Jubilee", "2024-03-13 10:00:00", 6, "x"), ("jub", "Jubilee", "2024-03-13 10:04:00", 10, None)],
        "line_id string, line_name string, observed_at string, status_severity long, reason string"), "observed_at")))
    air = _air(spark)
    total = P.int_cross_domain_hourly(stg311, stg_crime, stg_w, air, eps).agg(
        F.sum("nyc_311_complaints_count"), F.sum("nyc_crime_incidents_count"), F.sum("london_transit_disruptions")).first()
    assert tuple(total) == (3, 1, 1)
    daily = P.mart_city_daily_summary(stg311, stg_crime, stg_w, air, eps).agg(
        F.sum("nyc_total_311_complaints"), F.sum("nyc_felony_count"), F.sum("london_transit_disruption_events")).first()
    assert tuple(daily) == (3, 1, 1)


def test_quarantine_and_staging_share_the_input(spark):
    recs = [dict(BASE), dict(BASE, unique_key="2", agency=None), dict(BASE, unique_key="3", status=" "), dict(BASE, unique_key=None)]
    raw = P.with_ingest_metadata(P.raw_requests(spark.createDataFrame([(json.dumps(r),) for r in recs], "value string")), "r", "2024-03-16")
    reasons = sorted(r.quarantine_reason for r in P.quarantine_requests(raw).collect())
    assert reasons == ["contract", "missing agency", "missing status"] and P.stg_nyc_311(raw, SALT).count() == 1
    base = {"DateObserved": "2024-03-15", "HourObserved": 3, "LocalTimeZone": "EST", "ReportingArea": "London", "ParameterName": "O3", "AQI": 5}
    airs = [base, dict(base, LocalTimeZone="XYZ"), dict(base, ReportingArea="Northeast New Jersey"), dict(base, DateObserved="soon")]
    raw = P.with_ingest_metadata(P.raw_air(spark.createDataFrame([(json.dumps(r),) for r in airs], "value string")), "a", "2024-03-16")
    assert sorted(r.quarantine_reason for r in P.quarantine_air(raw).collect()) == ["unknown reporting area", "unknown time zone", "unreadable time"]
    assert P.stg_airnow(raw).count() == 1


def test_worst_status_of_a_poll_wins(spark):
    polls = [("l", "L", "2024-03-15 10:00:00", 10, None), ("l", "L", "2024-03-15 10:00:00", 3, "x"), ("l", "L", None, 6, "y")]
    df = _ntz(spark.createDataFrame(polls, "line_id string, line_name string, observed_at string, status_severity long, reason string"), "observed_at")
    assert [r.status_severity for r in P.stg_tfl_line_status(df).collect()] == [3]
    assert P.quarantine_polls(df).count() == 1


def test_features_do_not_read_later_hours(spark):
    from metroframe.operators import marts as M
    rows = [("nyc", f"2024-03-15 {h:02d}:00:00", None if h < 10 else 100.0 + h, 1.0, 40, h) for h in range(20)]
    schema = "city string, event_hour string, temperature_c double, precipitation_mm double, overall_aqi int, requests_count int"

    def features(data):
        out = M.feature_table(_ntz(spark.createDataFrame(data, schema), "event_hour"), "city", "event_hour", "requests_count")
        keep = [c for c in out.columns if not c.startswith("label_")]
        return {r.hour_of_day: tuple(r) for r in out.select(keep).collect()}

    before = features(rows)
    after = features(rows[:12] + [(*r[:2], -1.0, 9.0, 400, 99) for r in rows[12:]])
    assert all(before[h] == after[h] for h in range(12)) and before[13] != after[13]


def test_stream_breaks_at_gaps_like_the_batch(spark, tmp_path):
    times = ["10:00:00", "10:01:00", "10:20:00", "10:21:00", None, "10:22:00"]
    severity = [10, 3, 3, 3, 1, 10]
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "p.json").write_text("\n".join(json.dumps(
        {"id": "c", "name": "C", "polled_at": t and f"2024-03-15T{t}", "lineStatuses": [{"statusSeverity": s}]}) for t, s in zip(times, severity)))
    paths = P.run_poll_stream(spark, str(landing), str(tmp_path / "out"))
    assert spark.read.parquet(paths["raw_line_status"]).count() == len(times)
    got = sorted((r.severity_level, str(r.started_at), str(r.ended_at)) for r in spark.read.parquet(paths["episodes"]).collect())
    rows = P.line_status_rows(spark.read.schema(P.LINE_STATUS_SCHEMA).json(str(landing)))
    batch = P.disruption_episodes(P.stg_tfl_line_status(rows)).where("ended_at is not null").collect()
    assert got == sorted((r.severity_level, str(r.started_at), str(r.ended_at)) for r in batch) and len(got) == 2


def test_failed_ingest_is_logged_and_raised(spark, tmp_path):
    broken = P.raw_requests(spark.createDataFrame([(json.dumps(BASE),)], "value string")).withColumn("x", F.raise_error(F.lit("broken source")))
    with pytest.raises(Exception, match="broken source"):
        P.ingest_batch(broken, str(tmp_path / "raw"), "r1", "2024-03-15 15:00:00", "nyc_311", run_log_path=str(tmp_path / "log"))
    good = P.raw_requests(spark.createDataFrame([(json.dumps(BASE),)], "value string"))
    P.ingest_batch(good, str(tmp_path / "raw"), "r2", "2024-03-15 15:00:00", "nyc_311", run_log_path=str(tmp_path / "log"))
    log = {r.run_id: r for r in spark.read.parquet(str(tmp_path / "log")).collect()}
    assert log["r1"].status == "failed" and "broken source" in log["r1"].error_message
    assert (log["r2"].status, log["r2"].records_written) == ("success", 1)


def test_json_is_walked_to_its_leaves(spark):
    from metroframe.operators import quality as Q
    deep = {"a": {"b": {"c": {"d": {"e": {"f": 1}}}}, "g": []}, "h": [{"x": 1}], "i": {}}
    lines = [json.dumps(deep), '{"a": 2.50, "h": null, "t": "2024-01-02T03:04:05"}', "no json", "[1]", None]
    got = {r.path: tuple(r)[1:] for r in Q.json_profile(spark.createDataFrame([(x,) for x in lines], "line string"), "line").collect()}
    assert got == {"a.b.c.d.e.f": ("integer", 1, 0, "1"), "a.g": ("array[empty]", 1, 0, "[]"), "h": ("array[object],null", 2, 1, '[{"x":1}]'),
                   "a": ("float", 1, 0, "2.50"), "t": ("timestamp_string", 1, 0, "2024-01-02T03:04:05")}


def test_append_counts_and_full_rebuild(spark, tmp_path):
    from metroframe.sources import raw as R
    df = spark.createDataFrame([("k", "1"), (None, "2")], "id string, extra string")
    assert R.append_rows(df, str(tmp_path / "t"), ["id", "late"], required=["id"]) == {"accepted": 1, "failed": 1}
    assert spark.read.parquet(str(tmp_path / "t")).columns == ["id", "late"]
    mart = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "n int, day string")
    for rows, rebuild, days in ((mart, True, 2), (mart.where("n = 1"), False, 2), (mart.where("n = 1"), True, 1)):
        R.write_mart(rows, str(tmp_path / "m"), "day", ["n"], rebuild=rebuild)
        assert spark.read.parquet(str(tmp_path / "m")).select("day").distinct().count() == days
