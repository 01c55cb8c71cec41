"""Safe conversions and the four source contracts, table-driven: each case
changes one record of our own and states what the contract must say. All
cases of a source go through one DataFrame."""

import json
import math

import pytest
from pyspark.sql import functions as F

from metroframe.functions import columns as C
from metroframe.plans import city_pipeline as P
from metroframe.sources import raw as R

DROP = object()

RECORDS = {
    "requests": {"unique_key": "rq-7", "created_date": "2023-07-02T08:15:30.000", "agency": "DSNY", "complaint_type": "Missed Collection",
                 "incident_zip": "11238-0442", "incident_address": "9 PROSPECT PLACE", "borough": "brooklyn", "latitude": "40.6771",
                 "longitude": "-73.9703", "status": "In Progress"},
    "incidents": {"cmplnt_num": "in-3", "cmplnt_fr_dt": "07/02/2023", "cmplnt_fr_tm": "23:05:00", "ofns_desc": "BURGLARY", "law_cat_cd": "FELONY",
                  "boro_nm": "QUEENS", "susp_race": "UNKNOWN", "vic_sex": "E"},
    "air": {"DateObserved": "2023-07-02", "HourObserved": 6, "LocalTimeZone": "EDT", "ReportingArea": "London", "ParameterName": "NO2", "AQI": 88,
            "Category": {"Number": 2, "Name": "Moderate"}},
}
PARSERS = {"requests": P.raw_requests, "incidents": P.raw_incidents, "air": P.raw_air}

# source, change to the record, expected values, messages (None: not looked at)
CASES = [
    ("requests", {}, {"is_valid": True, "has_location": True, "has_borough": True, "incident_address": "9 PROSPECT PLACE"}, []),
    ("requests", {"latitude": DROP}, {"is_valid": True, "has_location": False}, None),
    ("requests", {"longitude": "east"}, {"is_valid": True, "has_location": False}, None),
    ("requests", {"unique_key": "  "}, {"is_valid": False, "unique_key": None}, ["missing unique_key"]),
    ("requests", {"borough": None}, {"is_valid": True, "has_borough": False}, None),
    ("requests", {"borough": "Gotham"}, {"is_valid": True}, ["unknown borough: Gotham"]),
    ("requests", {"borough": "sTaTeN iSlAnD"}, {"is_valid": True}, []),
    ("requests", {"a_field_nobody_declared": [1, {"x": 2}]}, {"is_valid": True}, []),
    ("incidents", {}, {"is_valid": True, "cmplnt_fr_dt": "07/02/2023", "cmplnt_fr_tm": "23:05:00", "susp_race": "UNKNOWN", "vic_sex": "E"}, None),
    ("incidents", {"cmplnt_num": DROP}, {"is_valid": False}, None),
    ("air", {}, {"is_valid": True, "parameter_name": "NO2", "aqi": 88, "category_number": 2, "category_name": "Moderate"}, []),
    ("air", {"ParameterName": ""}, {"is_valid": False}, None),
    ("air", {"AQI": 612}, {"is_valid": True, "aqi": 612}, None),
    ("air", {"AQI": DROP, "aqi": 31}, {"aqi": 31}, None),
    ("air", {"AQI": None, "aqi": 31}, {"aqi": None}, None),
    ("air", {"Category": "flat text", "category_name": "Plain"}, {"category_name": "Plain"}, None),
    ("air", {"Category": DROP, "category_name": "Plain"}, {"category_name": None}, None),
]


@pytest.fixture(scope="module")
def outcomes(spark):
    """Case number -> row, one job per source."""
    rows = {}
    for source, parse in PARSERS.items():
        numbered = []
        for i, (of, change, _, _) in enumerate(CASES):
            if of == source:
                record = {k: v for k, v in (RECORDS[source] | change).items() if v is not DROP}
                numbered.append((i, json.dumps(record | {"agency_name": f"case {i}"})))
        df = parse(spark.createDataFrame([(text,) for _, text in numbered], "value string"))
        by_text = {json.loads(r.raw_json)["agency_name"]: r for r in df.collect()}
        rows |= {i: by_text[f"case {i}"] for i, _ in numbered}
    return rows


@pytest.mark.parametrize("number", range(len(CASES)), ids=lambda i: f"{CASES[i][0]}-{'-'.join(CASES[i][1]) or 'plain'}-{i}")
def test_contract(outcomes, number):
    _, _, expected, messages = CASES[number]
    row = outcomes[number]
    assert {k: row[k] for k in expected} == expected
    if messages is not None:
        assert row.validation_errors == messages


def test_out_of_range_aqi_is_reported(outcomes):
    number = next(i for i, c in enumerate(CASES) if c[1] == {"AQI": 612})
    assert [m for m in outcomes[number].validation_errors if m.startswith("aqi out of range")]


def test_raw_text_is_kept_as_it_came(spark):
    text = '{"unique_key":"k",  "borough" : "BRONX"}'
    row = P.raw_requests(spark.createDataFrame([(text,)], "value string")).first()
    assert row.raw_json == text
    named = P.with_ingest_metadata(P.raw_requests(spark.createDataFrame([(text,)], "value string")), "r9", "2023-07-02 09:00:00")
    assert {"_ingestion_id", "_ingestion_timestamp", "_ingestion_date"} < set(named.columns)


@pytest.mark.parametrize("convert,cases", [
    (C.safe_str, {None: None, "": None, "\t\n": None, "north": "north", " a b ": "a b"}),
    (C.safe_int, {"8.0": 8, "-7.9": -7, "2e2": 200, "x1": None, None: None, "nan": None, "-inf": None}),
    (C.safe_float, {"3.25": 3.25, "2_500": 2500.0, " -1e2 ": -100.0, "4f": None, "1.0D": None, "0x1p3": None, None: None, "": None}),
])
def test_safe_conversions(spark, convert, cases):
    df = spark.createDataFrame([(v,) for v in cases], "v string")
    assert [r[0] for r in df.select(convert("v")).collect()] == list(cases.values())


def test_nan_text_is_a_number(spark):
    assert math.isnan(spark.createDataFrame([("NaN",)], "v string").select(C.safe_float("v")).first()[0])


def test_weather_payloads(spark):
    """Columnar payloads: short arrays give nulls, long ones lose their tail,
    coordinates come from the city, an unknown city is rejected."""
    hourly = {"time": ["2023-07-02T05:00", "2023-07-02T06:00", "2023-07-02T07:00"], "temperature_2m": [21.5, None], "weather_code": [2, 61, 3, 95],
              "precipitation": [0.0, 1.4, None]}
    df = spark.createDataFrame([(c, json.dumps({"hourly": hourly})) for c in ("london", "nyc", "oslo")], "city string, value string")
    rows = {(r.city, r.observation_time): r for r in P.weather_rows(df).collect()}
    assert len(rows) == 9
    for i, hour in enumerate(hourly["time"]):
        r = rows["london", hour]
        assert (r.temperature_2m, r.weather_code, r.precipitation) == ([21.5, None, None][i], [2, 61, 3][i], [0.0, 1.4, None][i])
        assert r.is_valid and rows["nyc", hour].latitude == pytest.approx(40.7128) and not rows["oslo", hour].is_valid
        kept = json.loads(r.raw_json)
        assert kept["time"] == hour and kept["city"] == "london"


@pytest.mark.parametrize("source,date,key", [("nyc/311", (2023, 7, 2), "nyc/311/2023/07/02/run.ndjson"), ("tfl", (2031, 12, 30), "tfl/2031/12/30/run.ndjson")])
def test_raw_key(source, date, key):
    assert R.raw_key(source, "run", *date) == key


def test_ndjson_folders(spark, tmp_path):
    df = spark.createDataFrame([(n, f"2023-{m:02d}-09") for n, m in enumerate((7, 11, 7))], "n int, day string").withColumn("day", F.to_date("day"))
    out = R.write_ndjson(df, str(tmp_path / "zone"), "day")
    assert {p.relative_to(out).as_posix() for p in (tmp_path / "zone").rglob("day=*")} == {"year=2023/month=07/day=09", "year=2023/month=11/day=09"}
    assert sorted(r.n for r in spark.read.json(out).collect()) == [0, 1, 2]
    assert R.write_ndjson(df.where("n < 0"), str(tmp_path / "none"), "day") == "" and not list((tmp_path / "none").rglob("*.json"))


def test_raw_tables_have_their_columns(spark, tmp_path):
    (tmp_path / "2023").mkdir()
    (tmp_path / "2023" / "run.ndjson").write_text("\n".join(json.dumps(RECORDS[k]) for k in ("requests",)))
    lines = P.load_raw_lines(spark, str(tmp_path))
    table = P.raw_table(P.with_ingest_metadata(P.raw_requests(lines), "r1", "2023-07-02 09:00:00"), "nyc_311")
    assert table.columns == [*P.METADATA, *P.REQUEST_FIELDS, "raw_json"]
    assert table.first()._source_file.endswith("2023/run.ndjson") and table.first().unique_key == "rq-7"
    air = P.with_ingest_metadata(P.raw_air(spark.createDataFrame([(json.dumps(RECORDS["air"]),)], "value string")), "r2", "2023-07-02 09:00:00")
    row = P.raw_table(air, "airnow").first()
    assert row.reporting_area == "London" and row._source_file is None and row.category_number == 2
