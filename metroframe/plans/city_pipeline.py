"""The city-domain pipeline: raw NDJSON → contracts → staging → intermediate
→ marts, for service requests, incidents, weather, air quality and transit.

Every function is a DataFrame → DataFrame builder over the generic
operators; the driver-table bindings call the same operators. Times: request
and incident text carries no offset and is New York local (D4); weather is
UTC; air quality is local hour + zone label. Everything downstream is UTC.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroframe.functions import columns as C
from metroframe.operators import contracts as K
from metroframe.operators import marts as M
from metroframe.operators import staging as S
from metroframe.operators import timeline as TL
from metroframe.operators import upsert as U
from metroframe.session import configure, cut_lineage
from metroframe.sources import raw as R
from metroframe.sources.progress import LOOKBACK_DAYS, Unread, unread_files
from metroframe.sources.seeds import seed
from metroframe.streaming import polls as P

NYC_ZONE = "America/New_York"
MAX_GAP_SECONDS = 300  # D20: a longer silence ends an episode at the last poll seen


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Raw field lists per source, in raw-table order.
REQUEST_FIELDS = ["unique_key", "created_date", "closed_date", "agency", "agency_name", "complaint_type",
                  "descriptor", "location_type", "incident_zip", "incident_address", "street_name", "borough",
                  "latitude", "longitude", "status", "resolution_description", "community_board",
                  "open_data_channel_type"]
INCIDENT_FIELDS = ["cmplnt_num", "cmplnt_fr_dt", "cmplnt_fr_tm", "cmplnt_to_dt", "cmplnt_to_tm", "rpt_dt",
                   "ofns_desc", "pd_desc", "law_cat_cd", "boro_nm", "addr_pct_cd", "latitude", "longitude",
                   "susp_age_group", "susp_race", "susp_sex", "vic_age_group", "vic_race", "vic_sex"]
WEATHER_VARIABLES = ["temperature_2m", "relative_humidity_2m", "precipitation", "precipitation_probability",
                     "wind_speed_10m", "weather_code"]
AIR_FIELDS = [("date_observed", "DateObserved"), ("hour_observed", "HourObserved"),
              ("local_time_zone", "LocalTimeZone"), ("reporting_area", "ReportingArea"),
              ("state_code", "StateCode"), ("latitude", "Latitude"), ("longitude", "Longitude"),
              ("parameter_name", "ParameterName"), ("aqi", "AQI")]

STG_311_INPUT = ["unique_key", "created_date", "closed_date", "agency", "complaint_type", "descriptor",
                 "incident_zip", "incident_address", "borough", "latitude", "longitude", "status",
                 "resolution_description", "community_board", "_ingestion_timestamp"]
STG_CRIME_INPUT = ["cmplnt_num", "cmplnt_fr_dt", "cmplnt_fr_tm", "rpt_dt", "ofns_desc", "law_cat_cd", "boro_nm",
                   "latitude", "longitude", "susp_age_group", "susp_race", "susp_sex", "vic_age_group", "vic_race",
                   "vic_sex", "_ingestion_timestamp"]
STG_WEATHER_INPUT = ["city", "observation_time", "latitude", "longitude", "temperature_2m", "relative_humidity_2m",
                     "precipitation", "precipitation_probability", "wind_speed_10m", "weather_code",
                     "_ingestion_timestamp"]

REQUEST_SCHEMA = _strings(REQUEST_FIELDS)
INCIDENT_SCHEMA = _strings(INCIDENT_FIELDS)
PII_ADJACENT = ["susp_age_group", "susp_race", "susp_sex", "vic_age_group", "vic_race", "vic_sex"]


# ---------------------------------------------------------------------------
# Raw layer: parse, clean text, validate
# ---------------------------------------------------------------------------

def parse_lines(lines: DataFrame, schema: T.StructType, line_col: str = "value") -> DataFrame:
    """NDJSON lines → one string column per declared field (safe_str
    applied), plus ``raw_json`` and the source file if the lines carry it.
    Unknown fields are accepted and ignored."""
    keep = [c for c in ("_source_file",) if c in lines.columns]
    parsed = R.parse_json_lines(lines, schema, line_col, carry=keep)
    return parsed.select(*[C.safe_str(f.name).alias(f.name) for f in schema.fields], "raw_json", *keep)


def raw_requests(lines: DataFrame) -> DataFrame:
    return K.validate_requests(parse_lines(lines, REQUEST_SCHEMA))


def raw_incidents(lines: DataFrame) -> DataFrame:
    return K.validate_incidents(parse_lines(lines, INCIDENT_SCHEMA))


def weather_rows(payloads: DataFrame, city_col: str = "city", payload_col: str = "value") -> DataFrame:
    """Columnar hourly payloads (``{"hourly": {"time": [...], var: [...]}}``)
    → one row per hour and city with the city's coordinates (A6, A7)."""
    hourly = T.StructType([T.StructField("time", T.ArrayType(T.StringType()))]
                          + [T.StructField(v, T.ArrayType(T.StringType())) for v in WEATHER_VARIABLES])
    doc = F.from_json(payload_col, T.StructType([T.StructField("hourly", hourly)]))
    arrays = payloads.select(F.col(city_col).alias("city"), doc["hourly"].alias("h"))
    arrays = arrays.select("city", *[F.col(f"h.{n}").alias(n) for n in ["time"] + WEATHER_VARIABLES])
    rows = R.unpack_arrays(arrays, ["city"], "time", {v: v for v in WEATHER_VARIABLES}, time_col="observation_time")
    coords = payloads.sparkSession.createDataFrame(
        [(c, lat, lon) for c, (lat, lon) in K.CITY_COORDS.items()], "city string, latitude double, longitude double")
    raw_json = F.to_json(F.struct(F.col("observation_time").alias("time"), *WEATHER_VARIABLES, "city"))
    typed = rows.select(
        C.safe_str("observation_time").alias("observation_time"), "city", raw_json.alias("raw_json"),
        *[C.safe_float(v).alias(v) for v in ["temperature_2m", "relative_humidity_2m", "precipitation",
                                              "wind_speed_10m"]],
        C.safe_int("precipitation_probability").alias("precipitation_probability"),
        C.safe_int("weather_code").alias("weather_code"))
    typed = typed.join(F.broadcast(coords), "city", "left")
    return K.validate_weather(typed)


def raw_air(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Air-quality records: Pascal-case keys win when present, snake-case
    otherwise (B4); category from the nested object else flat (B5)."""
    m = F.from_json(F.col(line_col), "map<string,string>")
    cols = [C.key_alias(m, pascal, snake).alias(snake) for snake, pascal in AIR_FIELDS]
    keep = [c for c in ("_source_file",) if c in lines.columns]
    base = lines.select(*cols, *keep, C.nested_category(m, "Category", "Number", "category_number").alias("_cat_n"),
                        C.nested_category(m, "Category", "Name", "category_name").alias("_cat_name"),
                        F.col(line_col).alias("raw_json"))
    typed = base.select(
        C.safe_str("date_observed").alias("date_observed"), C.safe_int("hour_observed").alias("hour_observed"),
        C.safe_str("local_time_zone").alias("local_time_zone"), C.safe_str("reporting_area").alias("reporting_area"),
        C.safe_str("state_code").alias("state_code"), C.safe_float("latitude").alias("latitude"),
        C.safe_float("longitude").alias("longitude"), C.safe_str("parameter_name").alias("parameter_name"),
        C.safe_int("aqi").alias("aqi"), C.safe_int("_cat_n").alias("category_number"),
        C.safe_str("_cat_name").alias("category_name"), "raw_json", *keep)
    return K.validate_air(typed)


def with_ingest_metadata(df: DataFrame, run_id: str, run_ts: str) -> DataFrame:
    payload = F.col("raw_json") if "raw_json" in df.columns else F.to_json(F.struct(*df.columns))
    if "_source_file" not in df.columns:
        df = df.withColumn("_source_file", F.lit(None).cast("string"))
    return df.withColumns({
        "_ingestion_id": F.sha2(F.concat_ws("|", F.lit(run_id), payload), 256),
        "_ingestion_timestamp": F.lit(run_ts).cast("timestamp_ntz"),
        "_ingestion_date": F.to_date(F.lit(run_ts)),
    })


METADATA = ["_ingestion_id", "_ingestion_timestamp", "_ingestion_date", "_source_file"]
# Columns of each source's raw table after the metadata; raw_json comes last.
RAW_TABLES = {
    "nyc_311": REQUEST_FIELDS,
    "nyc_crime": INCIDENT_FIELDS,
    "weather": ["observation_time", "city", "latitude", "longitude", "temperature_2m", "relative_humidity_2m",
                "precipitation", "precipitation_probability", "wind_speed_10m", "weather_code"],
    "airnow": [snake for snake, _ in AIR_FIELDS] + ["category_number", "category_name"],
}


def raw_table(df: DataFrame, source: str) -> DataFrame:
    """A source's validated rows in the shape of its raw table."""
    return R.raw_projection(df, [(c, F.col(c)) for c in [*METADATA, *RAW_TABLES[source], "raw_json"]])


# ---------------------------------------------------------------------------
# Staging
# ---------------------------------------------------------------------------

def nyc_local_to_utc(text_col) -> F.Column:
    local = C.parse_timestamp(text_col)
    return C.local_to_utc(local, zone=NYC_ZONE)


def quarantined(raw: DataFrame, reason: F.Column) -> DataFrame:
    """Rows that staging does not take, with the reason (C6): those that broke
    their contract, and valid ones for which ``reason`` is not null. Staging
    takes exactly the others, so input = staged copies + quarantine."""
    why = F.when(~F.col("is_valid"), F.lit("contract")).otherwise(reason)
    return raw.withColumn("quarantine_reason", why).where("quarantine_reason is not null")


def accepted(raw: DataFrame, reason: F.Column) -> DataFrame:
    return raw.where(F.col("is_valid") & reason.isNull())


def request_problem() -> F.Column:
    """Fields that staging needs and the contract only warns about."""
    needed = ["complaint_type", "agency", "status"]
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in needed])


def air_problem() -> F.Column:
    """No UTC hour without a known zone label and a readable local
    hour; no city for an area that no rule names."""
    return F.coalesce(
        F.when(C.zone_offset_hours("local_time_zone").isNull(), F.lit("unknown time zone")),
        F.when(_air_local_time().isNull(), F.lit("unreadable time")),
        F.when(S.area_to_city("reporting_area").isNull(), F.lit("unknown reporting area")))


def _air_local_time() -> F.Column:
    return F.try_to_timestamp(F.concat_ws(" ", C.safe_str("date_observed"),
                                          F.format_string("%02d:00:00", F.col("hour_observed"))))


def quarantine_requests(raw: DataFrame) -> DataFrame:
    return quarantined(raw, request_problem())


def quarantine_air(raw: DataFrame) -> DataFrame:
    return quarantined(raw, air_problem())


def stg_nyc_311(raw: DataFrame, salt: str) -> DataFrame:
    """Latest record per unique_key, typed, borough filled from the zip seed,
    address pseudonymised with the caller's salt (E1, B9, B11, E3, E14). Rows
    without a type, agency or status are in ``quarantine_requests``."""
    # Only the columns staging uses enter the dedup struct: raw_json and the
    # other wide raw columns are never shuffled.
    valid = accepted(raw, request_problem()).select(*STG_311_INPUT)
    return staged_requests(S.dedup_latest(valid, ["unique_key"], ["_ingestion_timestamp"]), salt)


def staged_requests(latest: DataFrame, salt: str) -> DataFrame:
    """The staging columns of the latest record of each request."""
    zips = seed(latest.sparkSession, "borough_zip_lookup")
    filled = S.fill_from_lookup(latest, zips, S.zip5(latest["incident_zip"]), "zip_code", "borough", "borough_name",
                                carry=["neighborhood"])
    return filled.select(
        C.surrogate_key("unique_key").alias("complaint_id"), F.col("unique_key").alias("source_unique_key"),
        nyc_local_to_utc("created_date").alias("created_at"), nyc_local_to_utc("closed_date").alias("closed_at"),
        F.col("agency").alias("agency_code"), "complaint_type", "descriptor", "incident_zip", "borough",
        "neighborhood", C.safe_float("latitude").alias("latitude"), C.safe_float("longitude").alias("longitude"),
        "status", "resolution_description", "community_board",
        S.pseudonymize("incident_address", salt).alias("address_token"), "_ingestion_timestamp")


def stg_nyc_crime(raw: DataFrame) -> DataFrame:
    valid = raw.filter(F.col("is_valid")).select(*STG_CRIME_INPUT)
    latest = S.dedup_latest(valid, ["cmplnt_num"], ["_ingestion_timestamp"])
    occurred_local = C.combine_date_time("cmplnt_fr_dt", "cmplnt_fr_tm")
    out = latest.select(
        C.surrogate_key("cmplnt_num").alias("incident_id"), "cmplnt_num",
        C.local_to_utc(occurred_local, zone=NYC_ZONE).alias("occurred_at"),
        C.parse_date("rpt_dt").alias("reported_date"), "ofns_desc", F.upper("law_cat_cd").alias("law_category"),
        F.upper("boro_nm").alias("borough"), C.safe_float("latitude").alias("latitude"),
        C.safe_float("longitude").alias("longitude"), *PII_ADJACENT, "_ingestion_timestamp")
    return S.tag_pii(out, {c: "adjacent" for c in PII_ADJACENT})


def stg_weather(raw: DataFrame) -> DataFrame:
    """One row per (city, UTC hour), latest ingestion wins; WMO lookup,
    precipitation flag (E6, E8)."""
    valid = raw.filter(F.col("is_valid")).select(*STG_WEATHER_INPUT)
    return staged_weather(S.dedup_latest(valid, ["city", "observation_time"], ["_ingestion_timestamp"]))


def staged_weather(latest: DataFrame) -> DataFrame:
    wmo = seed(latest.sparkSession, "wmo_weather_code_lookup")
    joined = S.lookup(latest, wmo, "weather_code", "wmo_code")
    return joined.select(
        C.surrogate_key("city", "observation_time").alias("weather_id"), "city",
        C.parse_timestamp("observation_time").alias("observed_at"), "latitude", "longitude",
        F.col("temperature_2m").alias("temperature_c"), F.col("relative_humidity_2m").alias("humidity_pct"),
        F.col("precipitation").alias("precipitation_mm"), "precipitation_probability",
        F.col("wind_speed_10m").alias("wind_speed_kmh"), "weather_code",
        F.col("description").alias("weather_description"), F.col("category").alias("weather_category"),
        S.precip_flag("precipitation").alias("is_precipitation"))


POLLUTANT_COLUMNS = {"PM2.5": "pm25_aqi", "PM10": "pm10_aqi", "OZONE": "ozone_aqi", "O3": "ozone_aqi",
                     "NO2": "no2_aqi"}


def stg_airnow(raw: DataFrame) -> DataFrame:
    """Per (reporting area, UTC hour): a column per pollutant, the overall
    maximum over all pollutants, the worst pollutant's category (E9–E12).
    Rows without a known zone, hour or city are in ``quarantine_air``."""
    return staged_air(S.dedup_latest(air_observations(raw), AIR_KEYS, ["_ingestion_timestamp"]))


AIR_KEYS = ["reporting_area", "observed_at", "param"]


def air_observations(raw: DataFrame) -> DataFrame:
    valid = accepted(raw, air_problem()).drop("validation_errors", "is_valid")
    return valid.select(
        "reporting_area", "latitude", "longitude", F.upper("parameter_name").alias("param"),
        S.valid_aqi("aqi").alias("aqi"), "category_name", "_ingestion_timestamp",
        C.local_to_utc(_air_local_time(), label=F.col("local_time_zone")).alias("observed_at"))


def staged_air(obs: DataFrame) -> DataFrame:
    pivot_values = sorted(set(POLLUTANT_COLUMNS))
    internal = {p: f"_p{i}" for i, p in enumerate(pivot_values)}
    per_param = S.pivot_measures(
        obs, ["reporting_area", "observed_at"], "param", "aqi", pivot_values,
        names=internal, overall="overall_aqi", argmax="dominant_pollutant",
        extra_aggs=[S.worst_category("category_name", "aqi", "param").alias("_worst"),
                    F.max_by("latitude", F.struct("_ingestion_timestamp", "param")).alias("latitude"),
                    F.max_by("longitude", F.struct("_ingestion_timestamp", "param")).alias("longitude")])
    by_col: dict[str, list[str]] = {}
    for p, col in POLLUTANT_COLUMNS.items():
        by_col.setdefault(col, []).append(internal[p])
    return per_param.select(
        C.surrogate_key("reporting_area", "observed_at").alias("observation_id"), "observed_at", "reporting_area",
        S.area_to_city("reporting_area").alias("city"), "latitude", "longitude",
        *[(F.greatest(*[F.col(c) for c in cs]) if len(cs) > 1 else F.col(cs[0])).alias(col)
          for col, cs in by_col.items()],
        "overall_aqi", F.coalesce("_worst", S.aqi_band(F.col("overall_aqi"))).alias("aqi_category"),
        "dominant_pollutant")


def air_city_hourly(stg_air: DataFrame) -> DataFrame:
    """Collapse reporting areas to (city, hour) before any join."""
    return (stg_air.groupBy("city", C.hour_trunc("observed_at").alias("event_hour"))
            .agg(F.max("overall_aqi").alias("overall_aqi"),
                 F.max_by("aqi_category", F.struct("overall_aqi", "aqi_category")).alias("aqi_category"),
                 F.max_by("dominant_pollutant", F.struct("overall_aqi", "dominant_pollutant"))
                 .alias("dominant_pollutant")))


def stg_tfl_line_status(raw: DataFrame, bucket: str = "30 seconds") -> DataFrame:
    """Poll rows (line_id, line_name, status_severity, reason, observed_at) →
    the worst status of each poll, deduplicated per (line, poll window),
    severity described (E2, E5). Rows without a poll time cannot be placed in
    time; ``quarantine_polls`` holds them."""
    worst = collapse_statuses(raw.where(F.col("observed_at").isNotNull())).drop("is_disrupted")
    deduped = S.dedup_window(worst, "line_id", "observed_at", bucket, bucket_col="_bucket").drop("_bucket")
    sev = seed(raw.sparkSession, "tfl_severity_lookup")
    j = S.lookup(deduped, sev, "status_severity", "severity_code")
    return j.select(
        C.surrogate_key("line_id", "observed_at").alias("status_event_id"), "line_id", "line_name", "observed_at",
        "status_severity", F.coalesce("severity_description", F.lit("Unknown")).alias("status_description"),
        F.coalesce("is_disrupted", F.lit(False)).alias("is_disrupted"), F.col("reason").alias("disruption_reason"))


def quarantine_polls(raw: DataFrame) -> DataFrame:
    """Poll rows that have no readable poll time."""
    return raw.where(F.col("observed_at").isNull()).withColumn("quarantine_reason", F.lit("missing poll time"))


# ---------------------------------------------------------------------------
# Intermediate and marts
# ---------------------------------------------------------------------------

def weather_city_hourly(stg_w: DataFrame) -> DataFrame:
    return stg_w.select("city", C.hour_trunc("observed_at").alias("event_hour"), "temperature_c",
                        "precipitation_mm", "wind_speed_kmh", "weather_description", "is_precipitation")


def int_complaints_enriched(stg_311: DataFrame, stg_w: DataFrame, stg_air: DataFrame) -> DataFrame:
    """Requests with weather and air quality of their creation hour.
    Both right sides are (city, hour)-unique, so the row count is kept."""
    req = stg_311.select(
        "complaint_id", "created_at", "closed_at", "complaint_type", "descriptor", "borough", "neighborhood",
        "incident_zip", "status", "latitude", "longitude",
        C.hour_trunc("created_at").alias("complaint_hour"),
        C.city_local_date("created_at", F.lit("nyc")).alias("complaint_date"),
        F.lit("nyc").alias("city"))
    req = req.select("*", *[c.alias(n) for n, c in M.resolution().items()])
    w = weather_city_hourly(stg_w).withColumnRenamed("event_hour", "complaint_hour").drop("wind_speed_kmh")
    a = air_city_hourly(stg_air).withColumnRenamed("event_hour", "complaint_hour")
    out = req.join(w, ["city", "complaint_hour"], "left").join(a, ["city", "complaint_hour"], "left")
    return out.select(
        *[c for c in req.columns if c != "city"],
        F.col("temperature_c").alias("weather_temperature_c"),
        F.col("precipitation_mm").alias("weather_precipitation_mm"), "weather_description",
        F.coalesce("is_precipitation", F.lit(False)).alias("is_wet"),
        F.col("overall_aqi").alias("air_quality_aqi"), F.col("aqi_category").alias("air_quality_category"))


def mart_complaint_sla(enriched: DataFrame, sla: DataFrame | None = None) -> DataFrame:
    sla = sla if sla is not None else seed(enriched.sparkSession, "complaint_type_sla")
    out = M.apply_sla(enriched, sla, "complaint_type")
    overdue = F.col("is_open") & F.col("sla_hours").isNotNull()
    return S.assert_no_pii(out.withColumn("is_overdue_when_open", overdue))


SLA_GROUPS = ["borough", "is_wet"]


def sla_by_borough(mart: DataFrame, split_wet: bool = True) -> DataFrame:
    """The README question: which boroughs miss SLAs, and does weather
    explain it? (G5)."""
    return M.sla_summary(mart, SLA_GROUPS if split_wet else ["borough"])


def disruption_episodes(stg_status: DataFrame, max_gap_seconds: int | None = MAX_GAP_SECONDS) -> DataFrame:
    """Disruption episodes per line (F3, D20), categorised."""
    eps = TL.episodes(stg_status, "line_id", "observed_at", "is_disrupted", extra_state=["status_severity"],
                      max_gap_seconds=max_gap_seconds, carry=["disruption_reason", "line_name"])
    return eps.withColumns({
        "disruption_event_id": C.surrogate_key("line_id", "started_at"),
        "disruption_category": S.classify_reason("disruption_reason"),
    }).withColumnRenamed("status_severity", "severity_level")


def load_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw NDJSON lines of a source folder (any depth) with their file."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.withColumn("_source_file", F.col("_metadata.file_path"))


RUN_LOG_SCHEMA = ("run_id string, pipeline_name string, started_at string, status string, error_message string, "
                  "records_read long, records_written long, records_rejected long")


def write_run_log(spark: SparkSession, log: dict, path: str) -> None:
    names = [f.split()[0] for f in RUN_LOG_SCHEMA.split(", ")]
    spark.createDataFrame([tuple(log.get(n) for n in names)], RUN_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def ingest_batch(annotated: DataFrame, out_path: str, run_id: str, run_ts: str, pipeline: str,
                 run_log_path: str | None = None) -> dict:
    """Batch ingest of one run (C6, C7): valid and quarantined rows are
    written in one pass, partitioned by route and ingestion date (the
    quarantine keeps raw_json and its errors); the run counts come from an
    Observation on that same pass, not from a second count job. Returns the
    run-log row, which is also appended to ``run_log_path`` if that is given. A
    failed run is logged as such and its error is raised."""
    obs = Observation(f"ingest-{run_id}")
    routed = with_ingest_metadata(annotated, run_id, run_ts).withColumn(
        "_route", F.when(F.col("is_valid"), F.lit("valid")).otherwise(F.lit("quarantine")))
    log = {"run_id": run_id, "pipeline_name": pipeline, "started_at": run_ts}
    try:
        (routed.observe(obs, F.count(F.lit(1)).alias("records_read"),
                        F.count_if(F.col("is_valid")).alias("records_written"),
                        F.count_if(~F.col("is_valid")).alias("records_rejected"))
         .write.mode("append").partitionBy("_route", "_ingestion_date").parquet(out_path))
        log.update(R.observed_counts(obs, ["records_read", "records_written", "records_rejected"]))
        log["status"] = "success" if log["records_rejected"] == 0 else "partial"
    except Exception as exc:
        log.update(K.failed_status(str(exc)))
        raise
    finally:
        if run_log_path:
            write_run_log(annotated.sparkSession, log, run_log_path)
    return log


def replay_quarantine(spark: SparkSession, raw_path: str, contract: Callable[[DataFrame], DataFrame],
                      since: str | None = None) -> dict[str, int]:
    """Quarantined rows of a raw table, from ingestion date ``since`` on, through
    a corrected ``contract`` (rows in, the same rows with ``is_valid`` and
    ``validation_errors`` out; it may mend columns too) (C6). Those that pass are
    appended to the valid route under their own ingestion ids and dates; the
    quarantine keeps its rows as they came. A row whose id is valid already is
    left alone, so replaying twice, or after a broken replay, adds nothing.
    Returns quarantined = accepted (by this or an earlier replay) + still_rejected,
    and how many rows were added."""
    table = spark.read.parquet(raw_path)
    if since is not None:
        table = table.where(F.col("_ingestion_date") >= F.lit(since).cast("date"))
    held = table.where("_route = 'quarantine'")
    judged = cut_lineage(contract(held.drop("validation_errors", "is_valid", "_route")), spark, "replay")
    known = table.where("_route = 'valid'").select("_ingestion_id")
    fresh = cut_lineage(judged.where("is_valid").join(known, "_ingestion_id", "left_anti"), spark, "replayed")
    counts = judged.agg(F.count(F.lit(1)).alias("quarantined"), F.count_if("is_valid").alias("accepted")).first()
    added = fresh.count()
    columns = [c for c in table.columns if c in fresh.columns]
    if added:
        fresh.select(columns).withColumn("_route", F.lit("valid")).write.mode("append").partitionBy("_route", "_ingestion_date").parquet(raw_path)
    return {"quarantined": counts.quarantined, "accepted": counts.accepted, "still_rejected": counts.quarantined - counts.accepted, "added": added}


def _persist(df: DataFrame, path: str) -> DataFrame:
    """Persist point: write the table and continue from the files, so every
    consumer reads it once instead of recomputing its lineage (and a lost
    executor costs a re-read, not a rebuild)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def run_sla_job(spark: SparkSession, raw_requests_path: str, raw_weather_path: str, raw_air_path: str,
                out_base: str, salt: str, lookback_days: int | None = LOOKBACK_DAYS, buckets: int = U.BUCKETS) -> dict[str, str]:
    """Nightly batch from raw tables (as written by ``ingest_batch``) to the
    SLA mart. Only raw files that no earlier run has read are read (A3): their
    rows are merged into the ``latest_*`` tables, of which the touched buckets
    are rewritten (E1), and rows that staging does not take go to the
    quarantine tables under the batch's name. Staging is persisted from there,
    enrichment stays lazy, the mart is written partitioned by complaint date
    and clustered by borough and type. ``sla_days`` keeps what each day adds to
    the borough summary, which is merged from there. The files count as read once all is
    written; repeating a broken run gives the same tables. ``salt`` is the
    secret of the address tokens. Returns the written table paths."""
    configure(spark)
    out = out_base.rstrip("/")
    paths = {name: f"{out}/{name}" for name in
             ["latest_nyc_311", "latest_weather", "latest_airnow", "stg_nyc_311", "stg_weather", "stg_airnow", "mart_complaint_sla",
              "sla_days", "sla_by_borough", "quarantine_requests", "quarantine_air"]}

    def merge(raw_path: str, name: str, rows, keys: list[str], quarantine=None, quarantine_name: str = "") -> Unread:
        new = unread_files(spark, raw_path, f"{out}/read_{name}", days=lookback_days)
        valid = new.rows.filter(F.col("_route") == "valid")
        if new.files or not U.exists(spark, paths[name]):
            U.upsert_latest(spark, paths[name], rows(valid), keys, ["_ingestion_timestamp"], buckets)
        if quarantine is not None and (new.files or not U.exists(spark, paths[quarantine_name])):
            (quarantine(valid).withColumn("_batch", F.lit(new.batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("_batch").parquet(paths[quarantine_name]))
        return new

    read = [
        merge(raw_requests_path, "latest_nyc_311", lambda raw: accepted(raw, request_problem()).select(*STG_311_INPUT), ["unique_key"],
              quarantine_requests, "quarantine_requests"),
        merge(raw_weather_path, "latest_weather", lambda raw: raw.filter(F.col("is_valid")).select(*STG_WEATHER_INPUT), ["city", "observation_time"]),
        merge(raw_air_path, "latest_airnow", air_observations, AIR_KEYS, quarantine_air, "quarantine_air")]
    stg_311 = _persist(staged_requests(U.read_buckets(spark, paths["latest_nyc_311"]), salt), paths["stg_nyc_311"])
    stg_w = _persist(staged_weather(U.read_buckets(spark, paths["latest_weather"])), paths["stg_weather"])
    stg_a = _persist(staged_air(U.read_buckets(spark, paths["latest_airnow"])), paths["stg_airnow"])
    mart = mart_complaint_sla(int_complaints_enriched(stg_311, stg_w, stg_a))
    R.write_mart(mart, paths["mart_complaint_sla"], "complaint_date", ["borough", "complaint_type"], rebuild=True)
    days = M.refresh_sla_days(spark.read.parquet(paths["mart_complaint_sla"]), paths["sla_days"], "complaint_date", SLA_GROUPS)
    summary = M.merge_sla_days(days, SLA_GROUPS)
    summary.write.mode("overwrite").parquet(paths["sla_by_borough"])
    for new in read:
        new.done()
    return paths


def _all_keys(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """The keys of all inputs: a spine between their bounds loses no row of
    any of them, whichever started first or ran longest."""
    out = None
    for part in parts:
        rows = part.select(*keys).where(F.col(keys[1]).isNotNull())
        out = rows if out is None else out.unionByName(rows)
    return out


def int_cross_domain_hourly(stg_311: DataFrame, stg_crime: DataFrame, stg_w: DataFrame, stg_air: DataFrame,
                            episodes: DataFrame) -> DataFrame:
    """City × hour table across all domains (F10–F13). Each input is reduced
    to (city, hour) first, then left-joined to a dense spine, so no join
    fans out; the spine spans the hours of all inputs. Request and incident
    counts exist for nyc only, transit disruptions for london only; the other
    city gets null (D15). Rows without a time (unreadable at the source) have
    no hour and are not counted."""
    keys = ["city", "event_hour"]
    req = (stg_311.groupBy(C.hour_trunc("created_at").alias("event_hour"))
           .agg(F.count(F.lit(1)).alias("requests"),
                F.count_if(F.startswith(F.col("complaint_type"), F.lit("Noise"))).alias("noise"))
           .withColumn("city", F.lit("nyc")))
    inc = (stg_crime.groupBy(C.hour_trunc("occurred_at").alias("event_hour"))
           .agg(F.count(F.lit(1)).alias("incidents")).withColumn("city", F.lit("nyc")))
    w = weather_city_hourly(stg_w).drop("is_precipitation")
    a = air_city_hourly(stg_air).select(*keys, "overall_aqi", "aqi_category")
    dl = (TL.lines_per_hour(episodes, "line_id")
          .withColumnsRenamed({"disrupted_lines": "lines", "disrupted_line_ids": "line_ids"})
          .withColumn("city", F.lit("london")))
    spine = TL.hour_spine(_all_keys([w, a, req, inc, dl], keys), "city", "event_hour")
    out = (spine.join(w, keys, "left").join(a, keys, "left").join(req, keys, "left").join(inc, keys, "left")
           .join(dl, keys, "left"))
    nyc, london = F.col("city") == "nyc", F.col("city") == "london"
    return out.select(
        C.surrogate_key("city", F.date_format("event_hour", "yyyy-MM-dd HH:mm:ss")).alias("cross_domain_id"),
        "event_hour", C.city_local_date("event_hour", "city").alias("event_date"), "city",
        F.col("temperature_c").alias("temperature_celsius"), "precipitation_mm", "wind_speed_kmh", "weather_description",
        "overall_aqi", "aqi_category",
        F.when(nyc, F.coalesce("requests", F.lit(0))).alias("nyc_311_complaints_count"),
        F.when(nyc, F.coalesce("noise", F.lit(0))).alias("nyc_311_noise_complaints"),
        F.when(nyc, F.coalesce("incidents", F.lit(0))).alias("nyc_crime_incidents_count"),
        F.when(london, F.coalesce("lines", F.lit(0))).alias("london_transit_disruptions"),
        F.when(london, F.col("line_ids")).alias("london_transit_disrupted_lines"))


RAIN_RELATED_MM = 5.0  # D10: precipitation in the start hour that makes a disruption weather-related


def int_transit_delays(episodes: DataFrame, stg_w: DataFrame, city: str = "london",
                       rain_mm: float = RAIN_RELATED_MM) -> DataFrame:
    """Episodes with the weather of their start hour (F5, D10): a 'planned'
    reason never counts as weather-related, a 'weather' reason always does,
    otherwise heavy rain in the start hour does."""
    w = weather_city_hourly(stg_w).filter(F.col("city") == city).drop("city")
    j = episodes.withColumn("_h", C.hour_trunc("started_at")).join(
        w.withColumnRenamed("event_hour", "_h"), "_h", "left").drop("_h")
    related = M.weather_related("disruption_category", "precipitation_mm", rain_mm)
    return j.withColumn("is_weather_related", related).withColumnsRenamed(
        {"temperature_c": "weather_temperature_c", "precipitation_mm": "weather_precipitation_mm"})


def mart_transit_performance(stg_status: DataFrame, delays: DataFrame, stg_air: DataFrame,
                             city: str = "london") -> DataFrame:
    """Line × day performance (G6) with the line's name, the day's most common
    disruption reason and the city's mean AQI on days that had a disruption.
    Days are UTC days, on which minutes add up to 1440 all year."""
    perf = M.line_day_performance(stg_status.select("line_id", "observed_at"), delays, "line_id", "observed_at")
    names = stg_status.groupBy("line_id").agg(F.max_by("line_name", "observed_at").alias("line_name"))
    reasons = M.mode_of(delays.where("disruption_reason is not null").withColumn("service_date", F.to_date("started_at")),
                        ["line_id", "service_date"], "disruption_reason", "most_common_disruption_reason")
    aqi = (air_city_hourly(stg_air).filter(F.col("city") == city)
           .groupBy(F.to_date("event_hour").alias("service_date")).agg(F.avg("overall_aqi").alias("_aqi")))
    out = (perf.join(aqi, "service_date", "left").join(names, "line_id", "left")
           .join(reasons, ["line_id", "service_date"], "left"))
    return S.assert_no_pii(S.drop_pii(out.select(
        C.surrogate_key("line_id", "service_date").alias("performance_id"), F.col("service_date").alias("performance_date"),
        "line_id", "line_name", F.col("disruption_events").alias("total_disruption_events"),
        F.col("disruption_minutes").alias("total_disruption_minutes"), "observed_minutes",
        F.col("pct_good_service").alias("pct_time_good_service"), "most_common_disruption_reason",
        F.col("weather_related_events").alias("weather_related_disruptions"),
        F.when(F.col("disruption_events") > 0, F.col("_aqi")).alias("avg_aqi_on_disruption_days"))))


def scd_tfl_line_status(stg_status: DataFrame) -> DataFrame:
    """Every status transition of every line (H1 on line status)."""
    from metroframe.operators.snapshots import scd2_history
    return scd2_history(stg_status, "line_id", ["status_severity", "status_description"], "observed_at")


FEATURE_FILLS = M.FEATURE_DEFAULTS | {"wind_speed_kmh": 0.0}


def mart_ml_features(cross_domain: DataFrame) -> DataFrame:
    """Feature and label table per city-hour (G11–G13) from
    int_cross_domain_hourly; request counts of a city without requests
    count as 0, like disrupted lines of a city without lines (D14). Hours and
    weekdays are UTC, feature_date is the city's date."""
    hourly = cross_domain.select(
        "city", "event_hour", F.col("temperature_celsius").alias("temperature_c"), "precipitation_mm", "wind_speed_kmh",
        "overall_aqi", F.coalesce("nyc_311_complaints_count", F.lit(0)).alias("requests_count"))
    features = M.feature_table(hourly, "city", "event_hour", "requests_count", fills=FEATURE_FILLS)
    lines = cross_domain.select("city", "event_hour", F.coalesce("london_transit_disruptions", F.lit(0)).alias("london_lines_disrupted"))
    out = features.join(lines, ["city", "event_hour"], "left")
    return S.assert_no_pii(S.drop_pii(out.select(
        "feature_id", F.col("event_hour").alias("feature_timestamp"), C.city_local_date("event_hour", "city").alias("feature_date"),
        "city", "hour_of_day", "day_of_week", "is_weekend", "month", "temperature_c", "precipitation_mm", "wind_speed_kmh",
        S.precip_flag("precipitation_mm").alias("is_raining"), F.col("overall_aqi").alias("aqi"),
        F.col("aqi_category_code").alias("aqi_category_encoded"), F.col("complaints_last_1h").alias("nyc_complaints_last_1h"),
        F.col("complaints_last_24h").alias("nyc_complaints_last_24h"), "london_lines_disrupted",
        "label_complaints_next_1h", "label_aqi_next_6h")))


def int_air_quality_indexed(stg_air: DataFrame) -> DataFrame:
    """Air quality per city and hour with rolling, peak, dominant pollutant
    and advisory (F14); reporting areas are collapsed to the city first."""
    return M.air_quality_indexed(air_city_hourly(stg_air))


def mart_air_quality_trends(stg_air: DataFrame, stg_w: DataFrame, unhealthy_above: int = 100) -> DataFrame:
    """Daily air-quality trends per city (G7, G8) with the pollutant of the
    day's worst hour and the day's weather. Days are the city's."""
    day = C.city_local_date("event_hour", "city").alias("observation_date")
    daily = (air_city_hourly(stg_air).groupBy("city", day)
             .agg(F.avg("overall_aqi").alias("avg_aqi"), F.max("overall_aqi").alias("max_aqi"),
                  F.max_by("dominant_pollutant", F.struct("overall_aqi", "dominant_pollutant")).alias("dominant_pollutant")))
    weather = (weather_city_hourly(stg_w).groupBy("city", day)
               .agg(F.avg("temperature_c").alias("avg_temperature_c"), F.avg("precipitation_mm").alias("avg_precipitation_mm")))
    trends = M.air_quality_trends(daily, "city", "observation_date", unhealthy_above=unhealthy_above)
    keys = ["city", "observation_date"]
    out = trends.join(daily.select(*keys, "dominant_pollutant"), keys).join(weather, keys, "left")
    return S.assert_no_pii(S.drop_pii(out.select(
        C.surrogate_key(*keys).alias("trend_id"), "observation_date", "city", "avg_aqi", "max_aqi", "dominant_pollutant",
        F.col("aqi_7d_avg").alias("aqi_7d_rolling_avg"), F.col("aqi_30d_avg").alias("aqi_30d_rolling_avg"),
        F.col("unhealthy_days_30d").alias("days_unhealthy_last_30d"), "avg_temperature_c", "avg_precipitation_mm")))


def mart_city_daily_summary(stg_311: DataFrame, stg_crime: DataFrame, stg_w: DataFrame, stg_air: DataFrame,
                            episodes: DataFrame) -> DataFrame:
    """City × day summary (G1–G3): each domain is aggregated to (city, day)
    on its own and joined on the day spine — never one wide join that is
    aggregated afterwards. dominant_weather is the day's most frequent
    description (ties alphabetical); worst_aqi_category is the category of
    the day's worst hour. Days are the city's, from the first to the last day
    of any input."""
    keys = ["city", "summary_date"]

    def day(ts: str, city=None) -> F.Column:
        return C.city_local_date(ts, city if city is not None else "city").alias("summary_date")

    w = stg_w.withColumn("summary_date", day("observed_at"))
    weather = w.groupBy(*keys).agg(
        F.avg("temperature_c").alias("avg_temperature_c"), F.max("temperature_c").alias("max_temperature_c"),
        F.min("temperature_c").alias("min_temperature_c"), F.sum("precipitation_mm").alias("total_precipitation_mm"),
        F.max("wind_speed_kmh").alias("max_wind_speed_kmh"))
    dominant = M.mode_of(w.filter(F.col("weather_description").isNotNull()), keys, "weather_description",
                         "dominant_weather")
    air = (air_city_hourly(stg_air).withColumn("summary_date", day("event_hour")).groupBy(*keys)
           .agg(F.avg("overall_aqi").alias("avg_aqi"), F.max("overall_aqi").alias("max_aqi"),
                F.max_by("aqi_category", F.struct("overall_aqi", "aqi_category")).alias("worst_aqi_category")))
    resolution = M.resolution()
    nyc_only, london_only = F.lit("nyc"), F.lit("london")
    req = (stg_311.groupBy(day("created_at", nyc_only))
           .agg(F.count(F.lit(1)).alias("nyc_total_311_complaints"),
                F.count_if(resolution["is_open"]).alias("nyc_open_311_complaints"),
                F.avg(resolution["hours_to_close"]).alias("nyc_avg_resolution_hours"))
           .withColumn("city", nyc_only))
    inc = (stg_crime.groupBy(day("occurred_at", nyc_only))
           .agg(F.count(F.lit(1)).alias("nyc_total_crime_incidents"),
                F.count_if(F.col("law_category") == "FELONY").alias("nyc_felony_count"))
           .withColumn("city", nyc_only))
    ended = F.coalesce("ended_at", "last_seen_at")  # an open episode runs to its line's last poll
    transit = (episodes.groupBy(day("started_at", london_only))
               .agg(F.count(F.lit(1)).alias("london_transit_disruption_events"),
                    F.avg(TL.minutes_floor("started_at", ended)).alias("london_avg_disruption_minutes"),
                    F.count_distinct("line_id").alias("london_lines_disrupted_count"))
               .withColumn("city", london_only))
    spine = TL.day_spine(_all_keys([weather, air, req, inc, transit], keys), "city", "summary_date", out="summary_date")
    out = spine
    for part in (weather, dominant, air, req, inc, transit):
        out = out.join(part, keys, "left")
    counts = {}
    for city, names in (("nyc", ["nyc_total_311_complaints", "nyc_open_311_complaints", "nyc_total_crime_incidents", "nyc_felony_count"]),
                        ("london", ["london_transit_disruption_events", "london_lines_disrupted_count"])):
        counts |= {c: F.when(F.col("city") == city, F.coalesce(c, F.lit(0))) for c in names}
    return S.assert_no_pii(S.drop_pii(out.withColumns(counts).withColumn("summary_id", C.surrogate_key(*keys))))


def mart_cross_domain_correlations(daily: DataFrame, bad_air_aqi: int = 100,
                                   extreme_rain_mm: float = 25.0) -> tuple[DataFrame, DataFrame]:
    """Conditional daily metrics (G9, D11: the day's value when the
    condition holds, else null) and per-city correlations over them (G10)."""
    bad_air = F.col("max_aqi") > bad_air_aqi
    extreme = F.coalesce(F.col("total_precipitation_mm") > extreme_rain_mm, F.lit(False))
    rain = S.precip_flag("total_precipitation_mm")
    per_day = daily.select(
        C.surrogate_key("city", "summary_date").alias("correlation_id"), F.col("summary_date").alias("correlation_date"), "city",
        "avg_aqi", "total_precipitation_mm", "avg_temperature_c", F.col("nyc_total_311_complaints").alias("nyc_311_complaints"),
        F.col("nyc_total_crime_incidents").alias("nyc_crime_incidents"),
        F.col("london_transit_disruption_events").alias("london_transit_disruptions"),
        M.conditional("nyc_total_311_complaints", bad_air).cast("double").alias("complaints_per_bad_air_day"),
        M.conditional("nyc_total_crime_incidents", extreme).alias("crime_on_extreme_weather_days"),
        M.conditional("london_transit_disruption_events", rain).alias("transit_disruptions_on_rain_days"))
    corr = M.correlations(daily, ["city"], {
        "corr_aqi_vs_disruptions": ("max_aqi", "london_transit_disruption_events"),
        "corr_precipitation_vs_complaints": ("total_precipitation_mm", "nyc_total_311_complaints")})
    return per_day, corr


# ---------------------------------------------------------------------------
# Transit poll feed
# ---------------------------------------------------------------------------

LINE_STATUS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("polled_at", T.StringType()),
    T.StructField("lineStatuses", T.ArrayType(T.StructType([
        T.StructField("statusSeverity", T.LongType()), T.StructField("statusSeverityDescription", T.StringType()),
        T.StructField("reason", T.StringType())]))),
])


def line_status_rows(polls: DataFrame) -> DataFrame:
    """Poll records → one row per line status (A9); works on a batch or a
    stream. A poll without statuses keeps one row with null fields."""
    rows = R.explode_nested(polls.select("id", "name", "polled_at", "lineStatuses"), "lineStatuses",
                            ["id", "name", "polled_at"])
    return rows.select(F.col("id").alias("line_id"), F.col("name").alias("line_name"),
                       C.parse_timestamp("polled_at").alias("observed_at"),
                       F.col("statusSeverity").alias("status_severity"), "reason")


def _with_disruption(rows: DataFrame) -> DataFrame:
    sev = seed(rows.sparkSession, "tfl_severity_lookup").select("severity_code", "is_disrupted")
    j = rows.join(sev, rows["status_severity"] == sev["severity_code"], "left")
    return j.withColumn("is_disrupted", F.coalesce("is_disrupted", F.lit(False))).drop("severity_code")


def collapse_statuses(rows: DataFrame) -> DataFrame:
    """One state per (line, poll time): the worst status — disrupted first,
    then the lowest severity code (batch twin of the stream processor)."""
    flagged = _with_disruption(rows)
    worst = F.min_by(F.struct("status_severity", "is_disrupted", "reason", "line_name"),
                     F.struct((~F.col("is_disrupted")).alias("_ok"), F.col("status_severity")))
    return (flagged.groupBy("line_id", "observed_at").agg(worst.alias("_w"))
            .select("line_id", "observed_at", "_w.*"))


def run_poll_stream(spark: SparkSession, landing: str, out_base: str, max_files_per_trigger: int = 100,
                    max_gap_seconds: int | None = MAX_GAP_SECONDS) -> dict[str, str]:
    """Streaming job over landed poll files (A8): one row per line status
    goes to the raw sink (everything, late rows included, I4); the same
    rows, flagged by the severity seed (a stream-static broadcast join),
    feed the per-line stateful episode detector (I2). Both sinks checkpoint
    next to their output, so a restart resumes exactly. A trigger takes a
    bounded number of files, so a backlog goes through in steps."""
    out = out_base.rstrip("/")
    src = P.poll_stream(spark, landing, LINE_STATUS_SCHEMA, fmt="json", max_files_per_trigger=max_files_per_trigger)
    rows = line_status_rows(src)
    raw_path = P.run_to_parquet(rows, "line-status-raw", path=f"{out}/raw_line_status")
    polls = _with_disruption(rows).select("line_id", F.col("observed_at").cast("timestamp").alias("ts"),
                                          F.col("is_disrupted").alias("disrupted"),
                                          F.col("status_severity").alias("severity"))
    events = P.run_to_parquet(P.episode_events(polls, key="line_id", max_gap_seconds=max_gap_seconds), "episodes",
                              path=f"{out}/episode_events", partition_by=["kind"])
    paths = {"episodes": f"{events}/kind=episode", "late_polls": f"{events}/kind=late"}
    for path in paths.values():  # a feed without late polls has an empty table of them
        if not U.exists(spark, path):
            spark.createDataFrame([], P.event_schema(polls.schema["line_id"].dataType)).drop("kind").write.parquet(path)
    return {"raw_line_status": raw_path, **paths}


# ---------------------------------------------------------------------------
# Run health
# ---------------------------------------------------------------------------

# Schedule slot and offset of each ingest pipeline, in minutes
# (every 15 min; daily at 06:00; hourly at :05; hourly at :10), and the time
# a run may take before it counts as late.
PIPELINE_CADENCE = [
    ("nyc_311", 15, 0, 15),
    ("nyc_crime", 1440, 360, 60),
    ("weather", 60, 5, 30),
    ("airnow", 60, 10, 30),
]


def pipeline_sla_breaches(run_log: DataFrame) -> DataFrame:
    """Late runs (J3): each run's schedule slot comes from its pipeline's
    cadence (a fixed table, broadcast); expected completion = slot start +
    allowed minutes; a run finishing later is a breach. ``run_log`` has
    pipeline_name, started_at, completed_at."""
    from metroframe.operators import quality as Q
    cad = run_log.sparkSession.createDataFrame(
        PIPELINE_CADENCE, "pipeline_name string, slot_min int, offset_min int, allowed_min int")
    j = run_log.join(F.broadcast(cad), "pipeline_name", "inner")
    minutes = TL.epoch_seconds("started_at") / 60
    slot_start_min = F.floor((minutes - F.col("offset_min")) / F.col("slot_min")) * F.col("slot_min") + F.col("offset_min")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    expected = epoch + F.make_dt_interval(F.lit(0), F.lit(0), (slot_start_min + F.col("allowed_min")).cast("int"),
                                          F.lit(0))  # wall-clock arithmetic: no session zone involved
    runs = j.withColumn("expected_completion", expected)
    return Q.sla_breaches(runs, "pipeline_name", "expected_completion", "completed_at")


COMPLAINT_TRACKED = ["status", "resolution_description", "closed_at"]


def scd_311_complaint_status(observations: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """SCD2 of request status (H1/H2): ``observations`` are staged request
    versions (source_unique_key, tracked columns, _ingestion_timestamp) —
    every ingestion, not just the latest. Without ``history`` the table is
    built in full; with it, only open versions and the new batch are
    replayed. A version opens only when a tracked column changes (D9, D16)."""
    from metroframe.operators import snapshots as H
    obs = observations.select("source_unique_key", *COMPLAINT_TRACKED, "_ingestion_timestamp")
    if history is None:
        return H.scd2_history(obs, "source_unique_key", COMPLAINT_TRACKED, "_ingestion_timestamp")
    return H.scd2_merge(history, obs, "source_unique_key", COMPLAINT_TRACKED, "_ingestion_timestamp")


def request_observations(raw: DataFrame) -> DataFrame:
    """Every valid ingested copy of a request, typed (input of the status
    SCD; unlike staging, copies are kept)."""
    return raw.filter(F.col("is_valid")).select(
        F.col("unique_key").alias("source_unique_key"), "status", "resolution_description",
        nyc_local_to_utc("closed_date").alias("closed_at"), "_ingestion_timestamp")


# Raw fields of an arrival prediction.
ARRIVAL_FIELDS = ["vehicleId", "lineId", "lineName", "stationName", "naptanId", "platformName", "direction",
                  "destinationName", "timeToStation", "expectedArrival"]
ARRIVAL_SCHEMA = _strings(ARRIVAL_FIELDS)


def stg_tfl_arrivals(raw: DataFrame, observed_col: str = "_ingestion_timestamp") -> DataFrame:
    """Arrival predictions (E13): typed, keyed by MD5(vehicle, stop,
    expected arrival), latest poll wins. The raw feed has no scheduled time,
    so no delay is derived. Predictions without a stop or a line are in
    ``quarantine_arrivals``."""
    typed = raw.select(
        C.safe_str("vehicleId").alias("vehicle_id"), C.safe_str("lineId").alias("line_id"),
        C.safe_str("lineName").alias("line_name"), C.safe_str("naptanId").alias("stop_point_id"),
        C.safe_str("stationName").alias("station_name"), C.safe_str("direction").alias("direction"),
        C.safe_str("destinationName").alias("destination_name"),
        C.safe_int("timeToStation").alias("time_to_station_seconds"),
        C.safe_str("expectedArrival").alias("_expected_text"), F.col(observed_col).alias("observed_at"))
    typed = typed.where(F.col("stop_point_id").isNotNull() & F.col("line_id").isNotNull())
    latest = S.dedup_latest(typed, ["vehicle_id", "stop_point_id", "_expected_text"], ["observed_at"])
    return latest.select(
        C.surrogate_key("vehicle_id", "stop_point_id", "_expected_text").alias("arrival_event_id"),
        "vehicle_id", "line_id", "line_name", "stop_point_id", "station_name", "direction", "destination_name",
        "time_to_station_seconds", C.parse_timestamp("_expected_text").alias("expected_arrival_at"), "observed_at")


def quarantine_arrivals(raw: DataFrame) -> DataFrame:
    """Arrival predictions without a stop or a line."""
    missing = F.coalesce(F.when(C.safe_str("naptanId").isNull(), F.lit("missing stop")),
                         F.when(C.safe_str("lineId").isNull(), F.lit("missing line")))
    return raw.withColumn("quarantine_reason", missing).where("quarantine_reason is not null")
