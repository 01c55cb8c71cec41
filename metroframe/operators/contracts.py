"""Column-level contracts: validation errors, hard/soft rules, quarantine
routing and run accounting (C1–C8).

A contract is a list of ``Rule``s evaluated as one projection: every row gets
``validation_errors`` (array of messages, in rule order) and ``is_valid``
(false only when a *hard* rule fails). Nothing is dropped here; routing is a
pair of filters over the same annotated plan.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from metroframe.functions.columns import safe_float, safe_int, safe_str
from metroframe.sources.raw import observed_counts


# Validation messages ("missing <field>" for absent fields, and
# these prefixes followed by the offending value).
MSG_MISSING = "missing "
MSG_UNKNOWN_BOROUGH = "unknown borough: "
MSG_UNKNOWN_LAW_CAT = "unknown law_cat_cd: "
MSG_UNKNOWN_CITY = "unknown city: "
MSG_INVALID_HOUR = "invalid hour_observed: "
MSG_AQI_RANGE = "aqi out of range: "


@dataclass(frozen=True)
class Rule:
    violated: Column  # true when the rule fails (null counts as pass)
    message: Column  # message text, may depend on the row
    hard: bool = False


def _msg(text) -> Column:
    return F.lit(text) if isinstance(text, str) else text


def rule(violated: Column, message, hard: bool = False) -> Rule:
    return Rule(F.coalesce(violated, F.lit(False)), _msg(message), hard)


def missing(col: str, name: str | None = None, hard: bool = False) -> Rule:
    return rule(safe_str(col).isNull(), MSG_MISSING + (name or col), hard)


def apply_contract(df: DataFrame, rules: list[Rule], all_hard: bool = False) -> DataFrame:
    """Annotate rows with ``validation_errors`` and ``is_valid``."""
    errors = F.filter(F.array(*[F.when(r.violated, r.message) for r in rules]), lambda m: m.isNotNull())
    hard = [r.violated for r in rules if r.hard or all_hard]
    failed_hard = F.lit(False)
    for h in hard:
        failed_hard = failed_hard | h
    return df.withColumn("validation_errors", errors).withColumn("is_valid", ~failed_hard)


def split_valid(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) as two filters over one annotated plan."""
    return annotated.filter(F.col("is_valid")), annotated.filter(~F.col("is_valid"))


# ---------------------------------------------------------------------------
# Source contracts
# ---------------------------------------------------------------------------

# Accepted boroughs, law categories and weather cities.
KNOWN_BOROUGHS = ["MANHATTAN", "BROOKLYN", "QUEENS", "BRONX", "STATEN ISLAND"]
VALID_LAW_CATS = ["FELONY", "MISDEMEANOR", "VIOLATION"]
CITY_COORDS = {
    "nyc": (40.7128, -74.0060),
    "london": (51.5074, -0.1278),
}


def request_rules(key="unique_key", created="created_date", ctype="complaint_type", borough="borough") -> list[Rule]:
    b = safe_str(borough)
    return [
        missing(key, "unique_key", hard=True),
        missing(created, "created_date", hard=True),
        missing(ctype, "complaint_type"),
        rule(b.isNotNull() & ~F.upper(b).isin(KNOWN_BOROUGHS), F.concat(F.lit(MSG_UNKNOWN_BOROUGH), b)),
    ]


def location_flags(lat="latitude", lon="longitude", borough="borough") -> dict[str, Column]:
    """has_location: both coordinates parse; has_borough: borough present."""
    return {
        "has_location": safe_float(lat).isNotNull() & safe_float(lon).isNotNull(),
        "has_borough": safe_str(borough).isNotNull(),
    }


def validate_requests(df: DataFrame, key="unique_key", created="created_date", ctype="complaint_type",
                      borough="borough", lat="latitude", lon="longitude") -> DataFrame:
    flags = location_flags(lat, lon, borough)
    return apply_contract(df, request_rules(key, created, ctype, borough)).withColumns(flags)


def incident_rules(key="cmplnt_num", from_date="cmplnt_fr_dt", law_cat="law_cat_cd") -> list[Rule]:
    lc = safe_str(law_cat)
    return [
        missing(key, "cmplnt_num", hard=True),
        missing(from_date, "cmplnt_fr_dt"),
        rule(lc.isNotNull() & ~F.upper(lc).isin(VALID_LAW_CATS), F.concat(F.lit(MSG_UNKNOWN_LAW_CAT), lc)),
    ]


def validate_incidents(df: DataFrame, key="cmplnt_num", from_date="cmplnt_fr_dt", law_cat="law_cat_cd") -> DataFrame:
    return apply_contract(df, incident_rules(key, from_date, law_cat))


def weather_rules(time="observation_time", city="city") -> list[Rule]:
    c = safe_str(city)
    return [
        missing(time, "observation_time"),
        missing(city, "city"),
        rule(c.isNotNull() & ~c.isin(list(CITY_COORDS)), F.concat(F.lit(MSG_UNKNOWN_CITY), c)),
    ]


def validate_weather(df: DataFrame, time="observation_time", city="city") -> DataFrame:
    """Any weather error rejects the row."""
    return apply_contract(df, weather_rules(time, city), all_hard=True)


def air_rules(param="parameter_name", date="date_observed", hour="hour_observed", aqi="aqi") -> list[Rule]:
    h = safe_int(hour)
    a = safe_int(aqi)
    return [
        missing(param, "parameter_name", hard=True),
        missing(date, "date_observed"),
        rule(h.isNotNull() & ~h.between(0, 23), F.concat(F.lit(MSG_INVALID_HOUR), h.cast("string"))),
        rule(a.isNotNull() & ~a.between(0, 500), F.concat(F.lit(MSG_AQI_RANGE), a.cast("string"))),
    ]


def validate_air(df: DataFrame, param="parameter_name", date="date_observed", hour="hour_observed", aqi="aqi") -> DataFrame:
    return apply_contract(df, air_rules(param, date, hour, aqi))


# ---------------------------------------------------------------------------
# Run accounting
# ---------------------------------------------------------------------------

def run_accounting(annotated: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """records_read / written / rejected and status per run (C7): 'success'
    when nothing was rejected, else 'partial'. One aggregation pass."""
    aggs = [
        F.count(F.lit(1)).alias("records_read"),
        F.count_if(F.col("is_valid")).alias("records_written"),
        F.count_if(~F.col("is_valid")).alias("records_rejected"),
    ]
    out = annotated.groupBy(*(group_cols or [])).agg(*aggs)
    return out.withColumn("status", F.when(F.col("records_rejected") == 0, "success").otherwise("partial"))


def error_counts(annotated: DataFrame) -> DataFrame:
    """Dry-run report (C8): rows per validation message, hard or soft."""
    return (annotated.select(F.explode("validation_errors").alias("message"))
            .groupBy("message").agg(F.count(F.lit(1)).alias("n_rows")))


def dry_run(annotated: DataFrame, name: str = "dry-run") -> dict:
    """Validate and count without writing (C8): the same plan runs into the
    ``noop`` sink and the counts come from an Observation on that pass."""
    obs = Observation(f"{name}-{uuid.uuid4().hex}")
    (annotated.observe(obs, F.count(F.lit(1)).alias("records_read"),
                       F.count_if(F.col("is_valid")).alias("records_valid"),
                       F.count_if(~F.col("is_valid")).alias("records_rejected"))
     .write.format("noop").mode("overwrite").save())
    return observed_counts(obs, ["records_read", "records_valid", "records_rejected"])


def failed_status(message: str) -> dict:
    """Run-log fields for a failed run: the message is cut at 2000 characters."""
    return {"status": "failed", "error_message": message[:2000]}
