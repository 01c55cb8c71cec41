"""Seed lookup tables (A2).

The CSV files under ``metroframe/seeds`` are fixed reference rows (zip →
borough, severity codes, WMO weather codes, complaint SLAs). They are tiny
(≤ 59 rows), so they are parsed on the driver and become local relations
that every join can broadcast safely. ``read_seed_csv`` reads a seed from a
shared path instead, typed by an explicit schema.
"""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED_DIR = Path(__file__).resolve().parent.parent / "seeds"

SEED_SCHEMAS = {
    "borough_zip_lookup": T.StructType([
        T.StructField("zip_code", T.StringType(), False),
        T.StructField("borough_name", T.StringType(), False),
        T.StructField("neighborhood", T.StringType(), True),
    ]),
    "tfl_severity_lookup": T.StructType([
        T.StructField("severity_code", T.LongType(), False),
        T.StructField("severity_description", T.StringType(), False),
        T.StructField("is_disrupted", T.BooleanType(), False),
    ]),
    "wmo_weather_code_lookup": T.StructType([
        T.StructField("wmo_code", T.LongType(), False),
        T.StructField("description", T.StringType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("is_precipitation", T.BooleanType(), False),
    ]),
    "complaint_type_sla": T.StructType([
        T.StructField("complaint_type", T.StringType(), False),
        T.StructField("sla_hours", T.LongType(), False),
        T.StructField("priority_level", T.StringType(), False),
    ]),
}

_CONVERT = {
    T.StringType: str,
    T.LongType: int,
    T.BooleanType: lambda v: v.strip().lower() == "true",
}


def seed_rows(name: str) -> list[tuple]:
    schema = SEED_SCHEMAS[name]
    with open(SEED_DIR / f"{name}.csv", newline="") as fh:
        reader = csv.DictReader(fh)
        return [tuple(_CONVERT[type(f.dataType)](rec[f.name]) for f in schema.fields) for rec in reader]


def seed(spark: SparkSession, name: str) -> DataFrame:
    """A fixed seed table, with the hint to broadcast it: its rows are known
    here (59 at most), so no join has to trust a caller's word for its size."""
    return F.broadcast(spark.createDataFrame(seed_rows(name), SEED_SCHEMAS[name]))


def read_seed_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A seed CSV with a header, typed by its schema or by a seed's name."""
    schema = SEED_SCHEMAS[schema] if isinstance(schema, str) else schema
    return spark.read.schema(schema).option("header", True).csv(path)


def values_sql(rows: list[tuple], columns: list[str]) -> str:
    """The rows as a SQL ``VALUES`` relation (used by oracle queries)."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, (int, float)):
            return repr(v)
        return "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(columns)})"
