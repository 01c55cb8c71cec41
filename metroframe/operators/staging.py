"""Staging operators: latest-wins dedup, lookups, measure pivots, PII masking
(E1–E15).

Design notes for scale:

* Dedup is a ``groupBy(key).agg(max_by(row, order))``: a two-phase
  aggregate, so the map side already collapses the ~100 re-ingested copies
  of a record before anything is shuffled. The shuffle is bounded by
  distinct keys × partitions, not by input rows, and a hot key is combined
  map-side rather than landing in one task.
* Lookups against fixed seed tables are broadcast (their row count is known
  where they are made, ``sources.seeds``).
  Lookups against tables derived from data are plain joins: the planner
  broadcasts them only when their measured size is under the threshold
  (statically from file statistics, or at runtime through AQE), and
  otherwise falls back to a sort-merge join.
* Pivots are conditional aggregates in one hash aggregation (one pass),
  with the overall maximum and the argmax computed in the same pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metroframe.functions.columns import safe_str


def dedup_latest(df: DataFrame, keys: list[str], order: list[str], tiebreak: bool = True) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple.

    ``order`` is compared lexicographically; with ``tiebreak`` a content hash
    of every column is appended, so exact ties (same ingestion timestamp,
    different payload) resolve deterministically on every recompute."""
    payload = [c for c in df.columns if c not in keys]
    order_cols = [F.col(c) for c in order]
    if tiebreak:
        order_cols.append(F.xxhash64(*[F.col(c) for c in df.columns]).alias("_content_hash"))
    best = F.max_by(F.struct(*[F.col(c) for c in payload]), F.struct(*order_cols)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in payload])


def exact_mean(value, decimals: int, divide_by: float = 1.0) -> Column:
    """Mean of a value with a fixed number of decimals, summed as exact
    integers and divided once: the result does not depend on the order in
    which partial sums are combined, so reruns and other engines agree to
    the last bit."""
    scale = 10 ** decimals
    v = F.col(value) if isinstance(value, str) else value
    return F.sum(F.round(v * scale).cast("bigint")) / (F.count(v) * F.lit(float(scale) * divide_by))


def time_bucket(ts, width: str) -> Column:
    """Start of the fixed-width window containing ``ts`` (epoch aligned)."""
    return F.window(ts, width).start


def dedup_window(df: DataFrame, key: str, ts: str, width: str, order: list[str] | None = None,
                 bucket_col: str = "bucket_start") -> DataFrame:
    """Latest row per (key, time bucket)."""
    with_bucket = df.withColumn(bucket_col, time_bucket(F.col(ts), width))
    return dedup_latest(with_bucket, [key, bucket_col], order or [ts])


def lookup(df: DataFrame, table: DataFrame, left_key: Column | str, right_key: str, how: str = "left") -> DataFrame:
    """Equi left join to a lookup table. Seed tables (fixed, known row count)
    carry their own broadcast hint; other tables are left to the planner's
    size check."""
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    return df.join(table, lk == table[right_key], how)


def fill_from_lookup(df: DataFrame, table: DataFrame, left_key: Column, right_key: str, target: str,
                     lookup_value: str, normalize=F.upper, carry: list[str] | None = None,
                     out: str | None = None) -> DataFrame:
    """Null-fill ``target`` from a lookup (E3/E4): keep the normalised source
    value when present, else take the lookup's value. ``carry`` brings extra
    lookup columns along (neighborhood)."""
    out = out or target
    joined = lookup(df, table, left_key, right_key)
    keep = [c for c in df.columns if c != out]
    filled = F.coalesce(normalize(safe_str(df[target])), table[lookup_value]).alias(out)
    extra = [table[c] for c in (carry or [])]
    return joined.select(*[df[c] for c in keep], filled, *extra)


def zip5(c) -> Column:
    """First five characters of a ZIP or ZIP+4."""
    return F.substring(safe_str(c), 1, 5)


def pivot_measures(df: DataFrame, group_cols: list[str], pivot_col: str, measure: str, values: list[str],
                   names: dict[str, str] | None = None, overall: str | None = "overall",
                   argmax: str | None = None, extra_aggs: list[Column] | None = None) -> DataFrame:
    """One row per group with max(measure) per pivot value (E9), the max over
    *all* values including unpivoted ones (E10) and the argmax with an
    alphabetical tie-break (F8), all in one aggregation."""
    names = names or {}
    aggs = [F.max(F.when(F.col(pivot_col) == F.lit(v), F.col(measure))).alias(names.get(v, f"{v}_{measure}"))
            for v in values]
    if overall:
        aggs.append(F.max(measure).alias(overall))
    if argmax:
        aggs.append(F.max_by(F.col(pivot_col), F.struct(F.col(measure), F.col(pivot_col))).alias(argmax))
    aggs.extend(extra_aggs or [])
    return df.groupBy(*group_cols).agg(*aggs)


# AQI bands of the public EPA scale (upper bounds, inclusive).
AQI_BANDS = [
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive Groups"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
    (500, "Hazardous"),
]


def aqi_band(aqi) -> Column:
    a = F.col(aqi) if isinstance(aqi, str) else aqi
    out = None
    for upper, name in AQI_BANDS:
        out = F.when(a <= upper, F.lit(name)) if out is None else out.when(a <= upper, F.lit(name))
    return out


def valid_aqi(aqi) -> Column:
    """AQI outside 0–500 is soft-flagged at ingest and ignored downstream."""
    a = F.col(aqi) if isinstance(aqi, str) else aqi
    return F.when(a.between(0, 500), a)


def worst_category(category: str, aqi: str, param: str) -> Column:
    """Category reported with the worst pollutant (E11), ties by name."""
    return F.max_by(F.col(category), F.struct(F.col(aqi), F.col(param)))


def rule_map(c, rules: list[tuple[str, str]], default=None) -> Column:
    """First matching regex wins (E12 area → city, F4 reason → category)."""
    s = F.col(c) if isinstance(c, str) else c
    out = None
    for pattern, value in rules:
        out = F.when(s.rlike(pattern), F.lit(value)) if out is None else out.when(s.rlike(pattern), F.lit(value))
    return out.otherwise(F.lit(default)) if default is not None else out


# Reporting-area patterns per city.
AREA_CITY_RULES = [
    (r"(?i)^(new york|nyc)", "nyc"),
    (r"(?i)london", "london"),
]

# Disruption reason categories, first match wins. Whole words
# only ("service" holds no ice, "train" no rain); planned work and staffing
# come first, as a text that names them is not about its other words. The
# second entry lists plain texts of which every match holds one.
REASONS = [
    ("planned", ["planned", "engineering", "works", "closure", "maintenance"], "planned|engineering|works|closures?|maintenance"),
    ("staffing", ["strike", "staff", "crew", "industrial action"], "strikes?|staff|staffing|crews?|industrial action"),
    ("signal_failure", ["signal", "point", "track circuit", "train fault", "faulty train", "power "],
     "signals?|signalling|points? (failure|fault)|track circuit|train fault|faulty train|power (failure|supply|cut)"),
    ("weather", ["weather", "flood", "snow", "ice", "icy", "storm", "heat", "rain", "wind", "fog"],
     "weather|floods?|flooding|flooded|snow|ice|icy|storms?|heat|rain|winds?|fog"),
]


def classify_reason(c) -> Column:
    """The category of a free text. A category's pattern runs only over texts
    that hold one of its plain parts."""
    def category(low: Column) -> Column:
        out = None
        for name, parts, pattern in REASONS:
            held = reduce(Column.__or__, [F.contains(low, F.lit(p)) for p in parts])
            here = held & low.rlike(rf"(?<![\p{{L}}\p{{N}}_])({pattern})(?![\p{{L}}\p{{N}}_])")
            out = F.when(here, name) if out is None else out.when(here, name)
        return out.otherwise("unknown")

    # a lambda binds the lower-cased text, so that it is worked out once
    low = F.lower(F.col(c) if isinstance(c, str) else c)
    return F.element_at(F.transform(F.array(low), category), 1)


def area_to_city(c) -> Column:
    return rule_map(c, AREA_CITY_RULES)


def precip_flag(mm, threshold: float = 0.1) -> Column:
    """is_precipitation := precipitation_mm > 0.1, never null."""
    m = F.col(mm) if isinstance(mm, str) else mm
    return F.coalesce(m > F.lit(threshold), F.lit(False))


# Free-text PII patterns and their replacement tokens. Patterns
# apply in order, the most specific first; a phone number needs its usual
# groups, so dates and plain ids are left alone.
PII_PATTERNS = [
    (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}\b", "[EMAIL]"),
    (r"(?=[0-9])\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "[SSN]"),
    (r"(?=[+(0-9])(\+[0-9]{1,3}[ .-]?)?(\([0-9]{3}\) ?|\b[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}\b", "[PHONE]"),
    (r"(?=[0-9])\b[0-9]{1,6} [A-Za-z]+ (Street|St|Avenue|Ave|Road|Rd|Boulevard|Blvd|Lane|Ln)\b", "[ADDRESS]"),
]


def _worth_a_look(text: Column) -> dict[str, Column]:
    """Per token a cheap test that every text with a match passes."""
    number = text.rlike("[0-9]{2}[ .-][0-9]{4}")
    street = [F.contains(text, F.lit(f" {name}")) for name in ("St", "Ave", "R", "B", "L")]
    return {"[EMAIL]": F.contains(text, F.lit("@")), "[SSN]": number, "[PHONE]": number,
            "[ADDRESS]": reduce(Column.__or__, street) & text.rlike("[0-9] [A-Za-z]+ [SARBL]")}


def mask_text(c, patterns: list[tuple[str, str]] | None = None) -> Column:
    """Replace PII spans in free text (E14); patterns apply in order. Most
    texts hold nothing that the usual patterns could match and skip them."""
    out = text = F.col(c) if isinstance(c, str) else c
    tests = _worth_a_look(text) if patterns is None else {}
    for pattern, token in patterns or PII_PATTERNS:
        masked = F.regexp_replace(out, pattern, token)
        out = F.when(tests[token], masked).otherwise(out) if token in tests else masked
    return out



def pseudonymize(c, salt: str) -> Column:
    """Salted SHA-256 of a direct identifier (street address). Without a salt
    a list of all streets would undo it, so an empty one is an error."""
    if not salt:
        raise ValueError("pseudonymize needs a salt")
    return F.sha2(F.concat(F.lit(salt), F.col(c) if isinstance(c, str) else c), 256)


PII_KEY = "pii"


def tag_pii(df: DataFrame, tags: dict[str, str]) -> DataFrame:
    """Attach {"pii": "direct" | "adjacent"} metadata to columns."""
    return df.select(*[F.col(c).alias(c, metadata={PII_KEY: tags[c]}) if c in tags else F.col(c)
                       for c in df.columns])


def drop_pii(df: DataFrame) -> DataFrame:
    """Keep only untagged columns; the mart builders call this last."""
    keep = [f.name for f in df.schema.fields if PII_KEY not in (f.metadata or {})]
    return df.select(*keep)


def assert_no_pii(df: DataFrame) -> DataFrame:
    leaked = [f.name for f in df.schema.fields if PII_KEY in (f.metadata or {})]
    if leaked:
        raise ValueError(f"PII columns in mart output: {leaked}")
    return df
