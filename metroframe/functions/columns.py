"""Scalar column functions (Column -> Column), all JVM-side built-ins.

These re-express the per-record conversions of the ingestion layer as
expressions that Catalyst can fold, push down and code-generate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.strip() removes (the ASCII and
# Latin-1 whitespace plus the Unicode space separators).
STRIP_CHARS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Python float() grammar: optional sign, digits with single underscores
# between them, optional fraction and exponent, or inf / infinity / nan.
_DIGITS = r"[0-9](?:_?[0-9])*"
FLOAT_PATTERN = (
    rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:inf|infinity|nan))$"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_str(c) -> Column:
    """Strip surrounding whitespace; empty -> null (B1)."""
    return F.nullif(F.btrim(_col(c).cast("string"), F.lit(STRIP_CHARS)), F.lit(""))


def safe_float(c) -> Column:
    """Parse like Python float(): null when it does not parse (B2).

    The regex guard rejects forms Spark accepts but Python does not
    (``1.0d``); underscores Python accepts are removed before the cast."""
    s = F.btrim(_col(c).cast("string"), F.lit(STRIP_CHARS))
    return F.when(s.rlike(FLOAT_PATTERN), F.regexp_replace(s, "_", "").try_cast("double"))


def safe_int(c) -> Column:
    """int(float(x)): truncate toward zero; null when unparsable or non-finite."""
    return safe_float(c).try_cast("bigint")  # NaN, ±inf and overflow give null


def key_alias(m, *names) -> Column:
    """First key that is *present* in a map<string,string> wins, even if its
    value is null (B4): ``AQI`` else ``aqi``."""
    m = _col(m)
    out = F.lit(None).cast("string")
    for name in reversed(names):
        out = F.when(F.map_contains_key(m, F.lit(name)), m[name]).otherwise(out)
    return out


def nested_category(m, obj_key: str, field: str, flat_key: str) -> Column:
    """Field of a nested JSON object held in a map<string,string> (B5). A
    null or non-object value falls back to the flat key; an absent object
    counts as an empty object, so the result is null."""
    m = _col(m)
    obj = m[obj_key]
    is_object = F.coalesce(F.startswith(F.ltrim(obj), F.lit("{")), F.lit(False))
    return (F.when(~F.map_contains_key(m, F.lit(obj_key)), F.lit(None).cast("string"))
            .when(is_object, F.get_json_object(obj, f"$.{field}"))
            .otherwise(m[flat_key]))


def parse_timestamp(c, *formats) -> Column:
    """Timestamp from text, null when bad (B9). Without formats the ISO forms
    with ``T``/space, with and without seconds or fraction, are accepted."""
    s = safe_str(c)
    if not formats:
        return F.try_to_timestamp(s).cast("timestamp_ntz")
    parsed = [F.try_to_timestamp(s, F.lit(f)) for f in formats]
    return F.coalesce(*parsed).cast("timestamp_ntz")


def parse_date(c, fmt: str = "MM/dd/yyyy") -> Column:
    return F.try_to_date(safe_str(c), fmt)


def combine_date_time(date_col, time_col, date_fmt: str = "MM/dd/yyyy", time_fmt: str = "HH:mm:ss") -> Column:
    """Date + time text -> timestamp (B10). A missing time means midnight of
    the date; an unparsable time or date gives null (D3)."""
    d = safe_str(date_col)
    t = safe_str(time_col)
    with_time = F.try_to_timestamp(F.concat_ws(" ", d, t), F.lit(f"{date_fmt} {time_fmt}"))
    date_only = F.try_to_timestamp(d, F.lit(date_fmt))
    return F.when(t.isNull(), date_only).otherwise(with_time).cast("timestamp_ntz")


# Zone labels seen in feeds and their UTC offsets in hours.
# Spark rejects EDT and reads BST as Bangladesh, so labels never reach the
# zone parser.
ZONE_LABEL_OFFSETS = {
    "UTC": 0, "GMT": 0, "BST": 1,
    "EST": -5, "EDT": -4, "CST": -6, "CDT": -5,
    "MST": -7, "MDT": -6, "PST": -8, "PDT": -7,
}


def zone_offset_hours(label) -> Column:
    """Offset in hours for a zone label; null for unknown labels."""
    lab = F.upper(safe_str(label))
    out = None
    for name, off in ZONE_LABEL_OFFSETS.items():
        out = (F.when(lab == name, F.lit(off)) if out is None else out.when(lab == name, F.lit(off)))
    return out


def local_to_utc(ts, label=None, zone: str | None = None) -> Column:
    """Local wall-clock time -> UTC wall-clock time (B11), as timestamp_ntz.

    With ``label`` (e.g. EST / EDT) the fixed offset of the label applies; an
    unknown label yields null. With ``zone`` (an IANA name such as
    America/New_York) the zone's DST rules apply."""
    ts = _col(ts).cast("timestamp_ntz")
    if label is not None:
        off = zone_offset_hours(label)
        return (ts - F.make_dt_interval(F.lit(0), off, F.lit(0), F.lit(0))).cast("timestamp_ntz")
    return F.to_utc_timestamp(ts.cast("timestamp"), zone).cast("timestamp_ntz")


# The zone of each city.
CITY_ZONES = {"nyc": "America/New_York", "london": "Europe/London"}


def city_local_date(ts, city) -> Column:
    """Date on the city's clock of a UTC wall-clock time (D4): ``*_date``
    columns name the day that people there lived through. A city without a
    known zone keeps the UTC date."""
    ts, city = _col(ts).cast("timestamp_ntz"), _col(city)
    local = ts
    for name, zone in CITY_ZONES.items():
        local = F.when(city == name, F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)).otherwise(local)
    return F.to_date(local)


def surrogate_key(*parts) -> Column:
    """MD5 over '|'-joined natural-key parts (B12). Nulls become '' first:
    a bare concat_ws skips nulls and makes (a, null, b) collide with (a, b)."""
    return F.md5(F.concat_ws("|", *[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts]))


def hour_trunc(ts) -> Column:
    return F.date_trunc("hour", _col(ts)).cast("timestamp_ntz")


def day_trunc(ts) -> Column:
    return F.to_date(_col(ts))


def calendar_features(ts) -> dict[str, Column]:
    """hour_of_day, day_of_week (1 = Sunday … 7 = Saturday), is_weekend, month."""
    ts = _col(ts)
    dow = F.dayofweek(ts)
    return {
        "hour_of_day": F.hour(ts),
        "day_of_week": dow,
        "is_weekend": dow.isin(1, 7),
        "month": F.month(ts),
    }


def minutes_between(start, end) -> Column:
    return F.timestamp_diff("MINUTE", _col(start), _col(end))


def hours_between(start, end) -> Column:
    return F.timestamp_diff("SECOND", _col(start), _col(end)) / F.lit(3600.0)
