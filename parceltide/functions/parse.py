"""Tolerant parsing of wire values. Bad input becomes NULL, never an exception."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# --- fixed values: the three accepted layouts of a replayed event time ---
#   2024-01-08T08:30:00    2024-01-08 08:30:00    2024-01-08T08:30:00.123456
_REPLAY_LAYOUT = (
    r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}"
    r"(T\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?| \d{1,2}:\d{1,2}:\d{1,2})$"
)
_NUMERIC_OFFSET = r"\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*[+-]\d{1,2}(:?\d{2})?$"


def timestamp(text: Column) -> Column:
    """ISO text to a zone-less timestamp; a zone suffix is dropped, anything else is NULL."""
    return F.trim(text).try_cast(T.TimestampNTZType())


def is_zoned(text: Column) -> Column:
    """True when the text ends in a numeric UTC offset (``Z`` does not count)."""
    return F.coalesce(F.trim(text).rlike(_NUMERIC_OFFSET), F.lit(False))


def replay_timestamp(text: Column) -> Column:
    return F.when(text.rlike(_REPLAY_LAYOUT), text.try_cast(T.TimestampNTZType()))


def number(text: Column) -> Column:
    return F.trim(text).try_cast("double")


def number_or_zero(text: Column) -> Column:
    return F.coalesce(number(text), F.lit(0.0))


def latlon(text: Column) -> Column:
    """``"lat,lon"`` to a struct; both parts are NULL unless exactly two numbers are given."""
    parts = F.split(text, ",", -1)
    lat = F.get(parts, F.lit(0))
    lon = F.get(parts, F.lit(1))
    valid = (F.size(parts) == 2) & number(lat).isNotNull() & number(lon).isNotNull()
    return F.struct(
        F.when(valid, number(lat)).alias("lat"),
        F.when(valid, number(lon)).alias("lon"),
    )


def iso_text(ts: Column) -> Column:
    """ISO-8601 text with six fraction digits, or none when the fraction is zero."""
    text = F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))
    return F.when(F.contains(text, F.lit(".")), F.rpad(text, 26, "0")).otherwise(text)


def decode(value: Column, schema: T.StructType, corrupt: str = "_corrupt") -> Column:
    """JSON text to a struct of texts, so that a number sent as text stays usable; text that is no
    JSON object is kept in the ``corrupt`` field."""
    with_corrupt = T.StructType([T.StructField(n, T.StringType()) for n in (*schema.names, corrupt)])
    return F.from_json(
        value, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    )


def has_key(value: Column, key: str) -> Column:
    """Whether a JSON object names the key at all, even with a null value."""
    return F.coalesce(F.array_contains(F.json_object_keys(value), key), F.lit(False))
