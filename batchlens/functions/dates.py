"""Parsing of time columns that mix several date formats, and the calendar-month key."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from batchlens.functions.values import column

# The accepted date formats in the order they are tried, month before day.
FORMATS = (
    "M/d/yyyy",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yyyy h:mm a",
    "M/d/yyyy H:mm:ss.SSS",
    "M/d/yy",
    "M-d-yyyy",
    "d/M/yyyy",
    "d/M/yyyy H:mm:ss",
    "d/M/yy",
    "d-M-yyyy",
    "d-MMM-yy",
    "d-MMM-yy H:mm:ss",
    "d-MMM-yyyy",
    "d MMM yyyy",
    "MMMM d, yyyy",
    "yyyy/M/d",
    "yyyy/M/d H:mm:ss",
    "yyyy.M.d",
    "yyyy-M",
    "yyyyMMdd",
)
# What the parts of a format look like in a text.
SHAPES = (
    ("yyyy", r"\d{4}"),
    ("yy", r"\d{2}"),
    ("MMMM", r"[A-Za-z]{3,}"),
    ("MMM", r"[A-Za-z]{3,}"),
    ("MM", r"\d{2}"),
    ("M", r"\d{1,2}"),
    ("dd", r"\d{2}"),
    ("d", r"\d{1,2}"),
    ("H", r"\d{1,2}"),
    ("h", r"\d{1,2}"),
    ("mm", r"\d{2}"),
    ("ss", r"\d{2}"),
    ("SSS", r"\d{3}"),
    ("a", r"[AaPp][Mm]"),
)
# Fixed value: two-digit years from here on belong to the 1900s.
PIVOT = 69


def _shape(fmt: str) -> str:
    """Regular expression of the texts a format may fit. A failed parse costs far more than a mismatch."""
    looks = dict(SHAPES)
    parts = re.split("(" + "|".join(looks) + ")", fmt)
    return "^" + "".join(looks.get(part) or re.escape(part) for part in parts) + "$"


def _attempt(c: Column, fmt: str, pivot: int) -> Column:
    ts = F.when(c.rlike(_shape(fmt)), F.try_to_timestamp(c, F.lit(fmt)))
    if "yy" in fmt and "yyyy" not in fmt:
        # Spark reads every two-digit year as 20yy.
        ts = F.when(F.year(ts) >= 2000 + pivot, ts - F.expr("INTERVAL '100' YEAR")).otherwise(ts)
    return ts


def parse_timestamp(
    c: Column, formats: Sequence[str] = FORMATS, pivot: int = PIVOT, on_bad: str = "error"
) -> Column:
    """Text to timestamp by the first format that fits; ISO text is tried first.

    Missing text stays NULL. Text that fits no format raises, or is NULL with on_bad='null'.
    """
    if on_bad not in ("error", "null"):
        raise ValueError(f"on_bad must be 'error' or 'null', not {on_bad!r}")
    c = F.trim(c)
    iso = F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([T ].*)?$"), F.try_to_timestamp(c))
    ts = F.coalesce(iso, *[_attempt(c, fmt, pivot) for fmt in formats])
    if on_bad == "null":
        return ts
    failure = F.raise_error(F.concat(F.lit("unparseable time value: "), c)).cast("timestamp")
    return F.when(c.isNull() | (c == ""), F.lit(None).cast("timestamp")).otherwise(F.coalesce(ts, failure))


def time_value(df: DataFrame, name: str, **parsing) -> Column:
    """The time column as a timestamp; text is parsed, date and timestamp columns pass."""
    c = column(name)
    if isinstance(df.schema[name].dataType, StringType):
        return parse_timestamp(c, **parsing)
    return c.cast("timestamp")


def month_key(ts: Column) -> Column:
    """Calendar month as text, yyyy-MM, which also sorts in time order."""
    return F.date_format(ts, "yyyy-MM")
