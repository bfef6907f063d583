"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def weekday_number(d: Column | str) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(d))


def iso_year_week(d: Column | str) -> Column:
    """ISO week-numbering year * 100 + ISO week (2024-12-30 -> 202501)."""
    d = _c(d)
    thursday = F.date_add(d, F.lit(3) - F.weekday(d))
    return (F.year(thursday) * 100 + F.weekofyear(d)).cast("int")


def minute_text(ts: Column | str) -> Column:
    """Timestamp truncated to the minute, as 'yyyy-MM-dd HH:mm' text.

    Taken from the timestamp's ISO text: a wall-clock (timestamp_ntz) value is
    formatted as is, while ``date_format`` would first convert it to the
    session time zone (and shift it on a daylight-saving gap).
    """
    return F.substring(_c(ts).cast("string"), 1, 16)


def duration_text(minutes: Column | str) -> Column:
    """Signed minutes -> '[-]HH:mm' (hours not wrapped at 24). NULL stays NULL."""
    m = _c(minutes).cast("long")
    a = F.abs(m)
    hours = F.format_string("%02d", F.floor(a / 60))
    mins = F.lpad(F.pmod(a, F.lit(60)).cast("string"), 2, "0")
    return F.when(m.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.when(m < 0, F.lit("-")).otherwise(F.lit("")), hours, F.lit(":"), mins))
