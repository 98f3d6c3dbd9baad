"""Date and time expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """Integer YYYYMMDD."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def minute_number(ts: Column) -> Column:
    """Minutes since 1970-01-01 of a zone-less timestamp, seconds ignored."""
    days = F.unix_date(F.to_date(ts)).cast("bigint")
    return days * 1440 + F.hour(ts) * 60 + F.minute(ts)


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed: 00:00:59 to 00:01:01 is 1."""
    return minute_number(end) - minute_number(start)


def hours_between(start: Column, end: Column) -> Column:
    """Elapsed hours as a fraction, negative when ``end`` is earlier."""
    seconds = minutes_between(start, end) * 60 + (
        F.extract(F.lit("SECOND"), end) - F.extract(F.lit("SECOND"), start)
    )
    return seconds.cast("double") / 3600


def month_label(ts: Column) -> Column:
    """``M-YYYY`` without zero padding."""
    return F.concat(F.month(ts).cast("string"), F.lit("-"), F.year(ts).cast("string"))
