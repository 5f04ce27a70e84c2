"""Business dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KOREA = "Asia/Seoul"


def zone_time(ts: Column | str, zone: str = KOREA, source_zone: str = "UTC") -> Column:
    """Wall-clock time in ``zone`` of a timestamp without zone that was taken in ``source_zone``."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), column)


def kst_date(ts: Column | str, zone: str = KOREA, source_zone: str = "UTC") -> Column:
    """Business date: the calendar date in ``zone``."""
    return F.to_date(zone_time(ts, zone, source_zone))


def compact_date(day: Column | str) -> Column:
    """A date as yyyymmdd text."""
    return F.date_format(F.col(day) if isinstance(day, str) else day, "yyyyMMdd")


def name_suffix_date(name: Column | str) -> Column:
    """The date in the 8-digit end of a dated table name; null where there is none."""
    column = F.col(name) if isinstance(name, str) else name
    return F.to_date(F.try_to_timestamp(F.regexp_extract(column, "_([0-9]{8})$", 1), F.lit("yyyyMMdd")))
