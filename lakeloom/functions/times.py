"""Date and time expressions that do not depend on the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def window_label(minute: Column, size: int) -> Column:
    """Label of the window a minute falls in, such as ``05-10``."""
    first = F.floor(minute / size) * size
    return F.format_string("%02d-%02d", first, first + size)


def epoch_date(seconds: Column) -> Column:
    """UTC date of seconds since 1970."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / SECONDS_PER_DAY).cast("int"))


def day_seconds(seconds: Column) -> Column:
    """Seconds since UTC midnight."""
    return F.pmod(seconds, F.lit(SECONDS_PER_DAY))


def stamp_in(name: Column, digits: str, fmt: str) -> Column:
    """Timestamp written in a file name or path; NULL where the pattern does not occur or gives no date."""
    found = F.regexp_extract(name, digits, 1)
    return F.try_to_timestamp(F.when(found != "", found), F.lit(fmt))


# Time stamps in file names, as pattern and format.
COMPACT_STAMP = (r"(\d{14})", "yyyyMMddHHmmss")
ZULU_STAMP = (r"(\d{8}T\d{6}Z)", "yyyyMMdd'T'HHmmss'Z'")
