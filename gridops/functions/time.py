"""Timestamp expressions on TIMESTAMP_NTZ.

Activity timestamps are wall-clock values without a zone, so each expression
avoids the session time zone: the same input gives the same answer everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridops.schema import FILE_PATTERN

HOUR_SECONDS = 3600


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c) -> Column:
    """Text or timestamp to TIMESTAMP_NTZ; text that is no timestamp becomes NULL."""
    return _col(c).try_cast("timestamp_ntz")


def hour_floor(c) -> Column:
    """Start of the hour."""
    seconds = F.extract(F.lit("SECOND"), _col(c))
    return _col(c) - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(_col(c)), seconds)


def day_floor(c) -> Column:
    """Midnight of the same day."""
    return F.to_date(_col(c)).cast("timestamp_ntz")


def epoch_seconds(c) -> Column:
    """Seconds since 1970-01-01 of the wall clock, as BIGINT."""
    c = _col(c)
    clock = F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    return F.unix_date(F.to_date(c)).cast("bigint") * 86400 + clock


def time_key(c) -> Column:
    """Key of the time dimension."""
    return epoch_seconds(c)


def date_hour_to_ts(date, hour) -> Column:
    """Date plus hour of day; a date that does not parse gives NULL."""
    start = _col(date).try_cast("date").cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), _col(hour))


def hours_before(c, hours: int = 23) -> Column:
    """The timestamp ``hours`` earlier."""
    return _col(c) - F.make_dt_interval(F.lit(0), F.lit(hours))


def strip_offset(c) -> Column:
    """ISO text to its wall clock, dropping ``Z`` or a UTC offset."""
    return _col(c).try_cast("timestamp_ntz")


def file_date(name) -> Column:
    """Date inside a dated file name, NULL for any other name."""
    return F.nullif(F.regexp_extract(_col(name), FILE_PATTERN, 1), F.lit("")).try_cast("date")
