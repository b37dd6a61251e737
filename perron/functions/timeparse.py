"""Timestamps: compact digit strings, wall-clock differences, calendar parts.

Times are local wall-clock values (``TIMESTAMP_NTZ``). Everything here is
independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEN_DIGITS = r"\A[0-9]{10}\z"
TWELVE_DIGITS = r"\A[0-9]{12}\z"


def _int(text: Column, start: int, length: int) -> Column:
    return F.substring(text, start, length).cast("int")


def _timestamp(year: Column, month: Column, day: Column, hour: Column, minute: Column) -> Column:
    # Impossible dates (month 13, 30 February, hour 24) become null.
    return F.try_make_timestamp_ntz(year, month, day, hour, minute, F.lit(0).cast("decimal(16,6)"))


def parse_time_lake(text: Column) -> Column:
    """``YYMMDDHHMM`` with the year always in 2000-2099; anything else is null."""
    return F.when(
        text.rlike(TEN_DIGITS),
        _timestamp(
            _int(text, 1, 2) + 2000, _int(text, 3, 2), _int(text, 5, 2), _int(text, 7, 2), _int(text, 9, 2)
        ),
    )


def parse_time_folder(text: Column) -> Column:
    """Snapshot folder name ``YYMMDDHHMM``; folders that are no time are null."""
    return parse_time_lake(text)


def parse_time_warehouse(text: Column) -> Column:
    """``YYMMDDHHMM`` (two-digit year pivots at 60) or ``YYYYMMDDHHMM``."""
    yy = _int(text, 1, 2)
    short = _timestamp(
        yy + F.when(yy < 60, 2000).otherwise(1900),
        _int(text, 3, 2), _int(text, 5, 2), _int(text, 7, 2), _int(text, 9, 2),
    )
    long = _timestamp(
        _int(text, 1, 4), _int(text, 5, 2), _int(text, 7, 2), _int(text, 9, 2), _int(text, 11, 2)
    )
    return F.when(text.rlike(TEN_DIGITS), short).when(text.rlike(TWELVE_DIGITS), long)


def parse_time_dayfirst(text: Column) -> Column:
    """``DDMMYYHHMM``, used where a table still stores planned times as text."""
    return F.when(
        text.rlike(TEN_DIGITS),
        _timestamp(
            _int(text, 5, 2) + 2000, _int(text, 3, 2), _int(text, 1, 2), _int(text, 7, 2), _int(text, 9, 2)
        ),
    )


def planned_time_column(timetables: DataFrame) -> Column:
    """``planned_time`` as a timestamp; text columns are read day-first."""
    column = F.col("planned_time")
    if isinstance(timetables.schema["planned_time"].dataType, T.StringType):
        return parse_time_dayfirst(column)
    return column


def epoch_seconds(ts: Column) -> Column:
    """Whole wall-clock seconds since 1970-01-01 00:00, without a zone shift."""
    days = F.unix_date(F.to_date(ts)).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def delay_minutes_fractional(planned: Column, changed: Column) -> Column:
    return (epoch_seconds(changed) - epoch_seconds(planned)) / F.lit(60)


def delay_minutes_floor(planned: Column, actual: Column) -> Column:
    """Whole minutes rounded down, so 90 seconds early is -2."""
    seconds = epoch_seconds(actual) - epoch_seconds(planned)
    return F.floor(seconds / F.lit(60)).cast("int")


def calendar_columns(ts: Column) -> dict[str, Column]:
    """The time-dimension attributes of a timestamp; Monday is weekday 0."""
    return {
        "date": F.to_date(ts),
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "minute": F.minute(ts),
        "weekday": F.weekday(ts),
        "is_weekend": F.weekday(ts) >= 5,
    }
