"""Event-time expressions. None of them depends on the session time zone."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.config import TIME_FORMAT, micros

_YEAR_MS = 365 * 24 * 3600 * 1000


def parse_time(text: Column, tz: str, fmt: str = TIME_FORMAT) -> Column:
    """Text written in zone ``tz`` -> instant; unparsable text gives null."""
    return F.try_to_timestamp(
        F.concat(text, F.lit(" "), F.lit(tz)), F.lit(f"{fmt} VV")
    )


def time_to_millis(text: Column, tz: str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text written in ``tz`` -> epoch milliseconds."""
    return F.unix_millis(parse_time(text, tz))


def millis_to_time(ms: Column) -> Column:
    """Epoch milliseconds -> instant, cut to the whole second as the SQL jobs do."""
    return F.timestamp_seconds(F.floor(ms / F.lit(1000)).cast("bigint"))


def local_time(ts: Column, tz: str) -> Column:
    """The wall clock of an instant in zone ``tz``, as a zone-free timestamp.

    Goes through the session's wall clock: in a session zone with summer time, the two
    instants of its repeated hour cannot be told apart. Sessions built here are in UTC.
    """
    return F.convert_timezone(
        F.current_timezone(), F.lit(tz), ts.cast("timestamp_ntz")
    )


def format_time(ts: Column, tz: str, fmt: str = TIME_FORMAT) -> Column:
    return F.date_format(local_time(ts, tz), fmt)


def local_day(ts: Column, tz: str) -> Column:
    """The calendar day of an instant in zone ``tz``."""
    return F.to_date(local_time(ts, tz))


def age_years(birthday: Column, as_of: Column, tz: str) -> Column:
    """Whole 365-day years between a ``yyyy-MM-dd`` birthday and ``as_of``."""
    born = F.unix_millis(parse_time(birthday.cast("string"), tz, "yyyy-MM-dd"))
    return F.floor((F.unix_millis(as_of) - born) / F.lit(_YEAR_MS)).cast("int")


def clock_millis() -> Column:
    """Processing time in whole seconds, expressed in milliseconds."""
    return F.unix_timestamp(F.current_timestamp()) * F.lit(1000)


def tile(ts: Column, width: timedelta) -> Column:
    """The index of the ``width``-long slice of time that holds ``ts``."""
    return F.floor(F.unix_micros(ts) / F.lit(micros(width))).cast("bigint")
