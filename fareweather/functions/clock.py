"""Clock functions shared by trips and weather. None depends on the session's time zone.

Trips carry wall-clock time, weather carries instants; both meet by the hour in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400
HOUR_SECONDS = 3_600


def hour_start(moment: Column) -> Column:
    """The full hour a wall-clock moment falls in."""
    return hour_from_key(hour_key(moment))


def hour_key(moment: Column) -> Column:
    """The hour of a wall-clock moment as seconds since 1970.

    A BIGINT key lets joins use Spark's long hash relation and costs a fraction of ``date_trunc``.
    """
    day = F.unix_date(moment.cast("date")).cast("bigint")
    return day * DAY_SECONDS + F.hour(moment).cast("bigint") * HOUR_SECONDS


def instant_hour_key(moment: Column) -> Column:
    """The same key for an instant, by its wall-clock time in UTC."""
    seconds = F.unix_timestamp(moment)
    return seconds - F.pmod(seconds, F.lit(HOUR_SECONDS))


def hour_from_key(key: Column) -> Column:
    day = F.date_from_unix_date(F.floor(key / DAY_SECONDS).cast("int")).cast("timestamp_ntz")
    return day + F.make_dt_interval(hours=(F.pmod(key, F.lit(DAY_SECONDS)) / HOUR_SECONDS).cast("int"))


def hour_of_day(moment: Column) -> Column:
    return F.hour(moment)


def weekday(moment: Column) -> Column:
    """1 is Sunday, 7 is Saturday."""
    return F.dayofweek(moment)


def epoch_to_timestamp(seconds: Column) -> Column:
    return seconds.cast("timestamp")
