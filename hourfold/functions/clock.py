"""The three clocks (UTC, output UTC+8, provider-local) as column expressions on TIMESTAMP_NTZ.

All of it is plain arithmetic on wall-clock readings, so results do not depend on the session
timezone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from ..constants import LAG_SLACK_MINUTES, OUTPUT_UTC_OFFSET_HOURS


def as_ntz(value: Column | dt.datetime | str) -> Column:
    """A batch hour given as Column, datetime or text."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def _less(ts: Column, minutes: bool) -> Column:
    seconds = F.extract(F.lit("SECOND"), ts)
    mins = F.minute(ts) if minutes else F.lit(0)
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), mins, seconds)


def hour_floor(ts: Column) -> Column:
    return _less(ts, minutes=True)


def minute_floor(ts: Column) -> Column:
    return _less(ts, minutes=False)


def millisecond_floor(ts: Column) -> Column:
    micros = F.extract(F.lit("SECOND"), ts) * 1000
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (micros - F.floor(micros)) / 1000)


def plus_hours(ts: Column, hours: Column | int) -> Column:
    hours = hours if isinstance(hours, Column) else F.lit(hours)
    return F.timestamp_add("HOUR", hours, ts)


def utc_to_output(ts: Column) -> Column:
    return plus_hours(ts, OUTPUT_UTC_OFFSET_HOURS)


def output_to_utc(ts: Column) -> Column:
    return plus_hours(ts, -OUTPUT_UTC_OFFSET_HOURS)


def window_end(batch_utc: Column, timezone: Column) -> Column:
    """Provider-local end of the hour that closed at ``batch_utc``; NULL without a timezone."""
    return plus_hours(batch_utc, timezone)


def window_start(batch_utc: Column, timezone: Column) -> Column:
    return plus_hours(batch_utc, timezone - 1)


def hours_of_day(ts: str) -> Column:
    """Aggregate: which hours of the day come, hour h as bit h."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.hour(ts)))


def hour_bits(first: Column, last: Column) -> Column:
    """The hours ``first`` to ``last`` of a day, hour h as bit h."""
    one = F.lit(1).cast("bigint")
    return F.call_function("shiftleft", one, last + 1) - F.call_function("shiftleft", one, first)


def month_code(ts: Column) -> Column:
    """Month database suffix, yyMM."""
    number = (F.year(ts) % 100) * 100 + F.month(ts)
    return F.lpad(number.cast("string"), 4, "0")


def month_first(code: Column) -> Column:
    """First instant of a yyMM month, of 1970 to 2069."""
    year = F.substring(code, 1, 2).cast("int")
    year = F.when(year < 70, year + 2000).otherwise(year + 1900)
    return F.make_date(year, F.substring(code, 3, 2).cast("int"), F.lit(1)).cast("timestamp_ntz")


def minutes_crossed(earlier: Column, later: Column) -> Column:
    """Minute boundaries between two readings: 00:00:59 to 00:01:00 counts as one."""
    gap = minute_floor(later) - minute_floor(earlier)
    return gap.cast("interval minute").cast("bigint")


def seconds_between(earlier: Column, later: Column) -> Column:
    """Whole seconds between two readings."""
    return (later - earlier).cast("interval second").cast("bigint")


def run_threshold(batch_utc: Column, timezone: Column, slack: int = LAG_SLACK_MINUTES) -> Column:
    """Reading a source must have reached for its hour to count as complete."""
    return F.timestamp_add("MINUTE", timezone * 60 - slack, batch_utc)


def offset_hours(minutes: Column) -> Column:
    """Whole-hour UTC offset of a source that reads ``minutes`` behind UTC (rounds down, then flips)."""
    return (-F.floor(minutes / 60)).cast("int")


def offset_rest(minutes: Column) -> Column:
    """Minutes left after the whole hours; never negative."""
    return F.pmod(minutes, F.lit(60.0))
