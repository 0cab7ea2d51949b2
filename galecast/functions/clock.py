"""Local clock times of the feeds.

The feeds carry Korean local time as text, without a zone. It is kept here as
``TIMESTAMP_NTZ`` (a wall-clock time), so that no result depends on the zone of
the session. Only ``zoned_instant`` gives a point in absolute time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Zone of the feeds, issue hours of the short-range forecast,
# minutes until an issue is published.
ZONE = "Asia/Seoul"
ISSUE_HOURS = (2, 5, 8, 11, 14, 17, 20, 23)
ISSUE_BUFFER_MINUTES = 25
NOWCAST_PUBLISH_MINUTE = 10
FORECAST_MINUTE = 30
FORECAST_PUBLISH_MINUTE = 45
BASE_TRIES = 4
YEAR_RANGE = (2000, 2100)


def date_text(value: Column) -> Column:
    return F.replace(value.cast("string"), F.lit("-"), F.lit(""))


def time_text(value: Column) -> Column:
    """Four digits; longer texts keep their first four."""
    return F.lpad(F.replace(value.cast("string"), F.lit(":"), F.lit("")), 4, "0")


# Any text that has not this form becomes one that is no time. One expression of
# one call: it is repeated wherever a filter on a time is moved to the scan.
_COMPACT = r"(?s)^(?:(\d{4})(\d{2})(\d{2}) ?(\d{2})(\d{2})|.*)$"
_ISO = "$1-$2-$3 $4:$5:00"


def compact_clock(text: Column) -> Column:
    """``yyyyMMddHHmm`` text to a wall-clock time; null when malformed."""
    return F.regexp_replace(text, _COMPACT, _ISO).try_cast("timestamp_ntz")


def forecast_clock(date: Column, time: Column) -> Column:
    """``yyyyMMdd`` and ``HHmm`` to a wall-clock time; null when either is malformed."""
    return compact_clock(F.concat(date, F.lit(" "), time))


def any_clock(text: Column) -> Column:
    """``yyyyMMddHHmm`` text, or else any date-time text Spark can read."""
    compact = r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})$"
    return F.regexp_replace(text, compact, _ISO).try_cast("timestamp_ntz")


def on_axis(clock: Column) -> Column:
    """A wall-clock time as a point on a zone-free axis, of the type watermarks need."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", origin, clock))


def zoned_instant(clock: Column, zone: str = ZONE) -> Column:
    """The absolute time at which the given zone's clock shows ``clock``.

    Right under any session zone. A time skipped by a clock change moves
    forward; of one that occurs twice it is the first.
    """
    return F.to_utc_timestamp(on_axis(clock), zone)


def floor_hour(clock: Column) -> Column:
    return F.make_timestamp_ntz(
        F.year(clock), F.month(clock), F.dayofmonth(clock), F.hour(clock), F.lit(0), F.lit(0)
    )


def floor_minute(clock: Column) -> Column:
    return F.make_timestamp_ntz(
        F.year(clock), F.month(clock), F.dayofmonth(clock), F.hour(clock), F.minute(clock), F.lit(0)
    )


def plus_hours(clock: Column, hours: Column | int) -> Column:
    return F.timestamp_add("HOUR", F.lit(hours) if isinstance(hours, int) else hours, clock)


def plus_minutes(clock: Column, minutes: int) -> Column:
    return F.timestamp_add("MINUTE", F.lit(minutes), clock)


def epoch_seconds(clock: Column) -> Column:
    """Seconds on the wall clock's own axis, for arithmetic between two times."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", origin, clock) / 1e6


def run_hour(clock: Column) -> Column:
    """The run a wall-clock time belongs to, ``yyyyMMddHH``."""
    return F.date_format(clock, "yyyyMMddHH")


def now_clock(zone: str = ZONE) -> Column:
    return F.convert_timezone(
        F.lit("UTC"), F.lit(zone), F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")
    )


def hour_steps(start: Column, end: Column) -> Column:
    """Array of the hours from ``start`` to ``end``."""
    return F.sequence(start, end, F.expr("INTERVAL 1 HOUR"))


def issue_time(
    now: Column,
    hours: Sequence[int] = ISSUE_HOURS,
    buffer_minutes: int = ISSUE_BUFFER_MINUTES,
) -> Column:
    """Newest issue that is at least ``buffer_minutes`` old at ``now``."""
    cutoff = plus_minutes(floor_minute(now), -buffer_minutes)
    midnight = F.make_timestamp_ntz(
        F.year(now), F.month(now), F.dayofmonth(now), F.lit(0), F.lit(0), F.lit(0)
    )
    issues = F.array(*[plus_hours(midnight, h + d) for d in (-24, 0) for h in hours])
    return F.array_max(F.filter(issues, lambda issue: issue <= cutoff))


def nowcast_base(now: Column) -> Column:
    """Newest nowcast hour published at ``now``."""
    return floor_hour(plus_minutes(now, -NOWCAST_PUBLISH_MINUTE))


def forecast_base(now: Column) -> Column:
    """Newest half-hour forecast published at ``now``."""
    return plus_minutes(floor_hour(plus_minutes(now, -FORECAST_PUBLISH_MINUTE)), FORECAST_MINUTE)
