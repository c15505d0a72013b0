"""Zone-free time: every job takes an explicit ``as_of`` and never reads the clock."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

from reachmart.functions.text import stripped

Instant = datetime | str


def as_datetime(value: Instant) -> datetime:
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment


def days_before(value: Instant, days: int) -> datetime:
    return as_datetime(value) - timedelta(days=days)


def instant(value: Instant) -> Column:
    """A TIMESTAMP_NTZ literal."""
    return F.lit(as_datetime(value).isoformat(sep=" ")).cast("timestamp_ntz")


def since(ts: Column, as_of: Instant, days: int) -> Column:
    """Inside the trailing window: inclusive lower bound, no upper bound."""
    return ts >= instant(days_before(as_of, days))


def monday(ts: Column) -> Column:
    """The day on which the week begins."""
    day = ts.cast("date")
    return F.date_sub(day, F.weekday(day))


def week_start(ts: Column) -> Column:
    """Monday 00:00 of the week. Goes through DATE, so no session time zone takes part."""
    return monday(ts).cast("timestamp_ntz")


def timestamp_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, with six fraction digits when there is a fraction."""
    text = ts.cast("string")
    return F.when(F.contains(text, F.lit(".")), F.rpad(text, 26, "0")).otherwise(text)


def parsed_day(text: Column) -> Column:
    """Day text in ISO or month-first form to ``yyyy-MM-dd``; anything else is null."""
    value = stripped(text)
    day = F.coalesce(
        value.try_cast("timestamp_ntz").cast("date"),
        *[F.try_to_date(value, pattern) for pattern in DAY_PATTERNS],
    )
    return F.date_format(day, "yyyy-MM-dd")


# The accepted day forms besides ISO.
DAY_PATTERNS = ["M/d/yyyy", "M/d/yyyy H:mm:ss", "yyyy/M/d", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy"]
