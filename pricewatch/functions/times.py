"""Time expressions. Event times are zone-free, so results do not depend on the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two accepted text layouts: plain and ISO-8601 without a zone.
PLAIN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"


def parse_plain(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to a time; anything else becomes null, never an error."""
    return F.when(c.rlike(PLAIN), c.try_cast("timestamp_ntz"))


def parse_iso(c: Column) -> Column:
    return F.when(c.rlike(ISO), c.try_cast("timestamp_ntz"))


def resolve_event_time(ts_text: Column, ts_iso: Column, obs_date: Column, obs_time: Column) -> Column:
    """First of the three ways a message may carry its time that parses."""
    return F.coalesce(
        parse_plain(ts_text),
        parse_iso(ts_iso),
        parse_plain(F.concat_ws(" ", obs_date, obs_time)),
    )


def day_and_hour(obs_date: Column, obs_time: Column) -> tuple[Column, Column]:
    """Reporting day and hour: full time if both parts exist, else the date alone with hour 0,
    else the day ``unknown``."""
    at = parse_plain(F.concat_ws(" ", obs_date, obs_time))
    both = obs_date.isNotNull() & obs_time.isNotNull()
    day = F.when(both, F.date_format(at, "yyyy-MM-dd")).otherwise(F.coalesce(obs_date, F.lit("unknown")))
    return day, F.when(both, F.hour(at)).otherwise(F.lit(0))


def iso_text(c: Column) -> Column:
    """ISO-8601 with microseconds, no zone."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def epoch_seconds(c: Column) -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)


def first_published(published: Column, updated: Column, fallback: Column) -> Column:
    return F.coalesce(published, updated, fallback)
