"""Time buckets of landed files, as column expressions.  The session's time zone must be UTC.

A *local* time is a ``timestamp`` whose fields read as the provider's wall clock; an *instant* is one in UTC.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP, STAMP_PYTHON = "yyyy-MM-dd_HH-mm-ss", "%Y-%m-%d_%H-%M-%S"


def parse_int(value: Column) -> Column:
    """A whole number, or null where there is none."""
    return F.trim(value.cast("string")).try_cast("bigint")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of an instant; ``timestamp_ntz`` counts as UTC."""
    return F.unix_seconds(ts.cast("timestamp"))


def local_time(instant: Column, zone: str) -> Column:
    """The wall clock of a zone at an instant."""
    return F.from_utc_timestamp(instant.cast("timestamp"), zone)


def instant(local: Column, zone: str) -> Column:
    """The instant of a wall-clock time; one that a change of clocks makes ambiguous is taken as standard time.

    Spark takes the earlier instant; if the clocks show the same time again an hour, or half an hour, later, that one holds.
    """
    early = F.to_utc_timestamp(local.cast("timestamp"), zone)
    out = early
    for minutes in (30, 60):
        later = early + F.expr(f"INTERVAL {minutes} MINUTES")
        out = F.when(F.from_utc_timestamp(later, zone) == local.cast("timestamp"), later).otherwise(out)
    return out


def path_stamp(local: Column) -> Column:
    """A local time as it stands in a landed file's name."""
    return F.date_format(local.cast("timestamp"), STAMP)


def landing_path(provider: Column, service: Column, local: Column) -> Column:
    return F.concat(provider, F.lit("/"), service, F.lit("/individual/"), path_stamp(local), F.lit(".parquet"))


def parse_path(path: Column) -> Column:
    """The local time in a landed file's name, with or without the prefix ``individual_``; null if there is none.

    What follows a ``~`` in the name keeps apart files of one second and is no part of the time.
    """
    name = F.element_at(F.split(path, "/"), -1)
    stamp = F.regexp_replace(F.regexp_replace(F.replace(name, F.lit("individual_"), F.lit("")), r"\.parquet$", ""), "~.*$", "")
    return F.when(stamp.rlike(r"^\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2}$"), F.try_to_timestamp(stamp, F.lit(STAMP)))


def bucket(local: Column, minutes: int) -> Column:
    """The start of a time's bucket: buckets of so many minutes, counted anew from each local midnight."""
    if minutes <= 0:
        raise ValueError("a bucket has a positive number of minutes")
    local = local.cast("timestamp")
    floor = F.floor((F.hour(local) * 60 + F.minute(local)) / minutes) * minutes
    return F.date_trunc("DAY", local) + F.make_dt_interval(F.lit(0), F.lit(0), floor.cast("int"))


def bucket_end(start: Column, minutes: int) -> Column:
    """Nominal end of a bucket, on the same clock: it may pass midnight, and does not follow a change of clocks."""
    return start.cast("timestamp") + F.expr(f"INTERVAL {int(minutes)} MINUTES")


def wall_clock(local: Column) -> Column:
    """A local time as a string that ``datetime.fromisoformat`` reads: no time zone, the session's or the machine's, can move it."""
    return F.date_format(local.cast("timestamp"), "yyyy-MM-dd HH:mm:ss")


def output_path(provider: str, service: str, group_time: datetime, minutes: int, filename_format: str = "{group_time}_to_{next_period}.parquet", time_format: str = "%H-%M-%S") -> str:
    """Where a bucket's rows go, below the storage root."""
    label = filename_format.format(group_time=group_time.strftime(time_format), next_period=(group_time + timedelta(minutes=minutes)).strftime(time_format))
    return f"{provider}/{service}/{group_time:%Y-%m-%d}/{label}"
