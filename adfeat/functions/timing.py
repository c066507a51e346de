"""Partition hours and epochs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

HOUR_FORMAT = "yyyyMMddHH"


def hour_of(ts: Column | str) -> Column:
    """``yyyyMMddHH`` partition value of a timestamp."""
    return F.date_format(ts, HOUR_FORMAT)


def shift_hour(hour: Column | str, hours: int) -> Column:
    """Partition hour ``hours`` later."""
    ts = F.to_timestamp(hour, HOUR_FORMAT)
    return F.date_format(ts + F.make_dt_interval(hours=F.lit(hours)), HOUR_FORMAT)


def epoch_seconds(ts: Column | str) -> Column:
    """Seconds since 1970 of a wall-clock value read as UTC, whatever the session time zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def local_day_hours(now: dt.datetime, offset_hours: int = 8) -> tuple[str, str]:
    """Half-open UTC hour range of the calendar day that ``now`` (UTC) falls on at ``offset_hours``."""
    day = (now + dt.timedelta(hours=offset_hours)).replace(hour=0, minute=0, second=0, microsecond=0)
    start = day - dt.timedelta(hours=offset_hours)
    return start.strftime("%Y%m%d%H"), (start + dt.timedelta(hours=24)).strftime("%Y%m%d%H")


def shifted_partition(out_hour: str, hours: int = 8, layout: str = "datepart=%Y%m%d/hour=%H") -> str:
    """Directory of the raw log that feeds output hour ``out_hour`` (logs are named ``hours`` ahead)."""
    return (dt.datetime.strptime(out_hour, "%Y%m%d%H") + dt.timedelta(hours=hours)).strftime(layout)
