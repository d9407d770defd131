"""Timestamp helpers.  All timestamps are TIMESTAMP_NTZ (UTC wall clock)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = dt.datetime(1970, 1, 1)


def ntz(value: dt.datetime | dt.date | str) -> Column:
    """TIMESTAMP_NTZ literal, built from text so no time zone is consulted."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = value.isoformat() + " 00:00:00"
    return F.lit(value).cast("timestamp_ntz")


def micros_since_epoch(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", ntz(_EPOCH), ts)


def timestamp_from_millis(ms: Column) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ, independent of the session time zone."""
    secs = (ms.cast("decimal(20,0)") / F.lit(1000)).cast("decimal(18,3)")
    return ntz(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def minus_micro(ts: Column) -> Column:
    return ts - F.expr("INTERVAL 1 MICROSECOND")


def start_of_day(d: dt.date) -> Column:
    return ntz(d)


def timeline_bucket(ts: Column, hours: int) -> Column:
    """Index of the ``hours``-wide time bucket holding ``ts`` (BIGINT)."""
    return F.floor(F.timestamp_diff("HOUR", ntz(_EPOCH), ts) / F.lit(hours)).cast("bigint")
