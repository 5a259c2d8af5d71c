"""Small scalar rules shared by the flatteners and the analytic tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def moment(as_of: datetime | str) -> Column:
    """The moment a job runs for, as a zone-less timestamp literal."""
    text = as_of if isinstance(as_of, str) else as_of.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def whole(value: Column, dtype: str = "bigint") -> Column:
    """Exact whole number from text: ``7`` and ``7.0`` pass, ``7.5`` and ``x`` raise."""
    return F.when(value.endswith(".0"), F.substring_index(value, ".", 1)).otherwise(value).cast(dtype)


def epoch_seconds_to_ntz(seconds: Column) -> Column:
    """UTC wall time of an epoch value; a missing or zero value gives null.

    Interval arithmetic on zone-less timestamps, so the session time zone has no say.
    """
    given = F.nullif(seconds, F.lit(0))
    return F.expr(_EPOCH) + F.make_dt_interval(secs=given)


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone.

    ``timestampdiff`` would go through the session's zone and its daylight saving.
    """
    seconds = (ts - F.expr(_EPOCH)).cast("interval second").cast("decimal(24,6)")
    return (seconds * 1_000_000).cast("bigint")


def truthy_number(value: Column) -> Column:
    return F.coalesce(value != 0, F.lit(False))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def since_days(ts: Column, as_of: datetime | str, days: int) -> Column:
    """True from ``days`` before the moment ``as_of`` on; folds to one literal bound."""
    return ts >= moment(as_of) - F.make_dt_interval(days=F.lit(days))


def since_days_date(day: Column, as_of: datetime | str, days: int) -> Column:
    """The same for a date column, counted from the day of ``as_of``."""
    return day >= F.date_sub(moment(as_of).cast("date"), days)


def match_key(p1: Column, p2: Column, match_date: Column, map_name: Column, sep: str = "") -> Column:
    """Surrogate id of a match: md5 over both players, the time and the map as text.

    Without a separator, ids ``12, 3`` and ``1, 23`` meet in one key; that is the
    default because existing ids were made so.  Null if the map is null.
    """
    second = F.coalesce(p2.cast("string"), F.lit(""))
    parts = [p1.cast("string"), second, match_date.cast("string"), map_name]
    if sep:
        parts = [x for p in parts for x in (p, F.lit(sep))][:-1]
    return F.md5(F.concat(*parts))
