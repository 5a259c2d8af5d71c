"""Metadata carried by a document's file name.

Two namings occur: ``{kind}_{league}_{yyyy-MM-dd}_{HHmm}.json`` and the older one
without the league.  All functions accept a bare name or a whole path, and give
null (or the default league) for a name that follows neither.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The league meant by the older naming, and the stamp's format.
DEFAULT_LEAGUE = 4
STAMP_FORMAT = "yyyy-MM-dd_HHmm"

_DAY = r"\d{4}-\d{2}-\d{2}"
_END = r"(?:\.json)?$"
_TAIL = rf"_{_DAY}_\d{{4}}{_END}"


def _part(name: Column | str, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(name, pattern, group), F.lit(""))


def base_name(path: Column | str) -> Column:
    return _part(path, r"([^/]+)$", 1)


def snapshot_ts(name: Column | str) -> Column:
    stamp = _part(name, rf"_({_DAY}_\d{{4}}){_END}", 1)
    return F.to_timestamp_ntz(stamp, F.lit(STAMP_FORMAT))


def snapshot_date(name: Column | str) -> Column:
    return _part(name, rf"_({_DAY})_\d{{4}}{_END}", 1).cast("date")


def league_id(name: Column | str, default: int = DEFAULT_LEAGUE) -> Column:
    digits = _part(name, rf"(?:^|[_/])(\d+){_TAIL}", 1)
    return F.coalesce(digits.cast("int"), F.lit(default))


def kind(name: Column | str) -> Column:
    return _part(name, rf"([^/]+?)(?:_\d+)?{_TAIL}", 1)


def document_name(kind: Column, league: Column | None, ts: Column) -> Column:
    """Compose a document's file name; the inverse of the parsers above."""
    stamp = F.date_format(ts, STAMP_FORMAT)
    parts = [kind, stamp] if league is None else [kind, league.cast("string"), stamp]
    return F.concat(F.concat_ws("_", *parts), F.lit(".json"))
