"""State kept up to date from the days that changed: newest rows, and distinct ones.

Both are folds: the newest (or the distinct) of what is held and of new rows is that of all rows,
whatever the order they come in; ties are settled by a total order.  So a run reads the state
and the days noted since (:func:`rungworks.sources.tables.note_days`), not the table; a late row is
in a day noted again, and a day read twice changes nothing.  The state is kept as versions, whose
number is that of the last change folded in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from rungworks.operators.latest import latest_per_key
from rungworks.schemas import Table
from rungworks.sources import tables

Rows = Callable[[DataFrame], DataFrame]


def fold(spark: SparkSession, path: str, table: Table, state: str, rows: Rows, combine: Rows) -> DataFrame:
    """``combine`` of ``rows`` of the table, after folding in what has changed; kept below ``state``.

    The first run, and one whose state is lost, reads the whole table.
    """
    known = tables.versions(spark, state)
    changed = tables.changed_days(spark, path, since=known[-1] if known else 0)
    upto = max(changed.values(), default=known[-1] if known else 0)
    fresh = rows(tables.read_table(spark, path, table, sorted(changed) if known else None))
    if known and not changed:
        return _held(spark, state, fresh)
    if known:
        fresh = _held(spark, state, fresh).unionByName(fresh)
    tables.write_version(combine(fresh), state, upto)
    return _held(spark, state, fresh)


def _held(spark: SparkSession, state: str, like: DataFrame) -> DataFrame:
    columns = ", ".join(f"`{name}` {kind}" for name, kind in like.dtypes)
    return tables.read_version(spark, state, Table("folded", columns, (), ()))


def fold_latest(spark: SparkSession, path: str, table: Table, state: str, rows: Rows, keys: Sequence[str], ts: str) -> DataFrame:
    """The newest of ``rows`` per key (see :func:`fold`)."""
    return fold(spark, path, table, state, rows, lambda df: latest_per_key(df, keys, ts))


def fold_distinct(spark: SparkSession, path: str, table: Table, state: str, rows: Rows) -> DataFrame:
    """Each of ``rows`` once (see :func:`fold`).

    Counting these per key counts distinct values without reading old days, exactly and
    whatever the number of values; merged day by day, as a sketch would be.
    """
    return fold(spark, path, table, state, rows, lambda df: df.distinct())
