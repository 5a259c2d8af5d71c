"""Keyed merges as pure functions of (target, incoming).

Both sides of each join are unique in the key - the target by contract, the
incoming rows because they are reduced first - so no key can be hot in a merge.
The reduction itself keeps at most one row of a key per map task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rungworks.operators.latest import first_per_key, total_order

Rule = str | Callable[[str], Column]

# What a merge does to a column when the key is already in the target.
INCOMING = "incoming"
TARGET = "target"
INCOMING_OR_TARGET = "incoming or target"


def old(name: str) -> Column:
    return F.col(f"target.{name}")


def new(name: str) -> Column:
    return F.col(f"incoming.{name}")


def unique_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """The first row of each key under ``order``, or under all columns if none is given."""
    if order is None and set(df.columns) <= set(keys):
        return df.dropDuplicates(list(keys))
    return first_per_key(df, keys, order or total_order(df, [], *keys))


def rows_to_insert(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    drop_if_null: Sequence[str] = (),
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Incoming rows whose key the target lacks, one per key.

    Only the key columns of the target are read.  To keep a large target's scan
    small, pass it filtered to the partitions the incoming keys can fall into.
    """
    if drop_if_null:
        incoming = incoming.dropna(subset=list(drop_if_null))
    candidates = unique_by_key(incoming, keys, order)
    return candidates.join(target.select(*keys), list(keys), "left_anti").select(*incoming.columns)


def insert_if_absent(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    drop_if_null: Sequence[str] = (),
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """The target after the insert: rows already there never change."""
    fresh = rows_to_insert(target, incoming, keys, drop_if_null, order)
    return target.unionByName(fresh, allowMissingColumns=True)


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    rules: Mapping[str, Rule],
    defaults: Mapping[str, Column] | None = None,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """The target after inserting new keys and updating those it holds.

    ``rules`` says per column what happens to a held key: take the incoming value,
    keep the target's, take the incoming value unless null, or compute it from
    :func:`old` and :func:`new`.  Columns without a rule keep the target's value.
    Inserted rows take the incoming values; columns the incoming rows lack are
    filled from ``defaults``.  The target's column types stay.
    """
    defaults = defaults or {}
    left = target.withColumn("_held", F.lit(True)).alias("target")
    right = unique_by_key(incoming, keys, order).withColumn("_came", F.lit(True)).alias("incoming")
    on = [old(k) == new(k) for k in keys]
    joined = left.join(right, on, "full_outer")
    held, came = F.col("_held").isNotNull(), F.col("_came").isNotNull()
    types = {f.name: f.dataType for f in target.schema.fields}

    def value(name: str) -> Column:
        if name in keys:
            return F.coalesce(old(name), new(name))
        inserted = new(name) if name in incoming.columns else defaults.get(name, F.lit(None))
        rule = rules.get(name, TARGET)
        if rule == TARGET:
            updated = old(name)
        elif rule == INCOMING:
            updated = new(name)
        elif rule == INCOMING_OR_TARGET:
            updated = F.coalesce(new(name), old(name))
        else:
            updated = rule(name)
        return F.when(held & came, updated).when(held, old(name)).otherwise(inserted)

    return joined.select(*[value(c).cast(types[c]).alias(c) for c in target.columns])


def remember_previous(
    value: str, element: str, since: Column, history: str
) -> Callable[[str], Column]:
    """Rule for a history column: append the old value, with the date of the change.

    Appended only if the old and the new value are both known and differ.
    """

    def rule(_: str) -> Column:
        entry = F.struct(old(value).alias(element), since.cast("string").alias("since"))
        changed = new(value).isNotNull() & old(value).isNotNull() & (new(value) != old(value))
        return F.when(changed, F.concat(old(history), F.array(entry))).otherwise(old(history))

    return rule


def load_summary(batch: DataFrame, fresh: DataFrame) -> DataFrame:
    """One row: rows processed, rows inserted, rows left out."""
    marks = batch.select(F.lit(1).alias("came"), F.lit(0).alias("went")).unionByName(
        fresh.select(F.lit(0).alias("came"), F.lit(1).alias("went"))
    )
    return marks.agg(
        F.coalesce(F.sum("came"), F.lit(0)).alias("processed"),
        F.coalesce(F.sum("went"), F.lit(0)).alias("inserted"),
        F.coalesce(F.sum(F.col("came") - F.col("went")), F.lit(0)).alias("skipped"),
    )
