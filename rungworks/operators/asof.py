"""Latest earlier evidence within a tolerance (backward as-of lookup).

A range join would emit every (probe, evidence) pair inside the tolerance before
keeping one.  Here both sides are laid on one time line per key and the last
evidence before each probe is read off it, which is linear; whether it is recent
enough is checked at the end.

The time line of a key is cut into slices, the unit of work.  A slice is as long as
the tolerance, so evidence is also placed in the next slice.  Rows of one instant
are merged before the shuffle, so a slice holds at most one row per instant.  Keys
that are dense even then (a third of all rows, at microsecond times) get short
slices, of which only the last evidence is handed on to those within reach.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rungworks.functions.scalars import micros

SHORT_SLICE = timedelta(minutes=1)


def asof_lookup(
    probes: DataFrame,
    evidence: DataFrame,
    *,
    key: str,
    probe_ts: str,
    evidence_ts: str,
    value: str,
    tolerance: timedelta,
    dense_keys: DataFrame | None = None,
    short_slice: timedelta = SHORT_SLICE,
) -> DataFrame:
    """For each distinct (key, probe time): the newest ``value`` strictly before it.

    Evidence exactly ``tolerance`` old counts, older does not.  Of several values at
    one instant the greatest is taken.  Probes without evidence give no row.
    Result columns: ``key``, ``probe_ts``, ``value``, ``evidence_ts`` (the evidence's time).

    ``dense_keys`` (a column named as ``key``, see ``hotkeys.heavy_keys``) and
    ``short_slice`` only affect how the work is cut.
    """
    microsecond = timedelta(microseconds=1)
    length = tolerance // microsecond
    short = min(short_slice // microsecond, length)
    width = F.when(F.col("_dense"), F.lit(short)).otherwise(F.lit(length))

    def sliced(df: DataFrame) -> DataFrame:
        if dense_keys is None:
            told = df.withColumn("_dense", F.lit(False))
        else:
            named = dense_keys.select(F.col(key).alias("_key"), F.lit(True).alias("_dense"))
            told = df.join(named, "_key", "left").withColumn("_dense", F.coalesce("_dense", F.lit(False)))
        placed = told.withColumn("_at", micros(F.col("_ts"))).withColumn("_width", width)
        return placed.withColumn("_slice", F.expr("(_at - pmod(_at, _width)) div _width"))

    asked = sliced(
        probes.where(F.col(key).isNotNull() & F.col(probe_ts).isNotNull()).select(
            F.col(key).alias("_key"), F.col(probe_ts).alias("_ts")
        )
    ).select("_key", "_slice", "_at", "_ts", F.lit(True).alias("_asked"))
    known = sliced(
        evidence.where(
            F.col(key).isNotNull() & F.col(evidence_ts).isNotNull() & F.col(value).isNotNull()
        ).select(
            F.col(key).alias("_key"), F.col(evidence_ts).alias("_ts"), F.col(value).alias("_value")
        )
    ).select("_key", "_slice", "_at", "_ts", "_value", "_dense")

    places = F.when(F.col("_dense"), F.array("_slice")).otherwise(F.array("_slice", F.col("_slice") + 1))
    rows = asked.unionByName(
        known.withColumn("_slice", F.explode(places)).drop("_dense"), allowMissingColumns=True
    )
    if dense_keys is not None:
        reach = -(-length // short)
        handed_on = (
            known.where("_dense")
            .groupBy("_key", "_slice")
            .agg(F.max(F.struct("_at", "_ts", "_value")).alias("_last"))
            .select(
                "_key",
                F.explode(F.sequence(F.col("_slice") + 1, F.col("_slice") + reach)).alias("_slice"),
                "_last.*",
            )
        )
        rows = rows.unionByName(handed_on, allowMissingColumns=True)

    line = rows.groupBy("_key", "_slice", "_at", "_ts").agg(
        F.max("_value").alias("_value"), F.max("_asked").alias("_asked")
    )
    earlier = (
        Window.partitionBy("_key", "_slice")
        .orderBy("_at")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    found = F.when(F.col("_value").isNotNull(), F.struct("_at", "_ts", "_value"))
    return (
        line.withColumn("_hit", F.last(found, ignorenulls=True).over(earlier))
        .where(F.col("_asked") & (F.col("_at") - F.col("_hit._at") <= length))
        .select(
            F.col("_key").alias(key),
            F.col("_ts").alias(probe_ts),
            F.col("_hit._value").alias(value),
            F.col("_hit._ts").alias("evidence_ts"),
        )
    )
