"""Newest rows per key, on listings as well as on snapshot tables.

All of these are ``row_number() <= n`` filters.  Spark turns those into a group
limit on both sides of the exchange, so every map task sends at most ``n`` rows
of a key, however many of the input's rows the key holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERED = (T.MapType, T.VariantType)


def total_order(df: DataFrame, first: Sequence[Column], *named: str) -> list[Column]:
    """``first``, then every other column ascending, so that no two distinct rows tie."""
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in named and not isinstance(f.dataType, _UNORDERED)
    ]
    return [*first, *[F.col(c).asc_nulls_first() for c in rest]]


def first_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return first_n_per_key(df, keys, order, 1)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[Column] | None = None
) -> DataFrame:
    """The newest row of each key; equal times are settled by ``tiebreak`` or all columns."""
    newest = F.col(ts).desc_nulls_last()
    if tiebreak is None:
        order = total_order(df, [newest], ts, *keys)
    else:
        order = [newest, *tiebreak]
    return first_per_key(df, keys, order)
