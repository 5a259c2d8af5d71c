"""Bloom filters of the keys of each day, kept as a small table.

A load asks them which days may hold one of its keys, and opens only those.  They err to one
side: a key that is held is always reported, one that is not in about one of a thousand cases.

A filter is cut into blocks of eight 32-bit lanes.  A key belongs to one block and sets one bit
in each lane, so building is one ``bit_or`` by block, which combines before the shuffle, and
asking is one equi-join by block.  A day's filter has as many blocks as its keys need; filters of
several loads of a day stand side by side, and those of equal size are as good as one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rungworks.schemas import Table

LANES = 8
LANE_BITS = 32
BITS_PER_KEY = 16
_NAMES = [f"lane{i}" for i in range(LANES)]
_PLACE = ["day", "blocks", "block"]

FILTERS = Table(
    "keys", ", ".join(["day DATE", "blocks BIGINT", "block BIGINT", *[f"{n} INT" for n in _NAMES]]), (), ()
)


def _hashed(rows: DataFrame, time: str, keys: Sequence[str]) -> DataFrame:
    """The keys with their day, the number that places them, and the bits they set."""
    bits = F.xxhash64(F.lit("bits"), *keys)
    lane = [
        F.call_function("shiftleft", F.lit(1), F.shiftrightunsigned(bits, 5 * i).bitwiseAND(LANE_BITS - 1).cast("int"))
        for i in range(LANES)
    ]
    return rows.select(
        *[F.col(k).alias(f"key_{k}") for k in keys],
        F.to_date(time).alias("day"),
        F.xxhash64(F.lit("block"), *keys).alias("place"),
        *[bit.alias(name) for bit, name in zip(lane, _NAMES, strict=True)],
    )


def build(rows: DataFrame, time: str, keys: Sequence[str]) -> DataFrame:
    """Filters of the keys of ``rows``, by the day of ``time``.  Rows without a day are in none."""
    hashed = _hashed(rows, time, keys).where(F.col("day").isNotNull())
    blocks = F.ceil(F.count("*") * BITS_PER_KEY / (LANES * LANE_BITS)).cast("long")
    sized = hashed.join(hashed.groupBy("day").agg(blocks.alias("blocks")), "day")
    by_block = sized.groupBy("day", "blocks", F.pmod("place", "blocks").alias("block"))
    return by_block.agg(*[F.bit_or(n).alias(n) for n in _NAMES])


def possibly_held(rows: DataFrame, filters: DataFrame, time: str, keys: Sequence[str]) -> DataFrame:
    """``day`` and keys of the rows whose key some filter of their day reports, each once."""
    sizes = filters.select("day", "blocks").distinct()
    asked = _hashed(rows, time, keys).join(sizes, "day").withColumn("block", F.pmod("place", "blocks"))

    def shared(name: str) -> Column:
        return F.col(f"a.{name}").bitwiseAND(F.col(f"f.{name}")) != 0

    same = [F.col(f"a.{c}") == F.col(f"f.{c}") for c in _PLACE]
    found = asked.alias("a").join(filters.alias("f"), [*same, *[shared(n) for n in _NAMES]], "left_semi")
    return found.select("day", *[F.col(f"key_{k}").alias(k) for k in keys]).distinct()
