"""Finding the few keys that hold a large share of the rows, by exact counts.

The counts are combined before they are shuffled, and only keys above the limit are
kept: at most rows / limit of them, however skewed the data are.  They are staged as a small
table that Spark joins by its measured size; nothing of it reaches the driver or the plan.
They decide where rows are *placed*, never what comes out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rungworks.session import stage

#: Rows of a key from which its work is cut finer, and pairs that one task is to form.
CROWDED = 5_000
PAIRS_PER_PART = CROWDED**2


def heavy_keys(df: DataFrame, key: str, rows: int = 10_000_000) -> DataFrame:
    """The keys (a column of that name) that hold more than ``rows`` rows."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
    return stage(counted.where(F.col("_rows") > rows).select(key), "heavy-keys")


def parts(rows: Column, pairs_per_part: int = PAIRS_PER_PART) -> Column:
    """Into how many parts a group of ``rows`` rows is cut to be paired within itself."""
    return F.greatest(F.ceil(rows * rows / pairs_per_part), F.lit(1)).cast("long")
