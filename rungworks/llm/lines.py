"""Removal of lines that many sites share.

The spread of a line is the number of distinct sites it occurs on.  A HyperLogLog sketch
per line hash counts it: tasks sketch what they read, and the sketches merge in the
aggregation, so a line that a third of all documents holds moves as one sketch a task.  Where an
estimate is too near the threshold to tell, the distinct sites are counted exactly.

Everything is built-in column code.  Lines are compared with their white space collapsed
and trimmed, by a 128-bit hash.  Defined results: null texts stay null and have no lines;
lines without a word are never removed; a null site counts for no line; the removed
lines of a text leave no empty line; repeated rows are treated alike and count as what they are;
empty tables give empty tables; other columns pass through, and a column that has the name
of a result is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rungworks.llm.common import collapsed, free_name
from rungworks.session import stage

#: Sites on which a line must occur to be boilerplate.
MIN_SITES = 10
#: Size of a sketch (2 ** LG_K places; relative error 1.04 / 2 ** (LG_K / 2)), and how near
#: to the threshold, in parts of it, an estimate is not trusted: six errors.
LG_K = 12
NEAR = 0.1

RESULTS = ("n_lines", "n_removed")


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    return F.trim(collapsed(line))


def _occurrences(df: DataFrame, text: str, **more: Column) -> DataFrame:
    """One row per line with a word: its place ``pos``, its hash ``a, b``, and ``more`` of its row.

    What is told of the row is worked out before its lines are exploded, once and not per line.
    """
    rows = df.select(F.col(text).alias("whole text"), *[c.alias(name) for name, c in more.items()])
    lines = rows.select(*more, F.posexplode(F.transform(_lines(F.col("whole text")), _key)).alias("pos", "line")).where("line <> ''")
    return lines.withColumns({"a": F.xxhash64("line"), "b": F.xxhash64(F.lit(1), "line")}).drop("line")


def spread(df: DataFrame, text: str = "text", site: str = "source", lg_k: int = LG_K) -> DataFrame:
    """``a, b, sites``: the estimated number of sites of every line."""
    found = _occurrences(df, text, site=F.col(site).cast("string"))
    return found.groupBy("a", "b").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"))


def boilerplate(df: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES, lg_k: int = LG_K, near: float = NEAR) -> DataFrame:
    """``a, b`` of the lines that occur on ``min_sites`` sites or more."""
    slack = max(1.0, near * min_sites)
    candidates = spread(df, text, site, lg_k).where(F.col("sites") >= min_sites - slack)
    sure = candidates.where(F.col("sites") > min_sites + slack).select("a", "b")
    close = candidates.where(F.col("sites") <= min_sites + slack).select("a", "b")
    each = _occurrences(df, text, site=F.col(site).cast("string")).where("site IS NOT NULL").join(close, ["a", "b"], "left_semi")
    counted = each.groupBy("a", "b", "site").agg(F.lit(1)).groupBy("a", "b").agg(F.count("*").alias("sites"))
    return sure.unionByName(counted.where(F.col("sites") >= min_sites).select("a", "b"))


def remove_boilerplate(df: DataFrame, text: str = "text", site: str = "source", doc_id: str = "doc_id", **options: object) -> DataFrame:
    """``df`` with the shared lines taken out of the text, ``n_lines`` (with a word) and ``n_removed``."""
    base = df.drop(*RESULTS)
    x, y, bad, lines, keep = free_name(base, "_x", "_y", "_bad", "_lines", "_keep")
    # A row is known by the hash of its id and text: what is removed from it depends on no more.
    rows = F.xxhash64(doc_id, text), F.xxhash64(F.lit(1), text, doc_id)
    # Staged, so that it is joined by its size, and the rows of a line that a third of them hold can be split.
    shared = stage(boilerplate(df, text, site, **options), "lines-shared")  # type: ignore[arg-type]
    places = _occurrences(df, text, **{x: rows[0], y: rows[1]}).join(shared, ["a", "b"], "left_semi").groupBy(x, y).agg(F.collect_set("pos").alias(bad))
    met = base.withColumns({x: rows[0], y: rows[1]}).join(places, [x, y], "left")
    cut = met.withColumn(lines, _lines(F.col(text))).withColumn(keep, F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce(bad, F.array().cast("array<int>"))))
    kept = F.when(F.col(bad).isNull(), F.col(text)).otherwise(F.array_join(F.transform(keep, lambda i: F.get(F.col(lines), i)), "\n"))
    n_lines = F.coalesce(F.size(F.filter(lines, lambda line: _key(line) != "")), F.lit(0))
    counted = cut.withColumns({"n_lines": F.when(F.col(text).isNull(), 0).otherwise(n_lines).cast("long"), "n_removed": F.coalesce(F.size(bad), F.lit(0)).cast("long"), text: kept})
    return counted.select(*[text if c == text else c for c in base.columns], *RESULTS)
