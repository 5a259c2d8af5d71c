"""Mixing sources to target weights by Sainte-Lague apportionment.

The words of a source are one stream, cut into blocks of equal length.  Targets say how
many words each source shall give.  Blocks are dealt to the sources by highest quotient
(``target / (2 k + 1)`` for the k-th block), a source's blocks to its shards likewise, so
every shard has a whole number of blocks to give; which blocks these are is chosen by a
seeded permutation.  A source that must give more than it has repeats blocks.

A shard is a seeded share of a source's documents.  A source of n documents has about
sqrt(n) shards of sqrt(n) documents, so neither a window over the shards of one source nor
one over the documents of a shard grows faster than the root of the source, even if that
source is a third of the corpus.  The quotients are not dealt one by one: rounding at the
mean divisor gives all but a few blocks, and only quotients near it are ranked.
The one window over all sources holds a row per source.

Everything is built-in column code.  Defined results: null and empty texts have size 0
and give nothing; null is a source of its own, the last; documents of equal id are
ordered by size; repeated rows are separate documents; empty tables give empty tables; other
columns pass through, and a column that has the name of a result is replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rungworks.llm.common import free_name, words
from rungworks.session import stage

#: Words in a block, weights dealt to the sources in turn, words asked for per word there is,
#: and the most copies a document may have.
BLOCK = 64
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 1
#: Prime beyond any number of blocks in a shard: multiplying by it permutes them.
_STEP = 2654435761

RESULTS = ("size", "source_size", "target", "taken", "pieces")


def _seeded(seed: int, *what: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(w.cast("string"), F.lit("")) for w in what]))


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, size`` and the like, with ``nr`` and ``target``.

    The share of the total is dealt by weight; no source gets more than ``most`` times its
    size, and the excess goes to the others by weight.  The level at which
    ``least(most * size, weight * level)`` spends it all is the greatest of those found by
    taking the sources with the least size per weight as full, one by one.
    """
    by_source = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("nr") % len(weights) + 1).cast("int"))
    numbered = sizes.withColumn("nr", F.row_number().over(by_source) - 1).withColumn("w", weight)
    fullest = W.orderBy(F.col("size") / F.col("w"), "nr")
    before, after = fullest.rowsBetween(W.unboundedPreceding, -1), fullest.rowsBetween(0, W.unboundedFollowing)
    spent = F.lit(share) * F.sum("size").over(W.partitionBy()) - F.coalesce(F.sum(F.lit(most) * F.col("size")).over(before), F.lit(0))
    level = F.max(F.col("level")).over(W.partitionBy())
    return (
        numbered.withColumn("level", spent / F.sum("w").over(after))
        .withColumn("target", F.least((F.lit(most) * F.col("size")).cast("double"), F.col("w") * level))
        .drop("w", "level")
    )


def sainte_lague(items: DataFrame, group: Sequence[str], item: str, target: str, total: str) -> DataFrame:
    """``group, item, seats``: ``total`` seats of each group by the highest ``target / (2 k + 1)``.

    Of equal quotients the smaller item's comes first.  Rounding ``target`` by the mean price of a
    seat misses the total by at most half a seat an item; a shift that mends this moves an
    item by no more than its share of (shortfall + items) and one, so these quotients are
    ranked and no others.
    """
    over = W.partitionBy(*group)
    t, n = F.col(target), F.col(total)
    all_of_it, among = F.sum(t).over(over), F.count("*").over(over)
    near = F.when(F.col("_sum") > 0, F.floor(t * n / F.col("_sum") + 0.5)).otherwise(0).cast("long")
    slack = F.ceil((F.abs(n - F.col("_near_sum")) + F.col("_among")) * t / F.col("_sum")).cast("long") + 1
    ranged = (
        items.select(*group, item, target, total)
        .withColumns({"_sum": all_of_it.cast("double"), "_among": among})
        .withColumn("_near", near)
        .withColumn("_near_sum", F.sum("_near").over(over))
        .where((t > 0) & (n > 0))
        .withColumn("_slack", slack)
        .withColumn("_base", F.greatest(F.col("_near") - F.col("_slack"), F.lit(0)))
        .withColumn("_open", n - F.sum("_base").over(over))
    )
    quotients = ranged.withColumn("_k", F.explode(F.sequence("_base", F.col("_near") + F.col("_slack")))).withColumn("_q", t / (2 * F.col("_k") + 1))
    rank = F.row_number().over(over.orderBy(F.desc("_q"), item, "_k"))
    won = F.sum((F.col("_rank") <= F.col("_open")).cast("long"))
    return quotients.withColumn("_rank", rank).groupBy(*group, item).agg((F.first("_base") + won).alias("seats"))


def _sources(documents: DataFrame, block: int, weights: Sequence[float], share: float, most: int, seed: int) -> DataFrame:
    """One row per source: its number and target, its number of shards, and the blocks it gives."""
    sizes = documents.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs"))
    sources = targets(sizes, weights, share, most).withColumn("all", F.lit(0)).withColumn("blocks", F.floor(F.sum("target").over(W.partitionBy()) / block + 0.5))
    dealt = sainte_lague(sources, ["all"], "nr", "target", "blocks").select("nr", F.col("seats").alias("dealt"))
    sources = sources.join(dealt, "nr", "left").select(
        "source", "nr", "target", F.col("size").alias("source_size"), F.ceil(F.sqrt("docs")).cast("long").alias("shards"),
        F.least(F.coalesce("dealt", F.lit(0)), most * F.ceil(F.col("size") / block)).alias("quota"),
    )
    return sources


def mix(df: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", block: int = BLOCK, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """``df`` with ``size``, ``source_size``, ``target``, ``taken`` and ``pieces``.

    ``pieces`` lists ``(first, last, times)``: the words from ``first`` up to, without,
    ``last`` go into the mix ``times`` times.  ``taken`` counts the words, repeats included.
    """
    names = df.drop(*RESULTS).columns
    own = {name: f"own{i}" for i, name in enumerate(names)}  # names that no column made here has
    base = df.select(*names).toDF(*own.values())
    text, source, doc_id = own[text], own[source], own[doc_id]
    size, h, s, nr, shard = "_size", "_hash", "_source", "_nr", "_shard"
    hashed = base.withColumns({size: F.size(words(F.col(text))).cast("long"), h: _seeded(seed, F.col(doc_id)), s: F.col(source)})
    narrow = hashed.select(F.col(size).alias("size"), F.col(h).alias("h"), F.col(s).alias("source"))
    # staged, so that Spark knows beforehand how small it is: else texts would be moved for the join by source, too
    sources = stage(_sources(narrow, block, weights, share, most, seed), "mixing-sources")
    place = F.pmod(_number(F.col("h")), F.col("shards")).alias("shard")

    with_nr = narrow.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select("nr", place, "d.size", "quota")
    per_shard = with_nr.groupBy("nr", "shard").agg(F.sum("size").alias("words"), F.first("quota").alias("quota"))
    in_source = W.partitionBy("nr").orderBy("shard")
    end = F.sum("words").over(in_source)
    first_block = F.ceil(F.col("start") / block).cast("long")
    laid = (
        per_shard.withColumn("start", end - F.col("words"))
        .withColumn("first", first_block)
        .withColumn("blocks", F.ceil((F.col("start") + F.col("words")) / block).cast("long") - F.col("first"))
    )
    seats = sainte_lague(laid, ["nr"], "shard", "blocks", "quota")
    given = F.least(F.coalesce("seats", F.lit(0)), most * F.col("blocks"))
    some = F.greatest("blocks", F.lit(1))
    quotas = (
        laid.join(seats, ["nr", "shard"], "left")
        .withColumns({"whole": F.expr(f"least(coalesce(seats, 0), {most} * blocks) div greatest(blocks, 1)"), "rest": given % some, "turn": F.pmod(_number(_seeded(seed, F.col("nr"), F.col("shard"))), some)})
        .withColumn("last_times", F.when(F.col("blocks") > 0, _times(F.col("first") + F.col("blocks") - 1)))
        .withColumn("carried", F.coalesce(F.last("last_times", ignorenulls=True).over(in_source.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .select(F.col("nr").alias("q_nr"), F.col("shard").alias("q_shard"), "start", "first", "blocks", "whole", "rest", "turn", "carried")
    )

    told = sources.select(F.col("source").alias("s_source"), F.col("nr").alias(nr), F.col("shards").alias("s_shards"), "source_size", "target")
    placed = hashed.join(told, hashed[s].eqNullSafe(F.col("s_source"))).withColumn(shard, F.pmod(_number(F.col(h)), F.col("s_shards")))
    in_shard = W.partitionBy(nr, shard).orderBy(h, doc_id, size).rowsBetween(W.unboundedPreceding, -1)
    a, b = F.col("start") + F.col("before"), F.col("start") + F.col("before") + F.col(size)
    covers = F.sequence(F.floor(a / block), F.floor((b - 1) / block))
    piece = lambda j: F.struct((F.greatest(a, j * block) - a).alias("first"), (F.least(b, (j + 1) * block) - a).alias("last"), F.when(j < F.col("first"), F.col("carried")).otherwise(_times(j)).cast("int").alias("times"))
    cut = F.when(F.col(size) > 0, F.filter(F.transform(covers, piece), lambda p: p["times"] > 0)).otherwise(F.array().cast("array<struct<first:bigint,last:bigint,times:int>>"))
    return (
        placed.withColumn("before", F.coalesce(F.sum(size).over(in_shard), F.lit(0)))
        .join(quotas, (F.col(nr) == F.col("q_nr")) & (F.col(shard) == F.col("q_shard")))
        .withColumn("pieces", cut)
        .withColumn("taken", F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + (p["last"] - p["first"]) * p["times"]))
        .select(*[F.col(to).alias(name) for name, to in own.items()], F.col(size).alias("size"), "source_size", "target", "taken", "pieces")
    )


def _times(j: Column) -> Column:
    """How often the shard gives its block ``j``: in every whole pass, and if the seed's turn takes it."""
    turn = F.pmod((j - F.col("first")) * F.lit(_STEP) + F.col("turn"), F.greatest(F.col("blocks"), F.lit(1)))
    return F.col("whole") + (turn < F.col("rest")).cast("long")


def mixture(df: DataFrame, text: str = "text", n_chars: str | None = "n_chars", **options: object) -> DataFrame:
    """The mix itself, with the columns of ``df``: a row for each copy of what a document gives.

    The first copy has all words taken at least once, the second those taken twice.  A text
    taken whole is left as it is; else the white space before each word taken stays.
    """
    copy, parts, taken = free_name(df, "_copy", "_parts", "_taken")
    mixed = mix(df, text=text, **options).where("taken > 0")  # type: ignore[arg-type]
    copies = mixed.withColumn(copy, F.explode(F.sequence(F.lit(1), F.array_max(F.transform("pieces", lambda p: p["times"])))))
    chosen = F.filter("pieces", lambda p: p["times"] >= F.col(copy))
    n_taken = F.aggregate(chosen, F.lit(0).cast("long"), lambda n, p: n + p["last"] - p["first"])
    pieces = F.transform(chosen, lambda p: F.array_join(F.slice(F.col(parts), (p["first"] + 1).cast("int"), (p["last"] - p["first"]).cast("int")), ""))
    out = copies.withColumn(taken, n_taken).withColumn(parts, F.when(F.col(taken) < F.col("size"), F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))))
    out = out.withColumn(text, F.when(F.col(taken) < F.col("size"), F.array_join(pieces, "")).otherwise(F.col(text)))
    if n_chars and n_chars in df.columns:
        out = out.withColumn(n_chars, F.length(text).cast(dict(df.dtypes)[n_chars]))
    return out.select(df.columns)
