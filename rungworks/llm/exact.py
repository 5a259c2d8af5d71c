"""Exact deduplication with salted combining.

Rows meet in three steps, and at each the grouping key holds the whole normalised text
beside its digest, so that equal digests of unequal texts never merge:

1. each task merges the copies it has read (map-side half of the first aggregate);
2. copies of one digest meet within one of ``salts`` shares, which bounds what any task
   receives of a text that a third of the corpus repeats;
3. the shares' winners, at most ``salts`` per text, meet.

Only texts whose digest occurs more than once take part.  A count of digests finds them, and
a Bloom filter of those (8 MB at most) drops the others' texts before they are shuffled; what
passes is staged, since a join by digest alone would already have brought all copies of a
digest into one task, and the aggregates would not deal them by share any more.  Rows then look
up the winner of their text; where copies are only dropped, rows that a set of bits (2 MB)
shows to have none are not moved for that.  A digest that stands for one text, as all do in practice, is enough
to look it up; where one stands for several, whole texts are compared again.

Everything is built-in column code.  Defined results: null counts as an empty text, and
empty texts are copies of each other; of equal texts the smallest id stays (a null id only
where all are null); rows repeated with the same id stand for one document and get the same
answer each; empty tables give empty tables; other columns pass through, and a
column that has the name of a result is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rungworks.llm.common import collapsed, free_name
from rungworks.llm.minhash import _prefiltered
from rungworks.session import stage

#: Shares that the copies of one digest are dealt to, and 64-bit words of the set of digests.
SALTS = 64
WORDS = 1 << 18


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _rows(df: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Id and normalised text with its digest, and nothing else."""
    flat = df.select(F.col(doc_id).alias("id"), collapsed(F.col(text)).alias("norm"))
    return flat.select("id", "norm", digest(F.col("norm")).alias("digest"))


def copies(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``id, norm, digest`` of the rows whose digest occurs more than once."""
    rows = _rows(df, text, doc_id)
    repeated = stage(rows.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1"), "exact-digests")
    with _prefiltered(df.sparkSession):  # Spark filters by tables that have a condition
        return stage(rows.join(repeated.where("n > 1").select("digest"), "digest", "left_semi"), "exact-copies")


def groups(held: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per text of ``held`` (:func:`copies`): ``digest, norm, keep_id, group_size``.

    Texts are those of several rows, or of a digest that stands for several texts.
    """
    merged = F.min("id").alias("keep_id"), F.count("*").alias("group_size")
    dealt = held.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    shares = dealt.groupBy("digest", "salt", "norm").agg(*merged)
    return shares.repartition("digest").groupBy("digest", "norm").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def _winners(held: DataFrame, salts: int) -> DataFrame:
    """:func:`groups`, staged; ``norm`` only where the digest stands for several texts."""
    found = groups(held, salts)
    several = F.count("*").over(Window.partitionBy("digest")) > 1
    return stage(found.withColumn("norm", F.when(several, F.col("norm"))), "exact-winners")


def _same(told: DataFrame, key: str, t_key: str, t_norm: str, norm: Column) -> Column:
    """Equal texts: equal digests, and equal ``norm`` where ``told`` has any."""
    equal = F.col(key) == F.col(t_key)
    if told.where(F.col(t_norm).isNotNull()).isEmpty():
        return equal
    return equal & (F.col(t_norm).isNull() | (F.col(t_norm) == norm))


def mark_copies(df: DataFrame, text: str = "text", doc_id: str = "doc_id", salts: int = SALTS) -> DataFrame:
    """``df`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``, a row for each row.

    Rows look up the winner of their text; a crowded digest is an ordinary skewed join of a
    scan and a staged table, whose row side is split at run time.
    """
    results = ("keep_id", "group_size", "kept", "text_sha256")
    base = df.drop(*results)
    key, w_norm, w_key = free_name(base, "digest", "w_norm", "w_digest")
    winners = _winners(copies(base, text, doc_id), salts).select(F.col("digest").alias(w_key), F.col("norm").alias(w_norm), "keep_id", "group_size")
    flat = base.withColumn(key, digest(collapsed(F.col(text))))
    met = flat.join(winners, _same(winners, key, w_key, w_norm, collapsed(F.col(text))), "left")
    alone = F.col("group_size").isNull()
    return met.select(
        *base.columns,
        F.when(alone, F.col(doc_id)).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col(doc_id).eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col(key).alias("text_sha256"),
    )


def _may_be_in(told: DataFrame, key: Column, row_id: Column) -> Column:
    """False only where ``told`` has no row of this digest and id: the digest picks a word, the id a bit of it.

    Where the bits fill up, more rows are taken for copies and the exact join sorts them out.
    """
    word = lambda digest: F.pmod(F.xxhash64(digest), F.lit(WORDS))
    bit = lambda i: F.pmod(F.xxhash64(i), F.lit(64)).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit(F.col("id")))
    held = told.groupBy(word(F.col("digest")).alias("word")).agg(F.bit_or(mask).alias("bits"))
    every = told.sparkSession.range(WORDS).toDF("word").join(held, "word", "left").select("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    bits = every.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).getField("bits").alias("bits")).scalar()
    return F.call_function("shiftrightunsigned", F.get(bits, word(key).cast("int")), bit(row_id)).bitwiseAND(1) == 1


def drop_copies(df: DataFrame, text: str = "text", doc_id: str = "doc_id", salts: int = SALTS) -> DataFrame:
    """One row of each group of equal texts, with the columns it came with.

    The rows that go are named by digest and id, and so are rows repeated with the staying
    row's id, of which one stays.  Rows that are surely not among these stay where they
    are; the others are moved once, by digest and id, which deals the copies of a text
    over all tasks.
    """
    held = copies(df, text, doc_id)
    winners = _winners(held, salts).select(F.col("digest").alias("w_digest"), F.col("norm").alias("w_norm"), "keep_id")
    met = held.join(winners, _same(winners, "digest", "w_digest", "w_norm", F.col("norm")))
    told = met.select("digest", "id", F.col("w_norm").alias("norm"), F.col("id").eqNullSafe(F.col("keep_id")).alias("stays"))
    told = stage(told.groupBy("digest", "id", "norm", "stays").agg(F.count("*").alias("n")).where("NOT stays OR n > 1"), "exact-marks")
    key, norm, t_digest, t_id, t_norm, stays = free_name(df, "digest", "norm", "t_digest", "t_id", "t_norm", "stays")
    marks = told.select(F.col("digest").alias(t_digest), F.col("id").alias(t_id), F.col("norm").alias(t_norm), F.col("stays").alias(stays))
    rows = df.withColumn(key, digest(collapsed(F.col(text))))
    own = F.col(doc_id).eqNullSafe(F.col(t_id)) & _same(marks, key, t_digest, t_norm, collapsed(F.col(text)))
    may_go = _may_be_in(told, F.col(key), F.col(doc_id))
    single = rows.where(~may_go).unionByName(rows.where(may_go).join(marks, own, "left_anti")).select(df.columns)
    if told.where("stays").isEmpty():
        return single
    with_copy = rows.join(marks.where(F.col(stays)), own, "left_semi").withColumn(norm, collapsed(F.col(text)))
    return single.unionByName(with_copy.dropDuplicates([key, doc_id, norm]).select(df.columns))
