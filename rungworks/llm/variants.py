"""Spelling variants: words one edit apart, found by pivotal bigrams.

All bigrams are put in one order, rare ones first.  The *prefix* of a word is its three
first bigrams in that order, with all occurrences of the last of them; the *pivots* are two
disjoint bigrams of the prefix of least total frequency, chosen by dynamic programming.  Of two words
one edit apart, take the one whose prefix ends earlier in the order: the edit
leaves at least one of its two disjoint pivots alone, and that bigram, being early enough, is in
the prefix of the other word too.  Its place is the same from the start if the edit
lies behind it, and the same from the end if the edit lies before it.  So the index key of a
bigram is a hash of the text from the word's start through the bigram, or from the bigram to
the word's end, which fixes gram, place and unedited side at once; pivots are joined to
prefixes by it, and the edit distance is verified inside the join.  Nothing is missed and no key is capped.

Words, their counts and pairs stay rows.  What reaches the driver is the frequency of bigrams in
``BUCKETS`` hash buckets at most: any order of the bigrams gives the same result, so
buckets only change speed.  A word has at most some hundreds of words one edit away per letter of
the alphabet, so no word gathers pairs without bound; crowded keys are ordinary skewed joins of two
plain shuffles, which are split at run time.

Null texts have no words; words that are equal count together; repeated rows count as often as
they occur; a null id is the empty text in the hash that picks words to damage.  Empty tables
give empty results.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rungworks.llm.common import ship
from rungworks.session import stage

#: Letters of a word: fixed by the contract of the query.
LETTERS = "A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BUCKETS = 1 << 16
#: Letters up to which a word travels with its index keys.
LONG = 64
_SPREAD = 8191
_PRIME, _BASE = (1 << 61) - 1, 1_000_003_579


def runs(df: DataFrame, text: str = "text", least_length: int = 6) -> DataFrame:
    """Each run of letters of each text as a row, ``run``, with A-Z as a-z; shorter runs are left out."""
    found = F.regexp_extract_all(F.translate(F.col(text), _UPPER, _LOWER), F.lit(f"([{LETTERS}]+)"), F.lit(1))
    return df.withColumn("run", F.explode(found)).where(F.length("run") >= least_length)


def misspell(found: DataFrame, doc_id: str = "doc_id", divisor: int = 199) -> DataFrame:
    """``word``: the run, less one letter where ``divisor`` divides the hash of id and run.

    The hash also says which letter goes, so that the same document always
    misspells the same run alike.
    """
    key = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), "run")
    hashed = found.select("run", F.crc32(key.cast("binary")).alias("h"))
    place = F.expr("cast(h % length(run) AS int)")
    damaged = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % divisor == 0, damaged).otherwise(F.col("run")).alias("word"))


def vocabulary(found: DataFrame, least_length: int = 6, least_count: int = 5) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    counted = found.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


def _ranks(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of each bucket of bigrams: its place in the order, and in how many words it occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.int32).astype(np.int64)
            owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
            inside = owner[:-1] == owner[1:]
            buckets = ((points[:-1] * _SPREAD + points[1:]) % BUCKETS)[inside]
            found += np.bincount(np.unique(owner[:-1][inside] * BUCKETS + buckets) % BUCKETS, minlength=BUCKETS)
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(found[seen])], names=["b", "n"])

    ship(words.sparkSession)
    told = words.select("word").mapInArrow(count, "b long, n long").groupBy("b").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for row in told.collect():  # at most BUCKETS rows
        counts[row["b"]] = row["n"]
    order = np.empty(BUCKETS, dtype=np.int64)
    order[np.lexsort([np.arange(BUCKETS), counts])] = np.arange(BUCKETS)
    return order, counts


def choose_pivots(places: Sequence[int], weights: Sequence[int], wanted: int = 2, width: int = 2) -> list[int]:
    """Indices of ``wanted`` places, ascending and ``width`` apart at least, of least total weight.

    ``best[k]`` after place i is the lightest choice of k among the places up to i; a
    choice that ends with i adds to the best of k - 1 among the places that i does not touch.
    """
    seen: list[list[tuple[int, list[int]] | None]] = [[(0, [])] + [None] * wanted]
    for i, place in enumerate(places):
        free = next(j for j in range(i, -1, -1) if j == 0 or place - places[j - 1] >= width)
        row = list(seen[-1])
        for k in range(1, wanted + 1):
            before = seen[free][k - 1]
            if before is not None and ((now := row[k]) is None or before[0] + weights[i] < now[0]):
                row[k] = (before[0] + weights[i], [*before[1], i])
        seen.append(row)
    chosen = seen[-1][wanted]
    if chosen is None:
        raise ValueError("too short for that many disjoint grams")
    return chosen[1]


def _running(points: Sequence[int]) -> list[int]:
    """A hash of the first 1, 2, ... of the points."""
    found, value = [], 1
    for point in points:
        value = (value * _BASE + point) % _PRIME
        found.append(value)
    return found


def gram_keys(word: str, order: np.ndarray, counts: np.ndarray) -> tuple[int, list[int], list[int]]:
    """Where the word's prefix ends in the order of bigrams; index keys of its pivots, and of its prefix."""
    points = list(map(ord, word))
    buckets = [(a * _SPREAD + b) % BUCKETS for a, b in zip(points, points[1:], strict=False)]
    keys = [(int(order[h]) << 42) | (a << 21) | b for h, a, b in zip(buckets, points, points[1:], strict=False)]
    last = sorted(keys)[2]
    prefix = [i for i, key in enumerate(keys) if key <= last]
    pivots = [prefix[j] for j in choose_pivots(prefix, [int(counts[buckets[i]]) for i in prefix])]
    from_start, from_end = _running(points), _running(points[::-1])[::-1]
    sides = lambda places: [k for i in places for k in (2 * from_start[i + 1], 2 * from_end[i] + 1)]
    return last, sides(pivots), sides(prefix)


def _indexed(words: DataFrame) -> DataFrame:
    """The words with ``size``, ``mask`` (a bit per letter), ``last`` and the index keys of pivots and prefix."""
    order, counts = _ranks(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            told = [gram_keys(w, order, counts) for w in texts]
            masks = np.array([sum({1 << (ord(c) & 63) for c in w}) for w in texts], dtype=np.uint64).view(np.int64)
            columns = [*batch.columns, pa.array(list(map(len, texts)), pa.int32()), pa.array(masks), pa.array([t[0] for t in told], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array([t[i] for t in told], pa.list_(pa.int64())) for i in (1, 2)]], names=names)

    names = ["word", "n", "size", "mask", "last", "pivots", "prefix"]
    ship(words.sparkSession)
    return words.select("word", "n").mapInArrow(run, "word string, n long, size int, mask long, last long, pivots array<long>, prefix array<long>")


def near_words(words: DataFrame) -> DataFrame:
    """``word, other, other_n``: each two words (``word, n``, unique) one edit apart, both ways round, once at least.

    Words are of four letters at least, since shorter ones lack two disjoint bigrams among any three.
    """
    index = stage(_indexed(words).withColumn("row", F.monotonically_increasing_id()), "variants-grams")
    # A long word may have as many keys as letters, so it is looked up when a pair asks for it.
    carried = F.when(F.col("size") <= LONG, F.col("word")).alias("word")
    told = index.select("row", carried, "n", "size", "mask", "last", "pivots", "prefix")
    asked = told.select("row", "word", "n", "size", "mask", "last", F.explode("pivots").alias("key"))
    held = told.select(*[F.col(c).alias(f"o_{c}") for c in ("row", "word", "n", "size", "mask", "last")], F.explode("prefix").alias("o_key"))
    later = (F.col("o_last") >= F.col("last")) & (F.abs(F.col("o_size") - F.col("size")) <= 1) & (F.col("row") != F.col("o_row"))
    letters = F.bit_count(F.col("mask").bitwiseXOR(F.col("o_mask"))) <= 2
    one_edit = F.levenshtein("word", "o_word", 1) == 1
    met = asked.join(held, (F.col("key") == F.col("o_key")) & later & letters & F.coalesce(one_edit, F.lit(True)))
    met = stage(met.select("row", "o_row", "word", "n", "o_word", "o_n"), "variants-pairs")
    open_ = met.where("word IS NULL OR o_word IS NULL").select("row", "o_row", "n", "o_n").distinct()
    texts = index.select("row", "word")
    long = open_.join(texts, "row").join(texts.withColumnsRenamed({"row": "o_row", "word": "o_word"}), "o_row").where(one_edit)
    pairs = met.where("word IS NOT NULL AND o_word IS NOT NULL").select("word", "n", "o_word", "o_n").unionByName(long.select("word", "n", "o_word", "o_n"))
    there = pairs.select("word", F.col("o_word").alias("other"), F.col("o_n").alias("other_n"))
    back = pairs.select(F.col("o_word").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return there.unionByName(back)


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where the chain of forms (``word, form``, no circles) that starts at each word ends.

    Pointers are doubled, so the rounds grow with the logarithm of the longest chain.
    """
    state = stage(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(state.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variants-roots")
        state = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return state


def group_variants(words: DataFrame, times: int = 5) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of each word of a vocabulary (``word, n``, unique).

    A word's form is its near word of largest n, the smallest in code-point order of
    several, if it is ``times`` as frequent at least.  Counts grow along forms, so chains end.
    """
    words = stage(words.select("word", "n"), "variants-words")
    near = near_words(words).groupBy("word").agg(F.count_distinct("other").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"))
    told = words.join(near, "word", "left")
    enough = -F.col("best.less") >= times * F.col("n")
    told = stage(told.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *[F.when(enough, c).alias(name) for name, c in (("form", F.col("best.form")), ("form_n", -F.col("best.less")))]), "variants-forms")
    ends = roots(told.where("form IS NOT NULL"))
    return told.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
