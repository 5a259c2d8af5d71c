"""Near-duplicate classes by circulant MinHash, banding and exact checks.

1. Each text becomes its set of five-word shingles, a signature (two permutations, one
   of them shifted a place per coordinate), band keys and a sketch of the signature.
   Texts with equal sets are one class from here on.
2. Classes that share a band key are a bucket.  Each member is compared with the bucket's
   least member, its hub: first by sketch, then exactly by whole sets.  So a group of any size
   costs a comparison per member and bucket, and most of it is linked already.
3. In buckets whose members are still in several components, members outside the largest are
   compared with all others.  That is done by blocks of bounded size in tasks: a block
   holds sketches first, which tell who needs whole sets; then the pairs of different
   components are checked exactly, closest first, until they are linked.  Only links that
   join components leave a task, never the pairs.

The bands are as many as leave a pair at the threshold undetected with probability 1e-7 at
most; so does the sketch, whose limit comes from the exact distribution.  No bucket
is capped.

Defined results: null and empty texts have empty sets and are linked with nothing; texts of
fewer words than a shingle are one shingle; rows repeated with the same id are one document
and get the same answer each; an id with two texts joins the classes of both in
``component_id``, while what is kept goes by texts alone: of the texts that links join, that of
the smallest id stays (of several of that id, the one of the least digest), so no text goes
because its id holds another one; rows with a null id are linked with nothing and kept; empty
tables give empty tables; other columns pass through, and a column that has the name of a result is
replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rungworks.llm import shingles as S
from rungworks.llm.common import free_name, ship
from rungworks.llm.components import components
from rungworks.session import stage

#: Least similarity in percent, and words of a shingle.
PERCENT = 80
WIDTH = 5
#: Members of a bucket, and shingles of theirs, that a block holds.
BLOCK = 512
BLOCK_SHINGLES = 500_000
MISS = 1e-7

RESULTS = ("n_shingles", "component_id", "kept")


def bands_for(percent: int) -> int:
    """Bands that miss a pair at the threshold with probability MISS at most."""
    return min(S.COORDINATES // S.ROWS, math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** S.ROWS)))


@cache
def furthest(percent: int) -> int:
    """Bits in which the sketches of a pair at the threshold may differ: more do with probability MISS at most.

    A coordinate that differs, which it does with probability 1 - percent, changes each of its
    two bits with probability a half.  The bits of all coordinates are counted exactly.
    """
    other = 1 - percent / 100
    bits = np.ones(1)
    for _ in range(S.COORDINATES):
        bits = np.convolve(bits, [1 - 0.75 * other, 0.5 * other, 0.25 * other])
    beyond = np.append(np.cumsum(bits[::-1])[::-1][1:], 0.0)  # probability of more than so many
    return int(np.argmax(beyond <= MISS))


def features(df: DataFrame, text: str, doc_id: str, bands: int, width: int = WIDTH) -> DataFrame:
    """``id, n, digest, sketch, bands`` of every row; the last three are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                rows = batch.slice(start, 512)
                texts = rows["text"].cast(pa.binary()).to_pylist()
                n, digests, sketches, keys = [], [], [], []
                for found in S.shingle_sets([t or b"" for t in texts], width):
                    n.append(len(found))
                    least = S.signature(found) if len(found) else None
                    digests.append(S.set_digest(found) if len(found) else None)
                    sketches.append(S.sketch(least) if least is not None else None)
                    keys.append(S.band_keys(least, bands) if least is not None else None)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([rows["id"], pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(sketches, longs), pa.array(keys, longs)], names=["id", "n", "digest", "sketch", "bands"])

    narrow = df.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, "id bigint, n bigint, digest string, sketch array<bigint>, bands array<bigint>")


@contextmanager
def _prefiltered(spark: SparkSession) -> Iterator[None]:
    """Joins inside filter their large side by Spark's runtime Bloom filter of the small one.

    The filter has 8 MB at most, whatever is in it; where it fills up, more rows are shuffled and
    the result is the same.
    """
    prefix = "spark.sql.optimizer.runtime.bloomFilter."
    settings = {
        "enabled": "true", "applicationSideScanSizeThreshold": "0", "creationSideThreshold": "4g",
        "expectedNumItems": "4000000", "numBits": "67108864",
    }
    before = {k: spark.conf.get(prefix + k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(prefix + k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(prefix + k, v)


def _sets(df: DataFrame, wanted: DataFrame, text: str, doc_id: str, width: int, held_by: str = "node") -> DataFrame:
    """``node, shingles`` of the wanted nodes (``node, digest``), made anew from their texts and staged.

    The column ``held_by`` names a document that holds the text.  The texts of other documents
    are dropped before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                rows = batch.slice(start, 128)
                found = list(S.shingle_sets([t or b"" for t in rows["text"].cast(pa.binary()).to_pylist()], width))
                keep = [i for i, (s, d) in enumerate(zip(found, rows["digest"].to_pylist(), strict=True)) if S.set_digest(s) == d]
                sets = pa.array([found[i].view(np.int64) for i in keep], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([rows["node"].take(pa.array(keep, pa.int64())), sets], names=["node", "shingles"])

    texts = df.select(F.col(doc_id).cast("long").alias("holder"), F.col(text).alias("text"))
    known = wanted.select("node", "digest", F.col(held_by).alias("holder")).where(F.col("holder") >= -(2**63))  # always so; Spark filters by tables that have a condition
    found = texts.join(known, "holder").select("node", "text", "digest").mapInArrow(run, "node bigint, shingles array<bigint>")
    with _prefiltered(df.sparkSession):
        return stage(found.dropDuplicates(["node"]), "minhash-sets")


def _distance(a: str, b: str) -> Column:
    """Bits in which two sketches differ."""
    total = F.lit(0)
    for i in range(4):
        total = total + F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i]))
    return total


def _star_links(df: DataFrame, nodes: DataFrame, members: DataFrame, text: str, doc_id: str, percent: int, width: int) -> DataFrame:
    """``a, b``: members linked to the hub of a bucket of theirs."""
    told = lambda name, to: nodes.select(F.col("node").alias(name), F.col("n").alias(f"n_{to}"), F.col("sketch").alias(f"s_{to}"))
    pairs = members.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    met = pairs.join(told("a", "a"), "a").join(told("b", "b"), "b")
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    near = stage(met.where(sizes & (_distance("s_a", "s_b") <= furthest(percent))).select("a", "b"), "minhash-near")
    wanted = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct()
    sets = _sets(df, stage(nodes.join(wanted, "node").select("node", "least", "digest"), "minhash-wanted"), text, doc_id, width, "least")
    full = near.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    both = F.size(F.array_intersect("x", "y"))
    sure = full.withColumn("both", both).where(100 * F.col("both") >= percent * (F.size("x") + F.size("y") - F.col("both")))
    return sure.select("a", "b")


def _mixed_rows(nodes: DataFrame, members: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of blocks (``key, i, j``) of the buckets that hold several components.

    ``minor`` rows, those outside the bucket's largest component, are to be compared with
    the others of their block.  A bucket of one block is not copied at all.
    """
    placed = members.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    per = placed.join(nodes.select("node", "n"), "node").groupBy("key", "component").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    whole = per.groupBy("key").agg(F.max_by("component", F.struct("c", "component")).alias("major"), F.count("*").alias("parts"), F.sum("c").alias("c"), F.sum("w").alias("w"), F.max(F.struct("c", "component", "w")).alias("most"))
    blocks = lambda rows, weight: F.greatest(F.ceil(rows / BLOCK), F.ceil(weight / BLOCK_SHINGLES), F.lit(1)).cast("int")
    mixed = whole.where("parts > 1").select("key", "major", blocks(F.col("c"), F.col("w")).alias("mb"), blocks(F.col("c") - F.col("most.c"), F.col("w") - F.col("most.w")).alias("rb"))
    rows = placed.join(stage(mixed, "minhash-mixed"), "key").withColumn("minor", F.col("component") != F.col("major"))
    spot = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "node"), n).cast("int")
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    # A minor row meets all blocks of members, any row all blocks of minors: once as each.
    as_minor = F.transform(F.when(F.col("minor"), upto(F.col("mb"))).otherwise(F.array().cast("array<int>")), lambda j: F.struct(spot(F.col("rb"), 1).alias("i"), j.alias("j"), F.lit(True).alias("left")))
    as_any = F.transform(upto(F.col("rb")), lambda i: F.struct(i.alias("i"), spot(F.col("mb"), 2).alias("j"), F.lit(False).alias("left")))
    dealt = rows.withColumn("at", F.explode(F.concat(as_minor, as_any))).select("key", "at.i", "at.j", "at.left", "node", "component")
    return dealt


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one block after another from rows in order of blocks."""
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch[c].to_numpy(zero_copy_only=False) for c in ("key", "i", "j")])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(keys[:, a].tolist())
            if rest and key != last:
                yield pa.Table.from_batches(rest)
                rest = []
            rest.append(batch.slice(a, b - a))
            last = key
    if rest:
        yield pa.Table.from_batches(rest)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _close_pairs(block: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (left, right) of different components that may be linked, and their distance.

    A pair that shares several buckets counts in that of its first common band.
    """
    left = block["left"].to_numpy(zero_copy_only=False).astype(bool)
    a, b = np.flatnonzero(left), np.flatnonzero(~left)
    none = np.empty(0, dtype=np.int64)
    if not len(a) or not len(b):
        return none, none, none
    component, n, key = (block[c].to_numpy() for c in ("component", "n", "key"))
    # Unsigned: of a signed number numpy counts the bits of the absolute value.
    sketches, bands = _matrix(block["sketch"]).view(np.uint64), _matrix(block["bands"])
    distance = np.zeros((len(a), len(b)), dtype=np.int16)
    for i in range(sketches.shape[1]):
        distance += np.bitwise_count(sketches[a, i][:, None] ^ sketches[b, i][None, :])
    ok = distance <= furthest(percent)
    ok &= component[a][:, None] != component[b][None, :]
    ok &= 100 * np.minimum(n[a][:, None], n[b][None, :]) >= percent * np.maximum(n[a][:, None], n[b][None, :])
    x, y = np.nonzero(ok)
    own = np.zeros(len(x), dtype=bool)
    for start in range(0, len(x), 50_000):
        part = slice(start, start + 50_000)
        same = bands[a[x[part]]] == bands[b[y[part]]]
        first = same.argmax(axis=1)
        own[part] = bands[a[x[part]], first] == key[0]
    x, y = x[own], y[own]
    return a[x], b[y], distance[x, y]


def _cross_links(df: DataFrame, nodes: DataFrame, rows: DataFrame, text: str, doc_id: str, percent: int, width: int) -> DataFrame:
    """``a, b``: components joined by a link between members that share a bucket."""

    def involved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _groups(batches):
            a, b, _ = _close_pairs(block, percent)
            if len(a):
                yield from block.take(pa.array(np.union1d(a, b))).select(kept).to_batches()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _groups(batches):
            a, b, distance = _close_pairs(block, percent)
            if not len(a):
                continue
            component = block["component"].to_numpy()
            sets = [s.values.to_numpy(zero_copy_only=False).view(np.uint64) for s in block["shingles"]]
            above: dict[int, int] = {}

            def top(c: int) -> int:
                while c in above:  # noqa: B023
                    c = above[c]  # noqa: B023
                return c

            out = []
            for k in np.argsort(distance, kind="stable"):
                p, q = top(int(component[a[k]])), top(int(component[b[k]]))
                if p != q and S.linked(sets[a[k]], sets[b[k]], percent):
                    above[max(p, q)] = min(p, q)
                    out.append((max(p, q), min(p, q)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    kept = ["key", "i", "j", "left", "node", "component", "n", "sketch", "bands"]
    block = ["key", "i", "j"]
    told = rows.join(nodes.select("node", "n", "sketch", "bands"), "node").select(kept)
    some = stage(told.repartition(*block).sortWithinPartitions(*block).mapInArrow(involved, told.schema), "minhash-close")
    wanted = stage(nodes.join(some.select("node").distinct(), "node").select("node", "least", "digest"), "minhash-wanted")
    sets = _sets(df, wanted, text, doc_id, width, "least")
    full = some.join(sets, "node").repartition(*block).sortWithinPartitions(*block)
    return full.mapInArrow(joined, "a bigint, b bigint")


def _joined_by_id(seen: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """``node, component`` of the classes that an id with several texts joins to a lesser one."""
    some = seen.where("n > 0 AND id IS NOT NULL")
    several = some.groupBy("id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b").select("id")
    held = some.select("id", "digest").join(stage(several, "minhash-several"), "id").distinct().join(nodes.select("digest", "node"), "digest")
    placed = stage(held.join(labels, "node", "left").select("id", F.coalesce("component", "node").alias("a")).distinct(), "minhash-by-id")
    return components(placed.join(placed.groupBy("id").agg(F.min("a").alias("b")), "id").select("a", "b"))


def _marks(df: DataFrame, text: str, doc_id: str, percent: int, width: int) -> DataFrame:
    """``id, n, digest, component, kept`` of every row."""
    ship(df.sparkSession)
    seen = stage(features(df, text, doc_id, bands_for(percent), width), "minhash-features")
    whole = seen.where("n > 0 AND id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("least"), F.min_by(F.struct("n", "sketch", "bands"), "id").alias("f"))
    # A node is a set, numbered in the order of least ids: the least node of a class has its least id.
    numbered = whole.orderBy("least", "digest").withColumn("node", F.monotonically_increasing_id())
    nodes = stage(numbered.select("node", "least", "digest", "f.n", "f.sketch", "f.bands"), "minhash-nodes")
    banded = nodes.select("node", F.explode("bands").alias("key"))
    buckets = stage(banded.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("other")).where("hub <> other").drop("other"), "minhash-buckets")
    members = stage(banded.join(buckets, "key").select("key", "node", "hub"), "minhash-members")

    stars = components(_star_links(df, nodes, members, text, doc_id, percent, width))
    rows = _mixed_rows(nodes, members, stars)
    more = stage(_cross_links(df, nodes, rows, text, doc_id, percent, width), "minhash-cross")
    labels = components(stars.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    by_id = _joined_by_id(seen, nodes, labels)
    onward = by_id.select(F.col("node").alias("component"), F.col("component").alias("c"))
    moved = labels.join(onward, "component", "left").select("node", F.coalesce("c", "component").alias("c"), F.lit(False).alias("first"))
    moved = moved.unionByName(by_id.select("node", F.col("component").alias("c"), F.lit(True).alias("first")))
    named = moved.join(nodes.select(F.col("node").alias("c"), F.col("least").alias("top")), "c").select("node", "first", "top")
    labelled = nodes.select("node", "least", F.col("digest").alias("l")).join(named, "node", "left").select("l", "least", F.coalesce("top", "least").alias("top"), F.coalesce("first", F.lit(True)).alias("first"))
    done = seen.select("id", "n", "digest").join(labelled, F.col("digest") == F.col("l"), "left")
    label = F.when(F.col("id").isNotNull(), F.coalesce("top", "id"))
    return done.select("id", "n", "digest", label.alias("component"), F.coalesce(F.col("first") & (F.col("id") == F.col("least")), F.lit(True)).alias("kept"))


def mark_near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    ``component_id`` is the smallest id that links lead to; a link is a similarity of the
    shingle sets of ``percent`` or more.
    """
    marks = _marks(df, text, doc_id, percent, width)
    return marks.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept")


def _with_digest(df: DataFrame, text: str, digest: str, width: int) -> DataFrame:
    """``df`` with the digest of each row's set, null where that is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                rows = batch.slice(start, 512)
                found = S.shingle_sets([t or b"" for t in rows[text].cast(pa.binary()).to_pylist()], width)
                digests = pa.array([S.set_digest(s) if len(s) else None for s in found], pa.string())
                yield pa.RecordBatch.from_arrays([*rows.columns, digests], names=[*rows.schema.names, digest])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(digest, StringType())]))


def keep_one_of_each(df: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """One document of each near-duplicate class, with the columns it came with.

    Rows go by id and set, so an id may keep one text and lose another.  Of rows repeated with one
    id and set, one stays (of empty ones, one of each text); rows without an id all do.
    """
    one, digest, empty = free_name(df, "_id", "_digest", "_empty")
    marks = stage(_marks(df, text, doc_id, percent, width).where("id IS NOT NULL").select("id", "digest", "kept"), "minhash-marks")
    known = marks.groupBy("id").agg(F.count("*").alias("rows"), F.max("kept").alias("any"))
    special = stage(known.where("rows > 1 OR NOT any").select(F.col("id").alias(one), "any"), "minhash-special")
    once = df.join(special, F.col(doc_id) == F.col(one), "left_anti")
    repeated = _with_digest(df.join(special.where("any"), F.col(doc_id) == F.col(one), "left_semi"), text, digest, width)
    stay = marks.where("kept").select(F.col("id").alias(one), F.col("digest").alias(empty)).distinct()
    left = repeated.join(stay, (F.col(doc_id) == F.col(one)) & F.col(digest).eqNullSafe(F.col(empty)), "left_semi")
    several = left.withColumn(empty, F.when(F.col(digest).isNull(), F.col(text))).dropDuplicates([doc_id, digest, empty])
    return once.unionByName(several.select(*df.columns))
