"""Near-duplicate classes against comparing all pairs."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rungworks.llm import components, minhash
from rungworks.llm import shingles as S
from rungworks.llm.queries import QUERIES
from tests.llm.conftest import DATA


def plain_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(rows, percent):
    """Set size and smallest reachable id of each row, by a shared-shingle search over all pairs."""
    sets = [plain_set(t) for _, t in rows]
    holders, above = {}, {}

    def top(x):
        while x in above:
            x = above[x]
        return x

    for k, s in enumerate(sets):
        common = {}
        for shingle in s:
            for other in holders.get(shingle, ()):
                common[other] = common.get(other, 0) + 1
            holders.setdefault(shingle, []).append(k)
        for other, both in common.items():
            if rows[k][0] is not None and rows[other][0] is not None and 100 * both >= percent * (len(s) + len(sets[other]) - both):
                p, q = top(rows[k][0]), top(rows[other][0])
                if p != q:
                    above[max(p, q)] = min(p, q)
    return [(i, len(s), None if i is None else top(i)) for (i, _), s in zip(rows, sets, strict=True)]


def check(spark, rows, percent):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.mark_near_duplicates(df, percent=percent).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=repr) == sorted(plain(rows, percent), key=repr)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def _edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def test_groups_of_copies_and_chains(spark):
    rng = random.Random(4)
    rows = [(1000 + i, " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(1, 120)))) for i in range(60)]
    base = [f"b{rng.randrange(500)}" for _ in range(150)]
    rows += [(2000 + i, _edited(rng, base, rng.randrange(0, 8))) for i in range(150)]  # many near the threshold
    chain = [f"c{i}" for i in range(200)]
    for i in range(12):  # neighbours are linked, ends are not
        rows.append((3100 - i, " ".join(chain)))
        chain[i * 16 : i * 16 + 3] = [f"d{i}{k}" for k in range(3)]
    rows += [(4000 + i, "Same Text again and again") for i in range(30)]
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "A b"), (5004, "a\tB"), (5005, "a b c"), (5005, "a b c"), (None, "a b c"), (None, None), (5006, "x " * 5000)]
    rng.shuffle(rows)
    for percent in (80, 85):
        check(spark, rows, percent)


def test_blocks_smaller_than_a_bucket(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"b{i}" for i in range(120)]
    rows = [(i, _edited(rng, base, 3 + i % 3)) for i in range(120)]
    monkeypatch.setattr(minhash, "BLOCK", 16)
    check(spark, rows, 80)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(70)] + [(100, 100 + k) for k in range(40)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(50)] + [(5, 5)]
    above = {}

    def top(x):
        while x in above:
            x = above[x]
        return x

    for a, b in edges:
        p, q = top(a), top(b)
        if p != q:
            above[max(p, q)] = min(p, q)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges for x in e}
    assert got == {x: top(x) for x in nodes if top(x) != x}


def test_shingle_hashes_tell_what_words_tell():
    texts = ["", " ", "A b", "a B c d e", "a b c d e f a b c d e", "é ü   x", "y" * 10_000 + " z", "one two\nthree\tfour\x0bfive\x0csix\rseven", "a b c d e\x1cf"]
    for text, got in zip(texts, S.shingle_sets([t.encode() for t in texts]), strict=True):
        assert len(got) == len(plain_set(text))
    a, b = S.shingle_sets([b"p q r s t u", b"P Q r S t U"])
    assert a.tolist() == b.tolist()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 2**63, 400, dtype=np.uint64)
        a, b = np.unique(pool[:300]), np.unique(pool[100:])
        errors.append((S.signature(a) == S.signature(b)).mean() - 0.5)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07


def test_stage_keeps_columns_and_one_of_each(spark):
    rows = [(3, "a b c d e f g", "x"), (1, "a b c d e f g", "y"), (2, "other words are here to stay", "z"), (None, None, "n")]
    got = minhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string, _gone string"))
    assert got.columns == ["doc_id", "text", "_gone"]
    assert sorted((r.doc_id for r in got.collect()), key=repr) == sorted([1, 2, None], key=repr)


def test_query_equals_all_pairs(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    got = QUERIES["op3_minhash_dedup"](spark, DATA).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(plain(rows, 85))


def test_only_wanted_texts_are_shuffled(spark, tables):
    rows = [(i, f"words of text {i} and more", "en", "s", 1) for i in range(500)]
    df = spark.read.parquet(tables(documents=rows) + "/documents.parquet")
    digests = [S.set_digest(s) for s in S.shingle_sets([r[1].encode() for r in rows[:7]])]
    wanted = minhash.stage(spark.createDataFrame(list(zip(range(7), digests, strict=True)), "node long, digest string"), "wanted")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert minhash._sets(df, wanted, "text", "doc_id", 5).count() == 7
        known = wanted.where(F.col("node") >= -(2**63))
        with minhash._prefiltered(spark):
            plan = df.selectExpr("doc_id AS node", "text").join(known, "node")._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold") != "0"


def test_blocks_find_all_close_pairs():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 2**63, 200, dtype=np.uint64))
    sets = [np.unique(np.concatenate([np.delete(base, rng.integers(0, len(base), 8)), rng.integers(0, 2**63, 8, dtype=np.uint64)])) for _ in range(40)]
    signed = [S.signature(s) for s in sets]
    bands = [S.band_keys(g, 22) for g in signed]
    found = set()
    for key in {int(k) for b in bands for k in b}:
        own = [i for i, b in enumerate(bands) if key in b.tolist()]
        rows = [(key, 0, 0, left, i, i, len(sets[i]), S.sketch(signed[i]).tolist(), bands[i].tolist()) for i in own for left in (True, False)]
        names = ["key", "i", "j", "left", "node", "component", "n", "sketch", "bands"]
        block = pa.table({n: list(c) for n, c in zip(names, zip(*rows, strict=True), strict=True)})
        a, b, _ = minhash._close_pairs(block, 85)
        nodes = block["node"].to_numpy()
        pairs = [(int(nodes[x]), int(nodes[y])) for x, y in zip(a, b, strict=True)]
        assert len(pairs) == len(set(pairs)) and not found & set(pairs)  # each in one bucket only
        found |= set(pairs)
    linked = {(x, y) for x in range(40) for y in range(40) if x != y and S.linked(sets[x], sets[y], 85)}
    assert len(linked) > 1000 and linked <= found
