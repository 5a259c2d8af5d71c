"""Extra columns, whatever their names, change no result and come through."""

import pytest
from pyspark.sql import functions as F

from rungworks.llm import bpe, exact, lines, minhash, mixing, pii, quality, toxicity, urls, warc

TEXTS = ["one two three four five six seven", "one two three four five six seven", "mail a@b.cc now", None, "", "a\nshared line\nb", "shared line", "x " * 70]
NAMES = (
    "start first blocks whole rest turn carried before s_source q_nr q_shard nr shard shards docs w level _size _hash _nr own0 own9 w_digest w_norm norm digest id a b x y pos "
    "bad site sites _bad _lines _keep r_host _fit domain suffix n k key hub node component term entity spans_ _spans _more _gone value file run rank _rank t r0 c0"
).split()
PUBLIC = __import__("pathlib").Path("/opt/tokenizers/byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def frames(spark):
    rows = [(i, t, f"s{i % 3}", f"http://h{i % 2}.org/{i}", i) for i, t in enumerate(TEXTS)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string, url string, page_id long")
    return plain, plain.withColumns({n: F.lit(f"<{n}>") for n in NAMES})


OPERATORS = {
    "mix": lambda df: mixing.mix(df),
    "mixture": lambda df: mixing.mixture(df),
    "exact": lambda df: exact.mark_copies(df),
    "drop_copies": lambda df: exact.drop_copies(df),
    "lines": lambda df: lines.remove_boilerplate(df, min_sites=2),
    "urls": lambda df: urls.judge(df, df.select("doc_id", (F.col("doc_id") % 2).alias("quality"))),
    "pii": lambda df: pii.find(df),
    "sanitise": lambda df: pii.sanitise(df),
    "quality": lambda df: quality.judge(quality.metrics(df), sample=0.9),
    "keep_good": lambda df: quality.keep_good(df),
    "near": lambda df: minhash.keep_one_of_each(df),
    "toxicity": lambda df: toxicity.score(df, toxicity.Model(-1.0, {"mail": 2.0})),
    "bpe": lambda df: bpe.digests(bpe.decode(bpe.encode(df, str(PUBLIC)), str(PUBLIC))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_other_columns_pass_through(frames, name):
    plain, crowded = frames
    want, got = OPERATORS[name](plain), OPERATORS[name](crowded)
    assert set(want.columns) | set(NAMES) == set(got.columns)
    show = lambda df: sorted((tuple(r) for r in df.select(*want.columns).collect()), key=repr)
    assert show(want) == show(got)
    assert all(r[n] == f"<{n}>" for r in got.collect() for n in NAMES if n not in want.columns)


def test_columns_named_as_results_are_replaced(frames):
    plain, _ = frames
    old = plain.withColumns({c: F.lit("old") for c in (*mixing.RESULTS, "keep_id", "group_size", "kept", "text_sha256", "host", "verdict", "spans", "n_lines", "score", "ids")})
    assert dict(mixing.mix(old).dtypes)["size"] == "bigint" and "old" not in str(exact.mark_copies(old).select("keep_id", "kept").collect())
    for df in (lines.remove_boilerplate(old), pii.find(old), urls.judge(old, plain.selectExpr("doc_id", "1 AS quality")), toxicity.score(old, toxicity.Model())):
        assert df.count() == len(TEXTS) and len(set(df.columns)) == len(df.columns)


def test_archives_read_only_what_they_need(frames):
    _, crowded = frames
    got = warc.resolve(warc.archive_and_read(crowded.withColumnRenamed("text", "html")))
    assert got.count() == len(TEXTS)


def test_mixture_gives_what_was_taken(spark):
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(i % 40 + 1)), f"s{i % 3}", 0) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    taken = {r.doc_id: r.taken for r in mixing.mix(df, block=4).collect()}
    got = {}
    for r in mixing.mixture(df, block=4).collect():
        assert r.n_chars == len(r.text)
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.split())
    assert got == {i: n for i, n in taken.items() if n}


def test_seats_are_those_of_the_highest_quotients(spark):
    import random

    rng = random.Random(6)
    items = [(g, i, float(rng.choice([0, 1, 3, 50, 500]) * rng.random()), n) for g, n in ((1, 7), (2, 100), (3, 0), (4, 999)) for i in range(30)]
    got = {(r.g, r.i): r.seats for r in mixing.sainte_lague(spark.createDataFrame(items, "g int, i int, t double, n long"), ["g"], "i", "t", "n").collect()}
    for group in (1, 2, 3, 4):
        own = [(i, t) for g, i, t, _ in items if g == group]
        n = next(n for g, _, _, n in items if g == group)
        best = sorted(((-t / (2 * k + 1), i) for i, t in own if t > 0 for k in range(n)))[:n]
        want = {i: sum(j == i for _, j in best) for i, _ in own}
        assert all(got.get((group, i), 0) == s for i, s in want.items())


def test_order_of_rules_is_by_rejection_per_cost_and_changes_no_verdict(spark):
    m = [quality.Measured(r, rej, cost) for r, rej, cost in zip(quality.RULES, (0.1, 0.5, 0.0, 0.2, 0.3, 0.0), (1, 10, 2, 1, 1, 1), strict=True)]
    assert [r.name for r in quality.cascade_order(m)][:4] == ["duplicate_lines", "long_words", "too_short", "repetitive"]
    df = spark.createDataFrame([(t,) for t in TEXTS] + [("w " * 60,), (" ".join(f"v{i}" for i in range(80)),)], "text string")
    verdicts = [sorted((r.text or "", r.k) for r in df.withColumn("k", quality.first_rejection(F.col("text"), rules).isNull()).collect()) for rules in (quality.RULES, quality.RULES[::-1])]
    assert verdicts[0] == verdicts[1]
