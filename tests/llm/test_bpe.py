"""Encoding against the tiktoken library, and the exact round trip."""

import hashlib
import random

import numpy as np
import pytest
import regex

P = pytest.importorskip("public_tokenizers")
import tiktoken  # noqa: E402

from rungworks.llm import bpe  # noqa: E402
from rungworks.llm.queries import QUERIES  # noqa: E402
from tests.llm.conftest import DATA  # noqa: E402

RANKS = P.path("byte_bpe_50k.tiktoken")
TEXTS = [
    "", " ", "  ", "\n", " a", "a ", "  a", " \na", "a\n\nb", "it's we're I'll you've he'd I'm 'tis", "''s", " 's", "  's", "\n's", "x's's", "'re'", "'r", "'", "'s", "a'sb",
    "12's 3 4\t5", "!!'s", "don't!'ll", "naïve café 漢字かな \U0001f600\U0001f600 x", "a b   c　d", "  x", "a" * 500, "ab" * 4000, " " * 3000 + "x", "١٢٣ ²½", "\x1c\x1d a\x85b", "​ a",
    "é 'S 'T", "<|endoftext|>", "᠎a \x00b",
]


@pytest.fixture(scope="module")
def own():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def _same(texts, own):
    merge = bpe.Merger(bpe.read_ranks(RANKS))
    for _ in range(2):  # the second time from the cache
        ids, edges = bpe.encode_texts(texts, merge)
        for text, a, b in zip(texts, edges[:-1], edges[1:], strict=True):
            assert ids[a:b].tolist() == own.encode_ordinary(text), text[:80]
            assert merge.lengths[ids[a:b]].sum() == len(text.encode())


def test_ids_are_those_of_the_library(own):
    _same(TEXTS, own)


def test_merges_side_by_side_equal_merges_one_by_one():
    merge = bpe.Merger(bpe.read_ranks(RANKS))
    rng = random.Random(9)
    pieces = ["".join(rng.choice("abehinorst é") for _ in range(rng.randrange(1, 40))).encode() for _ in range(3000)] + [b"a", b"zz", b"\xff\xfe\x00"]
    for piece, got in zip(pieces, merge._merged_many(pieces), strict=True):
        assert np.frombuffer(got, dtype=np.int32).tolist() == merge._merged_long(piece)


def test_random_texts(own):
    rng = random.Random(3)
    letters = "ab's tlvredm'  \n\t12é漢!. 　\U0001f600²"
    _same(["".join(rng.choice(letters) for _ in range(rng.randrange(0, 60))) for _ in range(4000)], own)


def test_slices_are_the_matches_of_the_pattern():
    pattern = regex.compile(P.PATTERN)
    for text in filter(None, TEXTS):
        points = np.array([ord(c) for c in text], dtype=np.int32)
        assert bpe.slice_starts(points, np.array([0])).tolist() == [m.start() for m in pattern.finditer(text)], text[:80]


def test_scan_equals_the_running_composition():
    of_class, table, _, _ = bpe._machine()
    rng = np.random.default_rng(5)
    functions = of_class[rng.integers(0, len(of_class), 5000)]
    running = [functions[0]]
    for f in functions[1:]:
        running.append(table[running[-1], f])
    assert bpe._scan(functions, table).tolist() == running


def test_frames_pass_other_columns_and_round_trip(spark):
    rows = [(i, t, "old") for i, t in enumerate(TEXTS)] + [(90, None, "old"), (90, None, "old"), (None, "x", "old")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(df, RANKS), RANKS).collect()
    assert len(got) == len(rows)
    for row in got:
        assert bytes(row.decoded).decode() == (row.text or "")
        assert row.ends == [] if not row.text else row.ends[-1] == len(row.text.encode())


def test_encoding_and_decoding_in_one_process_equals_both(spark):
    rows = [(i, t, "old", "old") for i, t in enumerate(TEXTS)] + [(90, None, "old", "old")] + [(100 + i, "many of them", "", "") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string").coalesce(1)
    both, one = bpe.decode(bpe.encode(df, RANKS), RANKS), bpe.encode_and_decode(df, RANKS)
    assert one.columns == both.columns
    assert sorted(map(repr, one.collect())) == sorted(map(repr, both.collect()))
    assert one._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_query_equals_the_library(spark, own):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = QUERIES["op4_byte_bpe"](spark, DATA).collect()
    assert len(got) == len(texts)
    for row in got:
        ids = own.encode_ordinary(texts[row.doc_id])
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
