"""Variants against brute force."""

import itertools
import random

import numpy as np
import pytest

from rungworks.llm import variants


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _brute(counts, times=5):
    near = {w: [o for o in counts if _one_edit(w, o)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= times * counts[w] else None
    found = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        found.append((w, counts[w], len(near[w]), form[w], counts.get(form[w]), root))
    return sorted(found, key=repr)


def _words(rng, alphabet, n, lengths):
    words = {"".join(rng.choices(alphabet, k=rng.choice(lengths))) for _ in range(n)}
    for w in list(words):
        i = rng.randrange(len(w))
        words |= {w[:i] + rng.choice(alphabet) + w[i + rng.randrange(2) :]}
    return {w: rng.choice([5, 7, 30, 200, 9000]) for w in words if len(w) >= 4}


CASES = {"two letters": ("ab", [4, 5, 6, 7]), "accents": ("aeéÉüß×ÿ", [4, 6, 9]), "long": ("ab", [40, 41]), "alphabet": ("abcdefghij", [4, 5])}


@pytest.mark.parametrize("name", CASES)
def test_variants_equal_brute_force(spark, name):
    counts = _words(random.Random(name), CASES[name][0], 250, CASES[name][1])
    counts |= {"aaaaaa": 10, "aaaaa": 60, "aaaaaaa": 400, "abababab": 5, "babababa": 30, "bababab": 30}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted(((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in variants.group_variants(df).collect()), key=repr)
    assert got == _brute(counts)


def test_pivots_are_disjoint_and_lightest():
    rng = random.Random(2)
    for _ in range(300):
        places = sorted(rng.sample(range(12), rng.randrange(3, 8)))
        weights = [rng.randrange(9) for _ in places]
        got = variants.choose_pivots(places, weights)
        apart = [p for p in itertools.combinations(range(len(places)), 2) if places[p[1]] - places[p[0]] >= 2]
        assert tuple(got) in apart
        assert sum(weights[i] for i in got) == min(sum(weights[i] for i in p) for p in apart)


def test_chains_end_at_their_root(spark):
    counts = {f"{'a' * i}bcdefgh": 5**i for i in range(1, 8)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {r.root for r in variants.group_variants(df).collect()} == {"aaaaaaabcdefgh"}


def test_very_long_words_and_empty_vocabularies(spark):
    long = "ab" * 20_000
    counts = {long: 100, long + "a": 5, "z" * 30_000: 9, "z" * 29_999: 50}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {r.word[:1] + str(len(r.word)): r.n_near for r in variants.group_variants(df).collect()} == {"a40000": 1, "a40001": 1, "z30000": 1, "z29999": 1}
    assert variants.group_variants(df.limit(0)).collect() == []


def test_damage_takes_the_letter_the_hash_names(spark):
    from zlib import crc32

    texts = [(i, f"Colour COLOURS étérnelle colour{i % 5} short") for i in range(400)] + [(None, "Colours"), (7, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    want = []
    for i, text in texts:
        for run in ("".join(c if c.isalpha() and ord(c) < 256 else " " for c in text or "")).split():
            run = "".join(c.lower() if c.isascii() else c for c in run)
            if len(run) >= 6:
                h = crc32(f"{'' if i is None else i}:{run}".encode())
                want.append(run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run)
    assert sorted(r.word for r in variants.misspell(variants.runs(df)).collect()) == sorted(want)
    assert len(np.unique(want)) > 5
