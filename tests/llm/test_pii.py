"""Personal data against a plain search with the agreed patterns, and planted disclosures."""

import hashlib
import math
import re
from collections import Counter, defaultdict

from rungworks.llm import pii
from rungworks.llm.queries import QUERIES
from tests.llm.conftest import DATA

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    found = [(m.start(), nr, m.end(), kind, m.group()) for nr, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if _good(kind, m.group())]
    return sorted(found)


def disclosed(rows, reach=200, contexts=3, threshold=0.8):
    """Term spans of each row, by going through every pair."""
    term = re.compile(r"(?<![^\W_]|[@._%+-])[^\W\d_]{2,}(?![^\W]|[@%+]|[.-](?:[^\W_]|@))")
    n_c, n_t, n_ct, seen = Counter(), Counter(), Counter(), defaultdict(set)
    held, words = [], []
    for _, text in rows:
        spans = plain(text)
        entities = [(s, f"{k}:" + (v.lower() if k == "email" else v if k == "ip" else re.sub("[^0-9]", "", v))) for s, _, _, k, v in spans]
        found = [(m.start(), m.end(), m.group().lower()) for m in term.finditer(text or "")]
        held.append({e for _, e in entities})
        words.append(found)
        n_c.update({e for _, e in entities})
        n_t.update({w for _, _, w in found})
        near = {(e, w) for at, e in entities for start, _, w in found if abs(start - at) <= reach}
        n_ct.update(near)
        for at, e in entities:
            for start, _, w in found:
                if abs(start - at) <= reach:
                    seen[e, w].add(text[max(0, at - 60) : at])
    n = len(rows)
    told = {p for p, k in n_ct.items() if len(seen[p]) >= contexts and n_c[p[0]] < n and math.log(n * k / (n_c[p[0]] * n_t[p[1]])) / math.log(n / n_c[p[0]]) >= threshold}
    return [sorted({(s, 4, e, "term") for s, e, w in words[i] if any((c, w) in told for c in held[i])}) for i in range(n)]


ODD = [
    "", None, "a@b.c_d@e.f x@y", "a@b..c a@b.c. .@-.- %@1.2", "1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.1.01 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 5 55",
    "+1 (555) 123-4567 +1 555 +12345678901234567 +1--------2222222222 +1 4111 1111 1111 1111", "é漢\U0001f600 x@y.zz \U0001f6001.1.1.1",
    "9" * 50_000, "a" * 50_000 + "@", "1 " * 30_000, ".1" * 30_000, "+1" + " " * 30_000, "x@y.z " * 3000, "a.b" * 20_000 + "@c.d", "a@" * 10_000, "+" * 10_000,
]


def _spans(row):
    return [(s.start, s.nr, s.end, s.kind) for s in row.spans]


def test_odd_texts_equal_the_plain_search(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    for row in pii.find(df).collect():
        assert [s for s in _spans(row) if s[3] != "term"] == [x[:4] for x in plain(row.text)], (row.text or "")[:50]


def _planted():
    rows = []
    for i in range(200):
        filler = " ".join(f"w{chr(97 + i % 26)}{chr(97 + j)}" for j in range(12))
        rows.append((i, f"{filler} common words here nothing else"))
    for i, name in enumerate(["Anna writes from one place", "then again some other text", "who else could it have been"]):
        rows.append((300 + i, f"{name} ask Zorvath about it at z.k@corp.example.com or phone, says common Quillon {'x' * i}"))
    rows += [(400 + i, "the same copied text with Brimmel near b@corp.example.com each time") for i in range(6)]
    return rows


def test_terms_that_give_an_entity_away(spark):
    rows = _planted()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(df).collect()}
    want = disclosed(rows)
    for (doc_id, text), terms in zip(rows, want, strict=True):
        assert [s for s in _spans(got[doc_id]) if s[3] == "term"] == terms
    marked = {rows[i][1][s:e] for i, t in enumerate(want) for s, _, e, _ in t}
    assert {"Zorvath", "Quillon"} <= marked and "common" not in marked and "Brimmel" not in marked
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert "Zorvath" not in clean[300] and "[EMAIL]" in clean[300] and "common" in clean[300]
    assert clean[5] == rows[5][1]


def test_repeated_and_null_rows(spark):
    rows = [(1, "mail a@b.cc"), (1, "mail a@b.cc"), (None, "mail a@b.cc"), (2, None)]
    got = pii.find(spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", pii.F.lit(3))).collect()
    assert sorted(len(r.spans) for r in got) == [0, 1, 1, 1]


def test_query_equals_the_plain_search(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect())
    terms = disclosed(rows)
    got = {r.doc_id: r for r in QUERIES["op7_pii"](spark, DATA).collect()}
    assert len(got) == len(rows)
    for (doc_id, text), more in zip(rows, terms, strict=True):
        base = [x[:4] for x in plain(text)]
        show = lambda spans: ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)
        row = got[doc_id]
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(sum(x[3] == k for x in base) for k in PATTERNS)
        assert row.base_sha256 == hashlib.sha256(show(base).encode()).hexdigest()
        assert row.spans == show(sorted(base + more))
