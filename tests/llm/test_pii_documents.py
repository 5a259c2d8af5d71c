"""Terms that give an entity away from anywhere in a document, and behind a constant context."""

from rungworks.llm import pii

FILL = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "klmnp"]


def _filler(i, n=80):
    return " ".join(FILL[(i * 7 + k * (i + 1)) % len(FILL)] + "x" for k in range(n))


def _marked(spark, rows):
    got = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {(r.doc_id, r.text[s.start : s.end]) for r in got for s in r.spans if s.kind == "term"}


def _plain(i):
    return (i, f"{_filler(i)} nothing of note")


def test_a_term_a_page_away_discloses(spark):
    rows = [_plain(i) for i in range(150)]
    rows += [(300 + i, f"Zorvath {_filler(i)} write to z.k@corp.example.com {_filler(i + 9, 3)}") for i in range(4)]
    marked = _marked(spark, rows)
    assert {(300 + i, "Zorvath") for i in range(4)} <= marked and not any(w == "nothing" for _, w in marked)


def test_a_constant_context_counts_each_document_and_copies_once(spark):
    rows = [_plain(i) for i in range(150)]
    rows += [(300 + i, f"z.k@corp.example.com Zorvath {_filler(i)}") for i in range(4)]
    copy = f"b@corp.example.com Brimmel {_filler(3)}"
    rows += [(400 + i, copy if i % 2 else copy.upper().replace(" ", "  ")) for i in range(6)]
    rows += [(300, rows[150][1])] * 3  # repeated rows are one document
    marked = _marked(spark, rows)
    assert {(301, "Zorvath"), (303, "Zorvath")} <= marked and not any(w.lower() == "brimmel" for _, w in marked)


def test_a_corpus_repeated_as_a_whole_gives_the_same_terms(spark):
    rows = [_plain(i) for i in range(40)]
    rows += [(300 + i, f"Zorvath {_filler(i)} z.k@corp.example.com") for i in range(4)]
    once = _marked(spark, rows)
    assert {(300 + i, "Zorvath") for i in range(4)} <= once
    assert _marked(spark, rows * 3) == once


def test_work_grows_with_the_length_of_a_text(spark):
    import time

    def taken(n):
        rows = [(1, " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(n)) + " a@b.example.com")]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        start = time.perf_counter()
        pii.find(df).collect()
        return time.perf_counter() - start

    taken(10)
    assert taken(16_000) < taken(10) + 5
