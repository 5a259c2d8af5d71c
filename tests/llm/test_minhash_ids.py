"""Near-duplicates where an id occurs with different texts."""

from rungworks.llm import minhash

A = "alpha words stand here and are like nothing else at all"
B = "other words were written there by somebody of a different mind"
C = "a third text has been put down that no one ever saw"


def _kept(spark, rows):
    return sorted((r.doc_id, r.text) for r in minhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string, x int")).collect())


def test_an_id_with_two_unlike_texts_keeps_both(spark):
    rows = [(5, A, 1), (5, B, 2), (5, A, 3), (7, C, 4)]
    assert _kept(spark, rows) == [(5, A), (5, B), (7, C)]


def test_a_unique_text_stays_though_its_id_holds_a_copy(spark):
    rows = [(5, A, 1), (5, B, 2), (3, B, 3), (8, "", 4), (8, C, 5), (2, C, 6)]
    assert _kept(spark, rows) == [(2, C), (3, B), (5, A), (8, "")]


def test_links_of_both_texts_of_an_id_are_found(spark):
    rows = [(5, A), (5, B), (7, A.upper()), (9, B + " indeed so"), (11, B + " indeed so"), (12, C)]
    got = minhash.mark_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=70).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [
        (5, 5, True), (5, 5, True), (7, 5, False), (9, 5, False), (11, 5, False), (12, 12, True),
    ]
