"""Documents of whole-file JSON, cut by byte ranges of any size."""

import json
import random

import pytest

from rungworks.sources import arrays

NASTY = [
    {"a": "}{][\"\\\\", "b": [{"c": {}}, []], "é漢😀": "}\\\\\\\"{"},
    {},
    {"text": "x\\\\\"}, {\"y\": 1}" * 5, "n": None},
    {"deep": [[[{"k": "[["}]]], "z": " \u0000\\"},
    {"long": "€}" * 400},
    {"tail": "\\\\"},
]


def _split(spark, path, size):
    found = arrays.split_documents(spark, str(path), bytes_per_task=size).collect()
    return sorted((r.file_name, json.dumps(json.loads(r.payload), sort_keys=True)) for r in found)


def _want(name, documents):
    return sorted((name, json.dumps(d, sort_keys=True)) for d in documents)


@pytest.mark.parametrize("size", [97, 1000, 10**6])
@pytest.mark.parametrize("style", ["compact", "indented", "lines", "bom", "ascii"])
def test_documents_come_out_whole_wherever_the_file_is_cut(spark, tmp_path, size, style):
    rng = random.Random(style)
    documents = [rng.choice(NASTY) for _ in range(9)]
    text = {
        "compact": json.dumps(documents, ensure_ascii=False, separators=(",", ":")),
        "indented": json.dumps(documents, ensure_ascii=False, indent=3) + "\n\n",
        "lines": "\n".join(json.dumps(d, ensure_ascii=False) for d in documents),
        "bom": "\ufeff \n" + json.dumps(documents, ensure_ascii=False),
        "ascii": json.dumps(documents),
    }[style]
    path = tmp_path / f"{style}.json"
    path.write_text(text, encoding="utf-8")
    assert _split(spark, path, size) == _want(f"{style}.json", documents)


def test_several_files_and_what_holds_no_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(NASTY))
    (tmp_path / "b.json").write_text(json.dumps(NASTY[0]))
    for name, text in {"c": "[]", "d": "", "e": " \n", "f": "[1, null, {}, 2]"}.items():
        (tmp_path / f"{name}.json").write_text(text)
    want = _want("a.json", NASTY) + _want("b.json", [NASTY[0]]) + [("f.json", "{}")]
    for size in (60, 10**6):
        assert _split(spark, tmp_path, size) == sorted(want)


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "one.json"
    path.write_text(json.dumps([{"n": i, "text": "x" * 200} for i in range(5000)]))
    found = arrays.split_documents(spark, str(path), bytes_per_task=100_000)
    assert found.count() == 5000
    pieces = arrays._pieces(spark, str(path))
    with arrays._setting(spark, "spark.sql.files.maxPartitionBytes", "100000"):
        assert len({r.start for r in pieces.select("start").distinct().collect()}) > 8
