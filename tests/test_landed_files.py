"""Whole files: landed complete whatever Spark does to small partitions, and read once."""

import json
import os

import pytest
from pyspark.sql import functions as F

from rungworks import schemas
from rungworks.sources import documents


@pytest.fixture
def fine_partitions(spark):
    """Partitions of a few kilobytes stay apart, smaller ones are put together, as at size."""
    confs = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    for name, value in confs.items():
        spark.conf.set(name, value)
    yield
    for name in confs:
        spark.conf.unset(name)


def _members(spark, files, each):
    number = F.col("id").cast("string")
    member = F.to_json(
        F.struct(
            (F.col("id") % 3).alias("ladder_id"),
            F.struct(F.array(F.struct(F.struct(number.alias("id")).alias("character"), (F.col("id") * 7).alias("points"), F.lit("é" * 40).alias("favoriteRaceP1"))).alias("ladderMembers")).alias("data"),
        )
    )
    name = F.concat(F.lit("legacy_ladders_raw_"), (F.col("id") % files).cast("string"), F.lit("_2026-03-07_0440.json"))
    return spark.range(files * each).select(name.alias("file_name"), member.alias("payload"))


def test_every_file_is_a_whole_array_in_the_order_of_its_documents(spark, tmp_path, fine_partitions):
    docs = _members(spark, 9, 200)
    assert documents.land_files(docs, str(tmp_path), "file_name", "payload") == 9
    want = {}
    for r in docs.collect():
        want.setdefault(r.file_name, []).append(r.payload)
    for name, payloads in want.items():
        text = (tmp_path / name).read_text(encoding="utf-8")
        assert text == "[" + "\n,".join(sorted(payloads)) + "\n]\n"
        assert len(json.loads(text)) == 200


def _bytes_read(spark):
    return sum(s.getBytesRead() for s in spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def test_a_file_is_not_read_again_for_its_numbers(spark, tmp_path):
    documents.land_files(_members(spark, 1, 2000), str(tmp_path), "file_name", "payload")
    path = str(tmp_path / "legacy_ladders_raw_0_2026-03-07_0440.json")
    before = _bytes_read(spark)
    found = documents.read_documents(spark, [path], schemas.LEGACY_LADDER_DOCUMENT).select(F.explode("data.ladderMembers.points").alias("p"))
    assert found.agg(F.sum(F.col("p").cast("long"))).first()[0] == sum(7 * i for i in range(2000))
    assert _bytes_read(spark) - before < 3 * os.path.getsize(path)


@pytest.mark.parametrize("size", [70, 1000, 10**8])
def test_a_file_that_spark_would_cut_gives_each_document_once(spark, tmp_path, size):
    exact = ["1.50", "1e5", "123456789012345678901234567890", "-0.0", '"x"', "true"]
    path = tmp_path / "some.json"
    path.write_text("[" + ",\n ".join('{"ladder_id": %s}' % text for text in exact) + "]\n")  # noqa: UP031
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        found = documents.read_documents(spark, str(path), schemas.LEGACY_LADDER_DOCUMENT).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.ladder_id, r.file_name) for r in found] == [(text.strip('"'), "some.json") for text in exact]
