"""Lookups where probes and evidence both arrive."""

from datetime import datetime, timedelta

from tests.helpers import rows

from rungworks.sources import tables
from rungworks.streaming import ingest as streams

AT = datetime(2026, 1, 1, 23, 30)


def _minutes(n):
    return AT + timedelta(minutes=n)


def test_evidence_that_comes_after_its_probe_is_found(spark, tmp_path):
    asks, tells = "k INT, t TIMESTAMP_NTZ", "k INT, s TIMESTAMP_NTZ, v STRING"
    sources = {"asks": asks, "tells": tells}
    for name, ddl in sources.items():
        spark.createDataFrame([], ddl).write.parquet(str(tmp_path / name))

    def run(**arrived):
        for name, values in arrived.items():
            spark.createDataFrame(values, sources[name]).write.mode("append").parquet(str(tmp_path / name))
        read = {n: spark.readStream.schema(d).parquet(str(tmp_path / n)) for n, d in sources.items()}
        query, found = streams.lookup_streams(
            read["asks"], read["tells"], str(tmp_path / "out"), str(tmp_path / "progress"),
            key="k", probe_ts="t", evidence_ts="s", value="v", tolerance=timedelta(minutes=90),
        )
        query.awaitTermination()
        return rows(tables.read_table(spark, f"{tmp_path}/out/{found.name}", found), "k", "t", "v")

    assert run(asks=[(1, _minutes(60)), (2, _minutes(60))]) == []  # past midnight, evidence before it
    late = [(1, _minutes(0), "Zerg"), (2, _minutes(-31), "old"), (3, _minutes(0), "none asked")]
    assert run(tells=late) == [(1, _minutes(60), "Zerg")]
    assert run(tells=[(1, _minutes(40), "Terran"), (1, _minutes(60), "same time")]) == [(1, _minutes(60), "Terran")]
