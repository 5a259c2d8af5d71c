"""Streams whose memory is bounded by watermarks."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from tests.helpers import rows

from rungworks.streaming import state

AT = datetime(2026, 1, 1)
PROBE, EVIDENCE = "k INT, t TIMESTAMP_NTZ", "k INT, s TIMESTAMP_NTZ, v STRING"


def _minutes(n):
    return AT + timedelta(minutes=n)


class Lookup:
    """Two arriving sources and the answers."""

    def __init__(self, spark, tmp_path):
        self.spark, self.tmp = spark, tmp_path
        for name, ddl in (("probes", PROBE), ("evidence", EVIDENCE)):
            spark.createDataFrame([], ddl).write.parquet(str(tmp_path / name))

    def run(self, probes=(), evidence=()):
        for name, ddl, came in (("probes", PROBE, probes), ("evidence", EVIDENCE, evidence)):
            if came:
                self.spark.createDataFrame(list(came), ddl).write.mode("append").parquet(str(self.tmp / name))
        streams = [self.spark.readStream.schema(d).parquet(str(self.tmp / n)) for n, d in (("probes", PROBE), ("evidence", EVIDENCE))]
        found = state.interval_lookup(
            *streams, key="k", probe_ts="t", evidence_ts="s", value="v", tolerance=timedelta(minutes=90), lateness=timedelta(minutes=30)
        )
        query = state.append_stream(found, str(self.tmp / "found"), str(self.tmp / "progress"))
        query.awaitTermination()
        return query

    def close(self):
        return self.run([(-1, _minutes(10**6))], [(-1, _minutes(10**6), "end")])

    def answers(self):
        return rows(self.spark.read.schema("k INT, t TIMESTAMP_NTZ, v STRING, evidence_ts TIMESTAMP_NTZ").parquet(str(self.tmp / "found")), "k", "t", "v")


def test_interval_lookup_takes_the_latest_evidence_whatever_comes_first(spark, tmp_path):
    lookup = Lookup(spark, tmp_path)
    lookup.run(probes=[(1, _minutes(100)), (1, _minutes(100)), (2, _minutes(100)), (None, _minutes(100)), (3, None)])
    lookup.run(evidence=[(1, _minutes(80), "first"), (2, _minutes(9), "too old"), (None, _minutes(90), "no key")])
    assert lookup.answers() == []
    lookup.run(evidence=[(1, _minutes(99), "Zerg"), (1, _minutes(99), "Terran"), (1, _minutes(100), "same time"), (2, _minutes(10), "just"), (2, _minutes(50), None)])
    lookup.close()
    assert lookup.answers() == [(1, _minutes(100), "Zerg"), (2, _minutes(100), "just")]


def test_interval_lookup_equals_brute_force_and_its_state_is_bounded(spark, tmp_path):
    rng = random.Random(4)
    lookup, probes, evidence = Lookup(spark, tmp_path), [], []
    came = [(("p", (1 if rng.random() < 0.5 else rng.randrange(2, 6), _minutes(rng.randrange(6000))))) for _ in range(600)]
    came += [(("e", (1 if rng.random() < 0.5 else rng.randrange(2, 6), _minutes(rng.randrange(6000)), f"v{i}"))) for i in range(600)]
    arrival = lambda row: row[1][1] + timedelta(minutes=rng.randrange(30))
    by_batch = {}
    for row in came:
        by_batch.setdefault((arrival(row) - AT) // timedelta(minutes=1500), []).append(row)
    held = []
    for _, batch in sorted(by_batch.items()):
        new_probes, new_evidence = [r for kind, r in batch if kind == "p"], [r for kind, r in batch if kind == "e"]
        probes, evidence = probes + new_probes, evidence + new_evidence
        progress = lookup.run(new_probes, new_evidence).lastProgress
        held.append(sum(op.numRowsTotal for op in progress.stateOperators))
        assert all(op.numRowsDroppedByWatermark == 0 for op in progress.stateOperators)
    lookup.close()
    want = set()
    for k, t in probes:
        near = [(s, v) for q, s, v in evidence if q == k and t - timedelta(minutes=90) <= s < t]
        if near:
            want.add((k, t, max(near)[1]))
    assert lookup.answers() == sorted(want, key=repr)
    # Each batch brings about 300 rows of 1500 minutes; what is held is of the last 120 and does not add up.
    assert len(held) >= 4
    assert max(held[1:]) < 150


def _hand_over(spark, tmp_path, handle):
    ddl = "k INT, region STRING, n BIGINT, t TIMESTAMP"
    stream = spark.readStream.schema(ddl).parquet(str(tmp_path / "in"))
    changes = state.changed_counters(stream, ["k", "region"], counter="n", at="t", lateness=timedelta(minutes=30), keep=timedelta(minutes=100))
    state.hand_over(changes, handle, str(tmp_path / "progress")).awaitTermination()


def test_counters_that_moved_are_handed_over_once(spark, tmp_path):
    ddl, got = "k INT, region STRING, n BIGINT, t TIMESTAMP", []

    def arrive(*values):
        spark.createDataFrame([(k, "eu", n, t and _minutes(t)) for k, n, t in values], ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def collect(batch, _):
        got.extend(rows(batch, "k", "previous", "n"))

    def turn(*values):
        got.clear()
        arrive(*values)
        _hand_over(spark, tmp_path, collect)
        return sorted(got, key=repr)

    assert turn((1, 5, 10), (1, 7, 20), (2, 1, 20), (3, None, 20), (4, 9, None), (None, 6, 20)) == [(1, None, 7), (2, None, 1), (None, None, 6)]
    assert turn((1, 7, 30), (2, 0, 30)) == [(2, 1, 0)]  # the same again, and a decrease
    assert turn((2, 8, 25), (1, 8, 31), (1, 6, 31)) == [(1, 7, 8)]  # an older row, and two of one time

    # A batch that fails in the sink is repeated from the state before it.
    def fail(batch, _):
        batch.count()
        raise RuntimeError("down")

    arrive((1, 20, 40), (5, 1, 40))
    with pytest.raises(StreamingQueryException, match="down"):
        _hand_over(spark, tmp_path, fail)
    got.clear()
    _hand_over(spark, tmp_path, collect)
    assert sorted(got, key=repr) == [(1, 8, 20), (5, None, 1)]
    # Time passes: keys not seen for 100 minutes are forgotten, what is too late is left out.
    assert turn((6, 1, 200)) == [(6, None, 1)]
    assert turn((1, 20, 201), (2, 3, 100)) == [(1, None, 20)]
    assert turn((6, 1, 202)) == []


def test_keys_share_a_bucket_and_keep_their_own_counters_and_times(spark, tmp_path):
    """Many keys in few groups, against a model that knows every key by itself."""
    ddl, rng = "k BIGINT, z DOUBLE, n BIGINT, t TIMESTAMP_NTZ", random.Random(11)
    held, watermark, big = {}, None, 2**60 + 1
    for batch in range(5):
        keys = [(rng.choice([None, big, big + 1, *range(30 * batch, 30 * batch + 60)]), rng.choice([0.0, -0.0, None, 0.1])) for _ in range(200)]
        values = [(*k, rng.randrange(3), _minutes(100 * batch + rng.randrange(100))) for k in keys]
        spark.createDataFrame(values, ddl).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(ddl).parquet(str(tmp_path / "in"))
        changes = state.changed_counters(stream, ["k", "z"], counter="n", at="t", lateness=timedelta(minutes=150), keep=timedelta(minutes=160), buckets=3)
        got = []
        query = state.hand_over(changes, lambda df, _: got.extend(rows(df, "k", "z", "previous", "n", "t")), str(tmp_path / "progress"))  # noqa: B023
        query.awaitTermination()
        newest = {}
        for k, z, n, t in values:
            newest[k, z] = max(newest.get((k, z), (t, n)), (t, n))
        want = []
        for key, came in newest.items():
            was = held.get(key)
            held[key] = max(was, came) if was else came
            if was is None or held[key][1] != was[1]:
                want.append((*key, was and was[1], held[key][1], held[key][0]))
        assert len(got) == len(want)
        assert set(got) == set(want)
        passed = max(t for *_, t in values) - timedelta(minutes=150)
        watermark = max(watermark or passed, passed)
        held = {k: h for k, h in held.items() if h[0] + timedelta(minutes=160) >= watermark}
        assert sum(op.numRowsTotal for op in query.lastProgress.stateOperators) <= 3


def test_sightings_in_time_and_a_side_table_lose_no_row(spark, tmp_path):
    ddl, root = "n INT, k INT, t TIMESTAMP_NTZ", str(tmp_path / "out")
    rng, sent = random.Random(9), []
    for batch in range(4):
        values = [(1000 * batch + i, rng.randrange(4), _minutes(100 * batch + rng.randrange(-120, 100))) for i in range(150)]
        values += [(9000 + batch, 1, None)]
        sent.append(values)
        spark.createDataFrame(values, ddl).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(ddl).parquet(str(tmp_path / "in"))
        state.first_sightings_within(stream, ["k", "t"], "t", timedelta(minutes=60), root)
    newest, late, in_time = None, [], []
    for values in sent:
        for n, k, t in values:
            (late if t is None or (newest and t <= newest - timedelta(minutes=60)) else in_time).append((n, k, t))
        newest = max([t for *_, t in values if t] + [newest] * (newest is not None))
    assert late and in_time
    assert rows(state.late_rows(spark, root, ddl)) == sorted(late, key=repr)
    seen = rows(state.sightings(spark, root, ddl), "k", "t")
    assert seen == sorted({(k, t) for _, k, t in in_time}, key=repr)
    progress = spark.readStream.schema(ddl).parquet(str(tmp_path / "in"))
    query = state.split_late(progress, "t", timedelta(minutes=60), root)
    query.awaitTermination()
    assert rows(state.late_rows(spark, root, ddl)) == sorted(late, key=repr)


def test_a_split_that_is_repeated_writes_the_same(spark, tmp_path, monkeypatch):
    ddl, root = "n INT, t TIMESTAMP_NTZ", str(tmp_path / "out")
    spark.createDataFrame([(1, _minutes(0)), (2, _minutes(500))], ddl).write.parquet(str(tmp_path / "in"))
    run = lambda: state.split_late(spark.readStream.schema(ddl).parquet(str(tmp_path / "in")), "t", timedelta(minutes=60), root).awaitTermination()
    write = state.tables.write_version

    def lost(*args, **kw):
        write(*args, **kw)
        raise RuntimeError("lost")

    run()
    spark.createDataFrame([(3, _minutes(10)), (4, _minutes(900)), (5, _minutes(450))], ddl).write.mode("append").parquet(str(tmp_path / "in"))
    monkeypatch.setattr(state.tables, "write_version", lost)
    with pytest.raises(StreamingQueryException, match="lost"):
        run()
    monkeypatch.setattr(state.tables, "write_version", write)
    run()
    # The newest time that the failed batch noted makes nothing late when the batch is repeated.
    assert rows(state.late_rows(spark, root, ddl), "n") == [(3,)]
