"""Streams whose memory is kept in Spark's state store and bounded by watermarks.

:mod:`rungworks.streaming.ingest` holds the forms that keep their memory in tables, so that
nothing is ever too late.  Here a *lateness* is agreed: how far a row may lie behind the newest one
seen in earlier batches.  In return no batch reads what earlier batches wrote; a batch costs
what it brings, and the state holds the rows of the lateness (and tolerance) and no more.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rungworks import schemas
from rungworks.sources import tables
from rungworks.streaming.ingest import run

_MILLI = timedelta(milliseconds=1)


def _text(span: timedelta) -> str:
    return f"{span // _MILLI} milliseconds"


def _slice(time: str, width: timedelta) -> Column:
    """Number of the slice of time, ``width`` long (whole seconds), that a time lies in."""
    seconds = -(-width // timedelta(seconds=1))
    return F.floor(F.unix_seconds(F.col(time)) / seconds)


def interval_lookup(
    probes: DataFrame,
    evidence: DataFrame,
    *,
    key: str,
    probe_ts: str,
    evidence_ts: str,
    value: str,
    tolerance: timedelta,
    lateness: timedelta,
) -> DataFrame:
    """For each probe, the latest evidence before it, no older than the tolerance; both are streams.

    A stream-stream join within the interval, then the newest evidence of each (key, time) probed.  An
    answer is final: it comes when the watermarks say that nothing more can change it.
    Probes and evidence may come in any order as long as neither is later than ``lateness``; of
    evidence at one time the greatest value counts; equal probes are one.  Rows without a key or
    time, and evidence without a value, take no part.  State: probes and evidence of
    the last ``lateness`` + ``tolerance``.

    Keys are cut by time: a probe meets evidence of its own slice and the one before,
    so a crowded key is dealt over as many tasks as it has slices.
    """
    kind = dict(probes.dtypes)[probe_ts]
    moment = lambda c: F.col(c).cast("timestamp").alias(c)
    asked = (
        probes.where(F.col(key).isNotNull() & F.col(probe_ts).isNotNull())
        .select(key, moment(probe_ts))
        .withWatermark(probe_ts, _text(lateness))
        .withColumn("slice", _slice(probe_ts, tolerance))
    )
    known = (
        evidence.where(F.col(key).isNotNull() & F.col(evidence_ts).isNotNull() & F.col(value).isNotNull())
        .select(F.col(key).alias("_key"), F.col(evidence_ts).cast("timestamp").alias("_seen"), F.col(value).alias("_value"))
        .withWatermark("_seen", _text(lateness))
        .withColumn("_slice", F.explode(F.array(_slice("_seen", tolerance), _slice("_seen", tolerance) + 1)))
    )
    before = (F.col("_seen") < F.col(probe_ts)) & (F.col("_seen") >= F.col(probe_ts) - F.lit(tolerance))
    met = asked.join(known, (F.col(key) == F.col("_key")) & (F.col("slice") == F.col("_slice")) & before)
    # As a plain value the evidence's time is no event time, of which an aggregate takes only one.
    told = met.select(key, probe_ts, F.struct(F.col("_seen").cast(kind).alias("at"), "_value").alias("told"))
    newest = told.groupBy(key, probe_ts).agg(F.max("told").alias("told"))
    return newest.select(key, F.col(probe_ts).cast(kind).alias(probe_ts), F.col("told._value").alias(value), F.col("told.at").alias("evidence_ts"))


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream's rows to a folder, each once, and stop when everything that has arrived is done."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").outputMode("append").start(path)


#: Groups that the keys of :func:`changed_counters` are dealt to.
BUCKETS = 1024


def _text_of(field: T.StructField) -> Column:
    """A key as text that :func:`_of_text` turns into the same key."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.BinaryType):
        return F.hex(value)
    if isinstance(field.dataType, T.FractionalType):
        value = value + F.lit(0).cast(field.dataType)  # of the two zeros the positive one
    return value.cast("string")


def _of_text(field: T.StructField, text: str) -> Column:
    value = F.unhex(text) if isinstance(field.dataType, T.BinaryType) else F.col(text).cast(field.dataType)
    return value.alias(field.name)


def changed_counters(
    counters: DataFrame,
    keys: Sequence[str],
    *,
    counter: str,
    at: str,
    lateness: timedelta,
    keep: timedelta,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The keys whose counter moved, with the counter handed over ``previous``\\ ly, batch by batch.

    The state is one counter and time per key.  Of a key's rows in a batch the newest counts (of
    one time the greatest counter), and only if it is newer than what is held; it is handed over if
    the counter differs, up or down, or if none is held.  A key not seen for ``keep`` is
    forgotten and handed over as new when it comes back; rows later than ``lateness`` are left out.
    Rows without a counter or time take no part; null keys are keys, which are of plain types.

    Keys are dealt to ``buckets`` groups by their hash, and a group's state holds its keys: Python is
    called per bucket and batch, not per key.  The number is fixed when a stream begins; only
    buckets that a batch brings rows for, or that hold a key to forget, are read and written.

    The state belongs to the batch: one that fails in the sink is repeated from the state before
    it, and gives the very same rows.
    """
    own = counters.select(*keys).schema.fields
    names = [f"_key{i}" for i in range(len(own))]
    moving = counters.where(F.col(counter).isNotNull() & F.col(at).isNotNull())
    told = moving.select(
        *[_text_of(f).alias(n) for f, n in zip(own, names, strict=True)],
        F.col(counter).cast("long").alias("_counter"),
        F.col(at).cast("timestamp").alias("_at"),
    ).withWatermark("_at", _text(lateness))
    dealt = told.withColumns({"_time": F.unix_micros("_at"), "_bucket": F.pmod(F.xxhash64(*names), F.lit(buckets))})
    kept_ms = keep // _MILLI

    def until(held: tuple[int, int]) -> int:
        return held[0] // 1000 + kept_ms

    def step(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """The state of a bucket is {key: (time in microseconds, counter)}."""
        held = pickle.loads(bytes(state.get[0])) if state.exists else {}
        came: dict[tuple, tuple[int, int]] = {}
        for frame in () if state.hasTimedOut else frames:
            columns = [[None if v != v else v for v in frame[n]] for n in names]  # NaN stands for null
            found = zip(frame["_time"].tolist(), frame["_counter"].tolist(), strict=True)
            for key, newest in zip(zip(*columns, strict=True), found, strict=True):
                if key not in came or came[key] < newest:
                    came[key] = newest
        moved = []
        for key, newest in came.items():
            was = held.get(key)
            held[key] = newest if was is None else max(was, newest)
            if was is None or held[key][1] != was[1]:
                moved.append((*key, was and was[1], held[key][1], held[key][0]))
        now = state.getCurrentWatermarkMs()
        held = {k: h for k, h in held.items() if until(h) > now or (until(h) == now and k not in came)}
        if held:
            state.update((pickle.dumps(held),))
            state.setTimeoutTimestamp(max(min(map(until, held.values())), now + 1))
        elif state.exists:
            state.remove()
        if moved:
            out = pd.DataFrame(moved, columns=[*names, "previous", "_counter", "_time"])
            yield out.astype({"previous": "Int64"} | dict.fromkeys(names, object))

    changes = dealt.groupBy("_bucket").applyInPandasWithState(
        step,
        ", ".join([*[f"{n} STRING" for n in names], "previous BIGINT", "_counter BIGINT", "_time BIGINT"]),
        "held BINARY",
        "update",
        GroupStateTimeout.EventTimeTimeout,
    )
    return changes.select(
        *[_of_text(f, n) for f, n in zip(own, names, strict=True)],
        "previous",
        F.col("_counter").alias(counter),
        F.timestamp_micros("_time").alias(at),
    )


def hand_over(changes: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Give each batch's changes to ``handle``; the state advances when it returns, and not before."""
    return changes.writeStream.outputMode("update").foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: The newest time among all rows of the batches so far.
NEWEST = schemas.Table("newest", "newest TIMESTAMP", (), ())


def split_late(stream: DataFrame, time: str, lateness: timedelta, root: str) -> StreamingQuery:
    """Part a stream's rows into those in time and those too late, and lose none.

    A row is late if it lies ``lateness`` or more behind the newest row of earlier batches, which is
    what a watermark drops without a trace.  Both parts go to ``root/split``, a folder per
    batch, in one pass that also notes the newest time; a repeated batch writes the same again.
    Rows without a time are late.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        held = tables.read_version(spark, f"{root}/newest", NEWEST, below=number + 1).first()
        moment = F.col(time).cast("timestamp")
        in_time = moment.isNotNull() if held is None or held[0] is None else moment > F.lit(held[0]) - F.lit(lateness)
        seen = Observation(f"newest-{number}")
        marked = batch.observe(seen, F.max(moment).alias("newest")).withColumn("late", ~F.coalesce(in_time, F.lit(False)))
        marked.write.mode("overwrite").partitionBy("late").parquet(f"{root}/split/batch={number}")
        newest = max((t for t in (seen.get["newest"], held and held[0]) if t is not None), default=None)
        tables.write_version(spark.createDataFrame([(newest,)], NEWEST.schema), f"{root}/newest", number + 1)

    return run(stream, each, f"{root}/split-progress")


def first_sightings_within(stream: DataFrame, keys: Sequence[str], time: str, lateness: timedelta, root: str) -> None:
    """Each key once, from a stream whose rows may be ``lateness`` behind; later rows go to a side table.

    ``root/sightings`` gets the first row of each key, where a key is forgotten ``lateness`` after its time;
    so keys that name the time are unique there.  :func:`late_rows` reads the side table.  Every row
    of the stream is in one or the other, or repeats a key.  Works off what has arrived.
    """
    spark = stream.sparkSession
    split_late(stream, time, lateness, root).awaitTermination()
    in_time = spark.readStream.schema(stream.schema).parquet(f"{root}/split/batch=*/late=false")
    watched = in_time.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", _text(lateness))
    first = watched.dropDuplicatesWithinWatermark(list(keys)).drop("_at")
    append_stream(first, f"{root}/sightings", f"{root}/sightings-progress").awaitTermination()


def sightings(spark: SparkSession, root: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/sightings")


def late_rows(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The side table of :func:`first_sightings_within`."""
    return spark.read.schema(f"{schema}, late BOOLEAN").parquet(f"{root}/split").where("late").drop("late", "batch")
