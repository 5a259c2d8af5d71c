"""Stream forms of the incremental flows.

The file source's checkpoint is the ledger: each file is handed over once.  The
sinks are keyed merges, so a batch replayed after a failure changes nothing twice.
All queries run with ``availableNow``: they work off what has arrived and stop.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rungworks import schemas
from rungworks.operators.asof import asof_lookup
from rungworks.operators.changes import advance_state, changed_keys
from rungworks.operators.hotkeys import heavy_keys
from rungworks.operators.merge import INCOMING, rows_to_insert, upsert
from rungworks.plans.silver import Flow, load
from rungworks.session import stage, staging
from rungworks.sources import tables


def document_stream(
    spark: SparkSession, source: str, schema: str, glob: str, max_files: int | None = None
) -> DataFrame:
    """New whole-file documents in ``source`` with their ``file_name``, ``max_files`` per batch."""
    reader = spark.readStream.schema(schema).option("multiLine", True).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(source).select("*", "_metadata.file_name")


def run(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Work off everything that has arrived, batch by batch, and stop."""
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest(
    documents: DataFrame, flow: Flow, silver: str, checkpoint: str, as_of: str
) -> StreamingQuery:
    """Flatten arriving documents and insert the rows whose key the table lacks.

    ``documents`` is :func:`document_stream` or ``stream_landed``.
    """

    def insert(batch: DataFrame, _: int) -> None:
        load(flow, batch, silver, as_of)

    return run(documents, insert, checkpoint)


def first_sightings(stream: DataFrame, table: schemas.Table, path: str, checkpoint: str) -> StreamingQuery:
    """Append each key of a stream once, however late it comes and however often.

    No watermark, so nothing is dropped: what was seen before is in the table itself, of
    which only the days of a batch are read.
    """

    def each(batch: DataFrame, _: int) -> None:
        days = tables.touched_days(batch, table.time) if table.time else None
        held = tables.read_table(batch.sparkSession, path, table, days)
        tables.append(rows_to_insert(held, table.conform(batch), table.key), path, table)

    return run(stream, each, checkpoint)


def detect_changes(
    stream: DataFrame,
    counters: Callable[[DataFrame], DataFrame],
    state_root: str,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    as_of: str,
) -> StreamingQuery:
    """Hand the keys whose counter moved to ``handle``, then advance the state.

    The state table is versioned, a version per batch, and a batch reads the newest
    version below its own.  So a batch that is repeated, whether it failed in
    ``handle`` or after the state was written, hands over the very same changes.
    """
    first = tables.first_version(stream.sparkSession, state_root, checkpoint)

    def each(batch: DataFrame, number: int) -> None:
        spark, version = batch.sparkSession, first + number
        with staging(spark):
            state = tables.read_version(spark, state_root, schemas.MATCH_HISTORY_CHECKPOINT, below=version)
            seen = stage(counters(batch), "counters")
            handle(changed_keys(seen, state), number)
            landed = seen.where(F.col("current_games") > 0)
            tables.write_version(advance_state(state, landed, as_of), state_root, version)

    return run(stream, each, checkpoint)


def upsert_batches(
    stream: DataFrame,
    table: schemas.Table,
    root: str,
    rules: dict,
    checkpoint: str,
) -> StreamingQuery:
    """Merge each batch into a table, so a re-run corrects earlier rows.

    A table with a time is kept by day, and only the days of the batch are read and
    replaced (a key must stay in its day).  One without is kept as versions, one per batch.
    """
    first = 0 if table.time else tables.first_version(stream.sparkSession, root, checkpoint)

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with staging(spark):
            if table.time:
                held = tables.read_table(spark, root, table, tables.touched_days(batch, table.time))
                tables.replace_days(upsert(held, batch, table.key, rules), root, table)
            else:
                held = tables.read_version(spark, root, table, below=first + number)
                tables.write_version(upsert(held, batch, table.key, rules), root, first + number)

    return run(stream, each, checkpoint)


def lookup_batches(
    stream: DataFrame,
    evidence: Callable[[SparkSession], DataFrame],
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    key: str,
    probe_ts: str,
    evidence_ts: str,
    value: str,
    tolerance: timedelta,
) -> StreamingQuery:
    """For each arriving batch, the latest evidence within the tolerance.

    Evidence is read anew per batch and only from the batch's time range; evidence that comes
    after its probe's batch is not seen (see :func:`lookup_streams`).
    """

    def each(batch: DataFrame, number: int) -> None:
        first, last = batch.agg(F.min(probe_ts), F.max(probe_ts)).first()
        if first is None:
            return
        known = evidence(batch.sparkSession)
        near = known.where(F.col(evidence_ts).between(F.lit(first - tolerance), F.lit(last)))
        found = asof_lookup(
            batch,
            near,
            key=key,
            probe_ts=probe_ts,
            evidence_ts=evidence_ts,
            value=value,
            tolerance=tolerance,
            dense_keys=heavy_keys(near, key),
        )
        handle(found, number)

    return run(stream, each, checkpoint)


def lookup_streams(
    probes: DataFrame,
    evidence: DataFrame,
    root: str,
    checkpoint: str,
    *,
    key: str,
    probe_ts: str,
    evidence_ts: str,
    value: str,
    tolerance: timedelta,
) -> tuple[StreamingQuery, schemas.Table]:
    """The latest evidence within the tolerance, where probes and evidence both arrive.

    Both are kept below ``root`` by day.  A batch looks up its own probes, and again those kept
    that its evidence can reach, in all evidence so far; ``root/found`` (the table returned
    beside the query) holds the answers.  So late evidence corrects an answer however late it
    comes, and a replayed batch changes nothing.
    """
    kinds = {f.name: f.dataType.simpleString() for f in [*evidence.schema.fields, *probes.schema.fields]}
    ddl = lambda *names: ", ".join(f"`{n}` {kinds[n]}" for n in names)

    def by_day(name: str, columns: tuple[str, ...], time: str, unique: tuple[str, ...]) -> schemas.Table:
        return schemas.Table(name, ddl(*columns), unique, unique, time=time)

    kinds["evidence_ts"] = kinds[evidence_ts]
    asked = by_day("asked", (key, probe_ts), probe_ts, (key, probe_ts))
    known = by_day("known", (key, evidence_ts, value), evidence_ts, (key, evidence_ts, value))
    found = by_day("found", (key, probe_ts, value, "evidence_ts"), probe_ts, (key, probe_ts))
    arriving = probes.select(key, F.col(probe_ts).alias("_at"), F.lit(None).cast(kinds[value]).alias("_value"), F.lit(True).alias("_asks")).unionByName(
        evidence.select(key, F.col(evidence_ts).alias("_at"), F.col(value).alias("_value"), F.lit(False).alias("_asks"))
    )
    path = lambda table: f"{root}/{table.name}"

    def keep(rows: DataFrame, table: schemas.Table) -> DataFrame:
        days = tables.touched_days(rows, table.time)
        held = tables.read_table(rows.sparkSession, path(table), table, days)
        tables.append(stage(rows_to_insert(held, rows, table.key), table.name), path(table), table)
        return rows

    def within(session: SparkSession, table: schemas.Table, days: set) -> DataFrame:
        return tables.read_table(session, path(table), table, sorted(days))

    def around(rows: DataFrame, time: str, earlier: timedelta, later: timedelta) -> set:
        """Days from ``earlier`` before to ``later`` after any day of the rows."""
        days = tables.touched_days(rows, time)
        return {d + timedelta(days=n) for d in days for n in range(-_days(earlier), _days(later) + 1)}

    def each(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        with staging(session):
            came = stage(batch.where(F.col(key).isNotNull() & F.col("_at").isNotNull()), "lookup-came")
            asks = keep(came.where("_asks").select(key, F.col("_at").alias(probe_ts)), asked)
            news = came.where("NOT _asks AND _value IS NOT NULL")
            news = keep(news.select(key, F.col("_at").alias(evidence_ts), F.col("_value").alias(value)), known)
            reached = within(session, asked, around(news, evidence_ts, timedelta(0), tolerance))
            again = reached.join(news.select(key).distinct(), key, "left_semi")
            todo = stage(asks.unionByName(again).distinct(), "lookup-todo")
            near = within(session, known, around(todo, probe_ts, tolerance, timedelta(0)))
            names = {"key": key, "probe_ts": probe_ts, "evidence_ts": evidence_ts, "value": value, "tolerance": tolerance}
            answers = stage(asof_lookup(todo, near, **names, dense_keys=heavy_keys(near, key)), "lookup-answers")
            days = tables.touched_days(answers, probe_ts)
            held = tables.read_table(session, path(found), found, days)
            tables.replace_days(upsert(held, answers, found.key, {value: INCOMING, "evidence_ts": INCOMING}), path(found), found)

    return run(arriving, each, checkpoint), found


def _days(span: timedelta) -> int:
    """Days that a span can reach into besides that of its start."""
    return -(-span // timedelta(days=1))
