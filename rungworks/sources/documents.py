"""Raw documents: landing them, and reading them back typed or as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rungworks.functions import filenames
from rungworks.session import scratch_path

#: Parts files read as one line: zeros stand in no JSON, and so many in no encoding of it.
NOT_JSON = "\0" * 4


def read_documents(
    spark: SparkSession, paths: str | Sequence[str], schema: str, glob: str | None = None
) -> DataFrame:
    """Whole-file JSON documents, typed: one row per object, or per element of an array.

    ``file_name`` is added.  Such a file is read by one task; land large volumes
    with :func:`land` instead, whose output splits.

    A file is read as one line, by a separator that no JSON has.  The reader of several lines goes
    back to the file for every number that is declared as text, as all numbers are here.
    """
    reader = spark.read.schema(schema).option("lineSep", NOT_JSON)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.json(paths).select("*", "_metadata.file_name")


def read_landed(spark: SparkSession, root: str, kind: str, schema: str) -> DataFrame:
    """Documents written by :func:`land`, typed, with the file name they stand for."""
    docs = spark.read.schema(_landed(schema)).json(f"{root}/kind={kind}")
    return _with_file_name(docs, F.lit(kind))


def stream_landed(
    spark: SparkSession, root: str, kind: str, schema: str, max_files: int | None = None
) -> DataFrame:
    """The same as a stream of the files as they arrive, at most ``max_files`` per batch."""
    reader = spark.readStream.schema(_landed(schema))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _with_file_name(reader.json(f"{root}/kind={kind}"), F.lit(kind))


def _landed(schema: str) -> str:
    return f"{schema}, league_id STRING, snapshot STRING"


def _with_file_name(docs: DataFrame, kind: Column) -> DataFrame:
    name = F.concat_ws("_", kind, F.nullif("league_id", F.lit("none")), "snapshot")
    return docs.withColumn("file_name", F.concat(name, F.lit(".json"))).drop("league_id", "snapshot")


def read_raw(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Whole files as text, with ``file_name``, for contract checks before any typing."""
    text = spark.read.text(paths, wholetext=True)
    return text.select("_metadata.file_name", F.col("value").alias("payload"))


def array_items(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Elements of a document that is an array, as text, with their position."""
    kept = [c for c in raw.columns if c != payload]
    elements = F.try_variant_get(F.try_parse_json(payload), "$", "array<variant>")
    items = raw.select(*kept, F.posexplode(elements).alias("position", "_item"))
    return items.select(*kept, "position", F.to_json("_item").alias(payload))


def with_key(df: DataFrame, key: str, payload: str) -> DataFrame:
    """Wrap each payload with the id it was asked for: ``{"ladder_id": ..., "data": ...}``."""
    wrapped = F.struct(F.col(key), F.parse_json(payload).alias("data"))
    return df.withColumn(payload, F.to_json(wrapped))


def with_request_ids(df: DataFrame, ids: Sequence[str], payload: str) -> DataFrame:
    """Add the request's ids to each payload object as ``request_*`` fields, all else untouched."""
    fields = F.expr(f"try_variant_get(parse_json({payload}), '$', 'map<string,variant>')")
    names = F.array(*[F.lit(f"request_{c}") for c in ids])
    values = F.array(*[F.col(c).cast("variant") for c in ids])
    # A field of that name in the payload itself gives way to the requested id.
    own = F.map_filter(fields, lambda k, v: ~F.array_contains(names, k))
    return df.withColumn(payload, F.to_json(F.map_concat(F.map_from_arrays(names, values), own)))


def land_files(df: DataFrame, root: str, file_name: str, payload: str) -> int:
    """Write documents as whole files of the given names, each an array of its documents; returns their number.

    A file is written by one task, document by document, in the order of their text.  Names reach
    the driver, which moves the files into place, as they are listed; a file of that name is replaced.
    """
    spark = df.sparkSession
    # Beginning and end go with the first and the last document: rows of their own could get into another task's file.
    order = Window.partitionBy("name").orderBy("value")
    place, last = F.row_number().over(order), F.lead(F.lit(1)).over(order).isNull()
    rows = df.select(F.col(file_name).alias("name"), F.col(payload).alias("value")).withColumns({"place": place, "last": last})
    opened = F.concat(F.when(F.col("place") == 1, "[").otherwise(","), "value")
    whole = rows.sortWithinPartitions("name", "place").select("name", F.concat(opened, F.when(F.col("last"), "\n]").otherwise("")).alias("value"))
    staged = scratch_path(spark, "land-files")
    whole.write.partitionBy("name").text(staged)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.Path(root))
    moved = 0
    for folder in fs.listStatus(hadoop.Path(staged)):
        _, _, name = folder.getPath().getName().partition("name=")
        if name:
            target = hadoop.Path(f"{root}/{name}")
            fs.delete(target, False)
            written = [s.getPath() for s in fs.listStatus(folder.getPath()) if s.getPath().getName().startswith("part-")]
            if not fs.rename(written[0], target):
                raise OSError(f"{name} could not be moved to {root}")
            moved += 1
    fs.delete(hadoop.Path(staged), True)
    return moved


def land(df: DataFrame, root: str, kind: str, payload: str, snapshot: str, league: str | None = None) -> None:
    """Append documents as JSON lines below ``kind=/league_id=/snapshot=`` folders.

    Folders prune later reads by league and time; a large league is spread over
    several files by the rebalance step instead of one writer per folder.
    """
    league_part = F.col(league).cast("string") if league else F.lit("none")
    lines = df.select(
        F.col(payload).alias("value"),
        F.lit(kind).alias("kind"),
        league_part.alias("league_id"),
        F.date_format(snapshot, filenames.STAMP_FORMAT).alias("snapshot"),
    )
    parts = ("kind", "league_id", "snapshot")
    lines.hint("rebalance", *parts).write.mode("append").partitionBy(*parts).text(root)
