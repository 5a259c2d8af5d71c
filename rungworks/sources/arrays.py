"""Whole-file JSON whose documents are dealt over many tasks, however large one file is.

Spark reads a multi-line JSON file in one task.  Here a file is read as text cut after every ``}``, an
ASCII character, so that Spark's own splitting of text files deals it by byte ranges and never cuts
a code point.  Whether a ``}`` ends a document depends on all that comes before it: whether
that leaves a string open, and how deep it is nested.  Both are prefix sums:

1. each range finds how it changes the two, for both ways it may begin (in a string or not);
2. a running sum over the ranges, a row each, says how every range really begins;
3. each range cuts itself into documents.  Those that lie across ranges are put together from
   pieces, of which a range has two at most.

So no document is shuffled but those at the borders.  Files that Spark can not split (compressed
ones) are a range of their own.  A file is an array of objects, or objects one after another;
numbers and nulls between them are left out, strings and arrays spoil the object that follows, whose
text then fails its contract.  Empty files hold no documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rungworks.functions import filenames
from rungworks.session import stage
from rungworks.sources.tables import _setting

_RANGES = "file STRING, start BIGINT, opens STRING, odd BOOLEAN, deeper BIGINT, deeper_in BIGINT"
_PIECES = "file STRING, start BIGINT, kind STRING, payload STRING"


def _pieces(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    text = spark.read.option("lineSep", "}").text(paths)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _scanner():
    """A function that says of a piece, less its ``}``: does it change whether a string is open; and by
    how much it goes deeper if it begins outside a string, and if it begins inside one."""
    escaped = re.compile(r"\\.", re.DOTALL)

    def depth(text: str) -> int:
        return text.count("{") + text.count("[") - text.count("}") - text.count("]")

    def scan(piece: str) -> tuple[bool, int, int]:
        parts = (escaped.sub("", piece) if "\\" in piece else piece).split('"')
        return len(parts) % 2 == 0, depth("".join(parts[::2])), depth("".join(parts[1::2]))

    return scan


def _ranges(pieces: DataFrame) -> DataFrame:
    """``file, start, opens`` (first character), and how the range changes string and depth."""
    scan = _scanner()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, opens, odd, deep, out = None, "", False, [0, 0], []
        for batch in batches:
            for file, start, piece in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (file, start) != key:
                    if key is not None:
                        out.append((*key, opens, odd, *deep))
                    key, opens, odd, deep = (file, start), "", False, [0, 0]
                opens = opens or piece.lstrip("\ufeff \t\r\n")[:1] or "}"
                turns, plain, inside = scan(piece)
                # A range that begins inside a string is, piece by piece, where the other one is not.
                now = (inside, plain) if odd else (plain, inside)
                odd = odd != turns
                deep = [deep[0] + now[0] - (not odd), deep[1] + now[1] - odd]
        if key is not None:
            out.append((*key, opens, odd, *deep))
        columns = list(zip(*out, strict=True)) or [[]] * 6
        types = [pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["file", "start", "opens", "odd", "deeper", "deeper_in"])

    return pieces.mapInArrow(run, _RANGES)


def _begun(ranges: DataFrame) -> DataFrame:
    """``file, start, inside, depth, base``: how each range begins, and the depth its documents lie at."""
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(F.col("odd").cast("int")).over(before) % 2 == 1, F.lit(False))
    known = ranges.withColumns({"inside": inside, "base": (F.first("opens").over(order) == "[").cast("int")})
    change = F.when(F.col("inside"), F.col("deeper_in")).otherwise(F.col("deeper"))
    depth = F.coalesce(F.sum(change).over(before), F.lit(0))
    return known.withColumn("depth", depth).select("file", "start", "inside", "depth", "base")


def _cut(pieces: DataFrame, begun: DataFrame) -> DataFrame:
    """``file, start, kind, payload``: whole documents, and the pieces at both ends of each range.

    ``head`` ends a document that began before, ``tail`` begins one that ends later, ``through``
    is a range within one document.
    """
    scan = _scanner()
    # A row per range, under a millionth of its bytes; and only so do the pieces keep their order.
    known = F.broadcast(begun.withColumnsRenamed({"file": "f", "start": "s"}))
    told = pieces.join(known, (F.col("file") == F.col("f")) & (F.col("start") == F.col("s")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, closed, inside, depth, out = None, [], False, False, 0, []

        def document(text: str) -> str | None:
            """From the first brace; what comes before it is what parts documents."""
            at = text.find("{")
            return text[at:] if at >= 0 else None

        for batch in batches:
            for file, start, piece, begins_in, begins_at, base in zip(*[batch.column(c).to_pylist() for c in ("file", "start", "value", "inside", "depth", "base")], strict=True):
                if (file, start) != key:
                    if key is not None:
                        out.append((*key, "tail" if closed else "through", "".join(held)))
                    key, held, closed, inside, depth = (file, start), [], start == 0, begins_in, begins_at
                turns, plain, within = scan(piece)
                depth += within if inside else plain
                inside = inside != turns
                held.append(piece + "}")
                if not inside:
                    depth -= 1
                    if depth == base:
                        text = "".join(held)
                        out.append((*key, "whole" if closed else "head", document(text) if closed else text))
                        held, closed = [], True
            if out:
                yield batch_of(out)
                out = []
        if key is not None:
            yield batch_of([(*key, "tail" if closed else "through", "".join(held))])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["file", "start", "kind", "payload"])

    return told.mapInArrow(run, _PIECES)


def split_documents(spark: SparkSession, paths: str | Sequence[str], bytes_per_task: int | None = None) -> DataFrame:
    """The documents of whole-file JSON as text: ``file_name, payload``, a row per object.

    ``bytes_per_task`` bounds the ranges; without it they are as large as the session says.  The documents are
    staged.  Nothing is said about their order.
    """
    pieces = _pieces(spark, paths)
    size = str(bytes_per_task) if bytes_per_task else spark.conf.get("spark.sql.files.maxPartitionBytes")
    with _setting(spark, "spark.sql.files.maxPartitionBytes", size):
        begun = stage(_begun(stage(_ranges(pieces), "array-ranges")), "array-begun")
        cut = stage(_cut(pieces, begun), "array-documents")
    ends = cut.where(F.col("kind") != "whole")
    # Every tail begins a group, which holds what follows it up to a head.
    group = F.sum((F.col("kind") == "tail").cast("int")).over(Window.partitionBy("file").orderBy("start", F.col("kind") == "tail"))
    grouped = ends.withColumn("group", group).groupBy("file", "group")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "payload"))), lambda p: p["payload"]), "")
    across = grouped.agg(text.alias("text"), F.max((F.col("kind") == "head").cast("int")).alias("ended")).where("ended = 1")
    across = across.select("file", F.expr("substr(text, instr(text, '{'))").alias("payload"))
    whole = cut.where("kind = 'whole' AND payload IS NOT NULL").select("file", "payload")
    return whole.unionByName(across).select(filenames.base_name("file").alias("file_name"), "payload")
