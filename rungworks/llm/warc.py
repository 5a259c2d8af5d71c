"""WARC archives: writing records, and reading them back by boundary chains.

Archives are compressed text output of Spark, one record a row.  They are read back in
pieces that end where the next line of magic comes after an empty line, wherever that may be
(plain archives may be split among tasks).  So every piece is a *candidate* record, those
inside a payload too.  A candidate's header says where its successor starts.  Only
records that the chain of successors reaches from the file's start are real; the rest is
payload and is put back into the record that holds it.

The chain is followed by pointer jumping.  Neighbours that succeed each other form runs; each run
points to the run that holds its last record's successor, and doubling these pointers
reaches all runs from the first in a number of rounds that is the logarithm of the runs of a
file (none, where no payload holds magic).  Windows are over one archive, a file of
``RECORDS`` records at most, whose pieces are shuffled once with their payloads.

Everything is built-in column code; staged tables go to the shared folder.  Defined
results: a null payload is empty; a null url has no header; line breaks in urls are
escaped; of records with equal payloads all that have the largest id are responses (the row and its
repeats), a null id is largest only among nulls; empty tables give empty archives.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rungworks.session import scratch_path, stage

MAGIC = "WARC/1.1\r\n"
GAP = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads of at least so many bytes are stored once.
LEAST_REVISITED = 0
#: Records of an archive at most; a task that writes more begins another.
RECORDS = 2048
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: five hexadecimal digits make four letters."""
    digest = F.sha1(payload)
    letters = []
    for group in range(8):
        value = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(_BASE32), F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*letters)


def with_record_types(pages: DataFrame, least: int = LEAST_REVISITED) -> DataFrame:
    """Rows with ``id`` and ``payload`` (not null) with ``refers_to``, null for a response."""
    flat = pages.withColumn("_key", F.sha2(F.col("payload").cast("binary"), 256))
    # Staged, so that Spark knows how small it is and need not shuffle the payloads to meet it.
    first = stage(flat.where(F.octet_length("payload") >= least).groupBy("_key").agg(F.max("id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n"), "warc-repeated")
    revisits = F.when(~F.col("id").eqNullSafe(F.col("_first")), F.col("_first"))
    return flat.join(first, "_key", "left").withColumn("refers_to", revisits).drop("_key", "_first")


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _urn(value: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(value.cast("string"), F.lit("")), F.lit(">"))


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST_REVISITED) -> None:
    """Write a record per page below ``path``; a repeated payload is written once."""
    flat = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    typed = with_record_types(flat, least=least)
    again = F.col("refers_to").isNotNull()
    address = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    block = F.when(again, F.lit("")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit(MAGIC),
        _header("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", _urn(F.col("id"))),
        _header("WARC-Target-URI", address),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload").cast("binary")))),
        _header("WARC-Refers-To", F.when(again, _urn(F.col("refers_to")))),
        _header("WARC-Profile", F.when(again, F.lit(PROFILE))),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(GAP), block,
    )
    typed.select(record.alias("value")).write.option("maxRecordsPerFile", RECORDS).option("lineSep", GAP).option("compression", "gzip").text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between two lines of magic, with the place it was read at and its header's fields."""
    read = spark.read.option("lineSep", GAP + MAGIC).text(path)
    head = F.substring_index("value", GAP, 1)
    field = lambda name, what: F.regexp_extract("head", rf"(?i)(?:^|\r\n){name}:[ \t]*{what}[ \t]*(?:\r\n|$)", 1)
    empty = lambda c: F.when(c != "", c)
    told = read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nr"), head.alias("head"))
    return told.select(
        "file", "block", "nr", F.octet_length("value").alias("bytes"), F.octet_length("head").alias("head_bytes"),
        F.col("value").startswith(MAGIC).alias("opens"), F.col("value").cast("binary").alias("value"),
        empty(field("Content-Length", "([0-9]{1,18})")).cast("long").alias("length"),
        empty(field("WARC-Type", "([a-z]+)")).alias("type"),
        empty(field("WARC-Record-ID", "<urn:page:(-?[0-9]+)>")).cast("long").alias("id"),
        empty(field("WARC-Refers-To", "<urn:page:(-?[0-9]+)>")).cast("long").alias("refers_to"),
        empty(field("WARC-Target-URI", "([^\\r\\n]*)")).alias("url"),
        empty(field("WARC-Payload-Digest", "sha1:([A-Z2-7]{32})")).alias("told_digest"),
    )


def _boundaries(pieces: DataFrame) -> DataFrame:
    """Pieces with their start and successor in the file and the run they are in.

    ``joined`` says that the next piece is the successor, ``last`` that the file ends there.
    """
    in_file = W.partitionBy("file").orderBy("block", "nr")
    step = F.col("bytes") + len(GAP + MAGIC)
    laid = pieces.withColumn("at", F.sum(step).over(in_file) - step)
    start = F.when(F.col("at") == 0, F.lit(0)).otherwise(F.col("at") - len(MAGIC))
    real = (F.col("at") > 0) | F.col("opens")
    after = F.when(real, F.col("at") + F.col("head_bytes") + len(GAP) + F.col("length") + len(GAP))
    named = laid.withColumns({"start": start, "next": after})
    follows = named.withColumn("follows", F.lead("start").over(in_file))
    told = follows.withColumn("joined", F.coalesce(F.col("next") == F.col("follows"), F.lit(False)))
    told = told.withColumn("last", F.col("follows").isNull() & F.coalesce(F.col("next") == F.col("at") + F.col("bytes"), F.lit(False)))
    broken = F.coalesce(~F.lag("joined").over(in_file), F.lit(False)).cast("long")
    return told.withColumn("run", F.sum(broken).over(in_file)).drop("block", "nr", "at", "bytes", "opens", "follows")


def _reached(boundaries: DataFrame) -> DataFrame:
    """``file, run, entry``: the runs on the chain from the file's start, and where it enters them."""
    runs = boundaries.groupBy("file", "run").agg(F.max_by("next", "start").alias("exit"), F.min("start").alias("first"))
    inside = boundaries.select(F.col("file").alias("f"), F.col("start").alias("s"), F.col("run").alias("to"))
    jumps = runs.join(inside, (F.col("file") == F.col("f")) & (F.col("exit") == F.col("s"))).select("file", "run", "to", F.col("s").alias("entry"))
    found = runs.where("run = 0 AND first = 0").select("file", "run", F.lit(0).cast("long").alias("entry"))
    most = runs.agg(F.max("run").alias("most")).first()["most"] or 0
    for _ in range(math.ceil(math.log2(most + 1))):
        jumps = stage(jumps, "warc-jumps")
        by = jumps.select(F.col("file").alias("f"), F.col("run").alias("r"), F.col("to").alias("to2"), F.col("entry").alias("entry2"))
        ahead = found.join(by, (F.col("file") == F.col("f")) & (F.col("run") == F.col("r"))).select("file", F.col("to2").alias("run"), F.col("entry2").alias("entry"))
        found = stage(found.unionByName(ahead).dropDuplicates(["file", "run"]), "warc-reached")
        jumps = jumps.join(by, (F.col("file") == F.col("f")) & (F.col("to") == F.col("r"))).select("file", "run", F.col("to2").alias("to"), F.col("entry2").alias("entry"))
    return found


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives: ``id, url, type, refers_to, told_digest, payload`` (binary).

    A record that the file ends in the middle of is left out.
    """
    pieces = _pieces(spark, path)
    narrow = stage(_boundaries(pieces).select("file", "start", "next", "run"), "warc-boundaries")
    reached = stage(_reached(narrow), "warc-runs").select(F.col("file").alias("f"), F.col("run").alias("r"), "entry")
    full = _boundaries(pieces)
    records = full.join(reached, (F.col("file") == F.col("f")) & (F.col("run") == F.col("r"))).where("start >= entry AND next IS NOT NULL")
    told = ("id", "url", "type", "refers_to", "told_digest", "length", "head_bytes")
    whole = records.where("joined OR last").select(*told, "value")
    # The rest hold magic in their payload: their pieces in order, with the magic between them.
    spans = stage(records.where("NOT joined AND NOT last").select(F.col("file").alias("f"), F.col("start").alias("owner"), F.col("next").alias("stop"), *[F.col(c).alias(f"o_{c}") for c in told]), "warc-spans")
    torn = pieces.join(spans.select(F.col("f").alias("file")).distinct(), "file", "left_semi")
    parts = _boundaries(torn).join(spans, (F.col("file") == F.col("f")) & (F.col("start") >= F.col("owner")) & (F.col("start") < F.col("stop")))
    gathered = parts.groupBy("f", "owner").agg(F.array_sort(F.collect_list(F.struct("start", "value"))).alias("rows"), *[F.first(f"o_{c}").alias(c) for c in told])
    between = F.lit((GAP + MAGIC).encode())
    joined = F.aggregate(F.filter("rows", lambda r, i: i > 0), F.col("rows")[0]["value"], lambda got, r: F.concat(got, between, r["value"]))
    payload = F.expr(f"substring(value, head_bytes + {len(GAP) + 1}, cast(least(length, 2147483647) AS int))")
    read = whole.unionByName(gathered.select(*told, joined.alias("value"))).withColumn("payload", payload)
    return read.where(F.octet_length("payload") == F.col("length")).drop("value", "length", "head_bytes")


def resolve(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of records.

    A response is measured by the payload that was read, a revisit by that of the response
    it refers to.
    """
    measured = records.select(
        F.col("id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(F.col("type") == "revisit", F.col("told_digest")).otherwise(base32_sha1(F.col("payload"))).alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to",
    )
    measured = stage(measured, "warc-measured")
    own = measured.where("record_type = 'response'")
    kept = own.groupBy(F.col("page_id").alias("k_id"), F.col("payload_digest").alias("k_digest")).agg(F.max("payload_bytes").alias("k_bytes"))
    same = (F.col("refers_to") == F.col("k_id")) & (F.col("payload_digest") == F.col("k_digest"))
    seen = measured.where("record_type = 'revisit'").join(kept, same, "left").withColumn("payload_bytes", F.col("k_bytes"))
    return own.unionByName(seen.select(own.columns))


def archive_and_read(pages: DataFrame, **options: object) -> DataFrame:
    """Write the pages as archives in the shared folder and give the records read back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, **options)  # type: ignore[arg-type]
    return read_archives(spark, path)
