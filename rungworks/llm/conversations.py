"""Repair of the turn structure of conversations by weighted CYK parsing of intervals.

A sound conversation is ``(s?(ua)+)?`` in the initials of its roles: perhaps a system turn, then
user and assistant by turns.  Each row is kept, given another role, or deleted, and empty turns can
be inserted; the cheapest edits are those of the cheapest parse of the rows under a repair grammar in
Chomsky normal form.  Its nonterminals ``X(p,q)`` stand for rows that lead the
sound form from state p to state q; the rules are ``X(p,q) -> X(p,r) X(r,q)`` and, for one row,
the edits of that row; insertions are unit rules, closed beforehand.  A chart cell is the least
(cost, audit) of a nonterminal over a span of rows, where the audit names the edits by their
initials.  Two audits of equal cost over one span are never one the other's beginning, since the rest
could only be insertions, which cost; so least cells combine to least cells.

Spans of up to ``BLOCK`` rows get a whole chart, filled bottom-up by span length over all
places to split, once per pattern of rows.  Longer spans are put together from such blocks, again
by span length, two neighbours of equal length at a time: as the nonterminals name both ends,
every place to split gives the same cell, so one is enough, and a conversation costs
time in proportion to its rows.  Rows are dealt by ranges of (conversation, turn), so a
conversation of any size is parsed by many tasks, each of which hands on one cell per nonterminal.

Repaired turns stream through tasks in order, next to their audit; a task holds a batch of them and
no conversation whole.  All turns of one conversation pass through one task there, since the digest of
its text is taken in order.  A conversation's audit is one value, as is that of its cells.

Null roles and texts count as one space; a null conversation id is a conversation of its own.  Rows go
by turn, null first, then by role and the MD5 of the text, so rows that are alike lie side by
side, however often they are repeated; they are counted before they are dealt.  A role that does not
begin with s, u or a can not be kept, nor can an empty one.  Empty tables give
empty results.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rungworks.llm.common import _SPACE_CHARS, ship
from rungworks.session import stage

#: States of the sound form: nothing yet, after system, after user, after assistant; and where it may end.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
#: Prices of the edits: fixed values of the contract.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLOCK = 8
_STATES = range(4)
_KEYS = [(p, q) for p in _STATES for q in _STATES]

Cell = tuple[int, str]
Cells = dict[tuple[int, int], Cell]


def least(cells: Cells, key: tuple[int, int], cell: Cell) -> None:
    if key not in cells or cell < cells[key]:
        cells[key] = cell


def joined(left: Cells, right: Cells) -> Cells:
    """``X(p,q) -> X(p,r) X(r,q)`` over two neighbouring spans."""
    found: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for q in _STATES:
            if (r, q) in right:
                more = right[r, q]
                least(found, (p, q), (cost + more[0], audit + more[1]))
    return found


def _insertions() -> Cells:
    """Cells of the empty span: nothing, or the fewest insertions that lead from p to q."""
    found: Cells = {(p, p): (0, "") for p in _STATES}
    one = {**found}
    for (p, role), q in STEPS.items():
        if role in "ua":
            least(one, (p, q), (INSERT, "I"))
    for _ in _STATES:
        found = joined(found, one)
    return found


EMPTY = _insertions()


@lru_cache(maxsize=64)
def row_cells(kind: str) -> Cells:
    """Cells of one row.  Its kind is its role's initial or ``o``, in capitals if truncated, or ``d`` if it must go."""
    edits: Cells = {(p, p): (DELETE, "D") for p in _STATES}
    if kind != "d":
        extra = TRUNCATED if kind.isupper() else 0
        for (p, role), q in STEPS.items():
            if role == kind.lower():
                least(edits, (p, q), (extra, "K"))
            elif role in "ua":
                least(edits, (p, q), (REROLE + extra, "R"))
    return joined(joined(EMPTY, edits), EMPTY)


@lru_cache(maxsize=1 << 15)
def parse_block(kinds: str) -> Cells:
    """The cells of a few rows: a whole chart, by span length, over all places to split."""
    n = len(kinds)
    chart = {(i, i + 1): row_cells(kind) for i, kind in enumerate(kinds)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cells: Cells = {}
            for split in range(i + 1, i + length):
                for key, cell in joined(chart[i, split], chart[split, i + length]).items():
                    least(cells, key, cell)
            chart[i, i + length] = cells
    return chart[0, n]


class Spans:
    """Spans side by side, of which two of equal length become one, so that few are held."""

    def __init__(self) -> None:
        self.held: list[tuple[int, Cells]] = []

    def add(self, cells: Cells, length: int = 1) -> None:
        while self.held and self.held[-1][0] <= length:
            before, left = self.held.pop()
            cells, length = joined(left, cells), before + length
        self.held.append((length, cells))

    def whole(self) -> Cells:
        cells = [c for _, c in self.held]
        return reduce(lambda right, left: joined(left, right), reversed(cells)) if cells else EMPTY


def copies(cells: Cells, n: int) -> Cells:
    """The cells ``n`` times side by side."""
    result = EMPTY
    while n:
        if n & 1:
            result = joined(result, cells)
        cells, n = joined(cells, cells), n >> 1
    return result


class Parser:
    """Takes runs of rows of one kind in order, and gives the cells of all of them."""

    def __init__(self) -> None:
        self.spans, self.block = Spans(), ""

    def add(self, kind: str, n: int) -> None:
        if n > BLOCK:
            self._close()
            self.spans.add(copies(row_cells(kind), n))
            return
        self.block += kind * n
        while len(self.block) >= BLOCK:
            whole, self.block = self.block[:BLOCK], self.block[BLOCK:]
            self.spans.add(parse_block(whole))

    def _close(self) -> None:
        if self.block:
            self.spans.add(parse_block(self.block))
            self.block = ""

    def cells(self) -> Cells:
        self._close()
        return self.spans.whole()


def plain(df: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with nulls of role and text as one space."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return df.select("conv_id", "turn", *told)


def damaged(df: DataFrame) -> DataFrame:
    """The rows of (conv_id, turn, role, text) after the contract's damage; nulls of role and text as one space.

    The hash of conversation and turn says what happens: 0 drops the row, 1 empties its text, 2 takes the
    full stops and marks from it, 3 repeats it, 4 makes its role user.
    """
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    rows = plain(df).withColumn("hit", hit).where("hit <> 0")
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("hit") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_time")).drop("_time")


def _order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("mark").asc()]


def faults(rows: DataFrame) -> DataFrame:
    """Rows that are alike as one, with their number ``n`` and the first fault of the first of them.

    ``blank``, ``duplicate`` (role and text come earlier in the conversation) and ``truncated`` are
    booleans, of which one at most is true.
    """
    trimmed = F.rtrim("text", F.lit(_SPACE_CHARS))
    looked = plain(rows).select("conv_id", "turn", "role", F.md5("text").alias("mark"), trimmed.alias("t"))
    narrow = looked.select("conv_id", "turn", "role", "mark", (F.col("t") == "").alias("blank"), (F.col("t") != "").alias("said") & ~F.substring("t", -1, 1).isin(".", "!", "?"))
    narrow = narrow.toDF("conv_id", "turn", "role", "mark", "blank", "cut")
    alike = stage(narrow.groupBy("conv_id", "turn", "role", "mark").agg(F.first("blank").alias("blank"), F.first("cut").alias("cut"), F.count("*").alias("n")), "conversations-rows")
    first = F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("first")
    repeated = alike.groupBy("conv_id", "role", "mark").agg(first, F.count("*").alias("_n")).where("_n > 1")
    repeated = stage(repeated.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("mark").alias("m"), F.col("first.turn").alias("since")), "conversations-repeated")
    met = alike.join(repeated, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("mark") == F.col("m")), "left")
    later = F.col("r").isNotNull() & ~F.col("turn").eqNullSafe(F.col("since"))
    return met.select("conv_id", "turn", "role", "mark", "n", "blank", (~F.col("blank") & later).alias("duplicate"), (F.col("cut") & ~later).alias("truncated"))


_CELLS = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_SPANS = "conv_id {id}, part int, first string, last string, illegal long, cells array<struct<p: int, q: int, cost: long, audit: string>>"


def _broken(pair: str) -> bool:
    return pair not in ("su", "ua", "au")


def _spans(kinds: DataFrame) -> DataFrame:
    """A row per conversation and task: the cells of its rows there, in the order of ``part``."""
    schema = _SPANS.format(id=dict(kinds.dtypes)["conv_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, names = TaskContext.get().partitionId(), ["conv_id", "part", "first", "last", "illegal", "cells"]  # type: ignore[union-attr]
        conv, first, last, illegal, parser, out = None, None, "", 0, Parser(), []
        for batch in batches:
            place = batch.schema.field("conv_id").type
            for c, initial, kind, more, n in zip(*[batch.column(x).to_pylist() for x in ("conv_id", "initial", "kind", "more", "n")], strict=True):
                if first is None or c != conv:
                    if first is not None:
                        out.append((conv, part, first, last, illegal, _listed(parser.cells())))
                    conv, first, last, illegal, parser = c, initial, None, 0, Parser()
                illegal += (last is not None and _broken(last + initial)) + (n - 1) * _broken(initial + initial)
                last = initial
                parser.add(kind, 1)
                if n > 1:
                    parser.add(more, n - 1)
            if out:
                yield _batch(out, names, [place, pa.int32(), pa.string(), pa.string(), pa.int64(), _CELLS])
                out = []
        if first is not None:
            yield _batch([(conv, part, first, last, illegal, _listed(parser.cells()))], names, [place, pa.int32(), pa.string(), pa.string(), pa.int64(), _CELLS])

    ordered = kinds.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    return ordered.select("conv_id", "initial", "kind", "more", "n").mapInArrow(run, schema)


def _listed(cells: Cells) -> list[dict]:
    return [{"p": p, "q": q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in cells.items()]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _parses(spans: DataFrame) -> DataFrame:
    """``conv_id, illegal, cost, audit`` of whole conversations, from the spans of all tasks."""
    schema = f"conv_id {dict(spans.dtypes)['conv_id']}, illegal long, cost long, audit string"

    def told(conv, illegal: int, held: Spans) -> tuple:
        cells = held.whole()
        return (conv, illegal, *min(cells[0, q] for q in ENDS if (0, q) in cells))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, last, illegal, held, out = None, None, 0, Spans(), []
        for batch in batches:
            place = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if last is None or row["conv_id"] != conv:
                    if last is not None:
                        out.append(told(conv, illegal, held))
                    conv, illegal, held = row["conv_id"], 0, Spans()
                else:
                    illegal += _broken(last + row["first"])
                illegal, last = illegal + row["illegal"], row["last"]
                held.add({(c["p"], c["q"]): (c["cost"], c["audit"]) for c in row["cells"]})
            if out:
                yield _batch(out, ["conv_id", "illegal", "cost", "audit"], [place, pa.int64(), pa.int64(), pa.string()])
                out = []
        if last is not None:
            yield _batch([told(conv, illegal, held)], ["conv_id", "illegal", "cost", "audit"], [place, pa.int64(), pa.int64(), pa.string()])

    return spans.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part").mapInArrow(run, schema)


def audits(marked: DataFrame) -> DataFrame:
    """``conv_id, illegal, cost, audit`` of the conversations in ``marked`` (:func:`faults`)."""
    initial = F.substring("role", 1, 1)
    plain = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    kind = F.when(F.col("blank") | F.col("duplicate"), "d").when(F.col("truncated"), F.upper(plain)).otherwise(plain)
    kinds = stage(marked.select("conv_id", "turn", "role", "mark", "n", initial.alias("initial"), kind.alias("kind"), F.lit("d").alias("more")), "conversations-kinds")
    ship(marked.sparkSession)
    return _parses(stage(_spans(kinds), "conversations-spans"))


def repaired(rows: DataFrame, parses: DataFrame) -> DataFrame:
    """``conv_id, place, role, text``: the turns after the edits of ``parses`` (conv_id, audit).

    The turns of a conversation lie in one partition, in order.
    """
    kind = dict(rows.dtypes)["conv_id"]
    asked = plain(rows).select("conv_id", F.lit(1).alias("step"), "turn", "role", F.md5("text").alias("mark"), "text")
    told = parses.select("conv_id", F.lit(0).alias("step"), F.lit(None).cast(dict(rows.dtypes)["turn"]).alias("turn"), F.lit("").alias("role"), F.lit("").alias("mark"), F.col("audit").alias("text"))
    place = [F.col("conv_id").asc_nulls_first(), F.col("step").asc(), *_order()[1:]]
    ordered = told.unionByName(asked).repartition("conv_id").sortWithinPartitions(*place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, place, due = None, "", 0, 0, ""
        out: list[tuple] = []

        def give(role: str, text: str) -> None:
            nonlocal place, due
            out.append((conv, place, role, text))
            place, due = place + 1, "a" if due == "u" and role[:1] != "s" else "u"

        def inserted() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                give(NAMES[due], "")
                at += 1

        for batch in batches:
            kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string()]
            for c, step, role, text in zip(*[batch.column(x).to_pylist() for x in ("conv_id", "step", "role", "text")], strict=True):
                if step == 0:
                    inserted()
                    conv, audit, at, place, due = c, text, 0, 0, "u"
                    continue
                inserted()
                edit, at = audit[at], at + 1
                if edit != "D":
                    give(role if edit == "K" else NAMES[due], text)
            if out:
                yield _batch(out, ["conv_id", "place", "role", "text"], kinds)
                out.clear()
        inserted()
        if out:
            yield _batch(out, ["conv_id", "place", "role", "text"], kinds)

    ship(rows.sparkSession)
    return ordered.select("conv_id", "step", "role", "text").mapInArrow(run, f"conv_id {kind}, place long, role string, text string")


NAMES = {"u": "user", "a": "assistant"}


def digests(turns: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of the turns of :func:`repaired`, taken as they stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, out = None, None, []
        for batch in batches:
            kinds = [batch.schema.field("conv_id").type, pa.string()]
            for c, place, role, text in zip(*[batch.column(x).to_pylist() for x in ("conv_id", "place", "role", "text")], strict=True):
                if place == 0:
                    if digest is not None:
                        out.append((conv, digest.hexdigest()))
                    conv, digest = c, hashlib.sha256()
                digest.update(f"{'' if place == 0 else chr(10)}{role}:{text}".encode())
            if out:
                yield _batch(out, ["conv_id", "repaired_sha256"], kinds)
                out = []
        if digest is not None:
            yield _batch([(conv, digest.hexdigest())], ["conv_id", "repaired_sha256"], kinds)

    return turns.mapInArrow(run, f"conv_id {dict(turns.dtypes)['conv_id']}, repaired_sha256 string")


def counts(marked: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated`` of the conversations in ``marked`` (:func:`faults`).

    Gaps are turns that no row has between the first and the last; null where that exceeds a long.
    """
    plain = ~F.col("blank") & ~F.col("duplicate")
    span = F.expr("try_add(try_subtract(max(turn), min(turn)), 1 - count(DISTINCT turn))")
    return marked.groupBy("conv_id").agg(
        F.when(F.max("turn").isNull(), F.lit(0).cast("long")).otherwise(span).alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("duplicate"), F.col("n")).when(plain, F.col("n") - 1).otherwise(0)).alias("duplicate"),
        F.sum(F.col("truncated").cast("long")).alias("truncated"),
    )


def summary(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Faults, cheapest edits and the digest of the repaired turns, of each id in ``conversations``.

    A conversation without ``rows`` has zeros, no edits and the digest of nothing.
    """
    marked = stage(faults(rows), "conversations-faults")
    parses = stage(audits(marked), "conversations-audits")
    result = conversations.select("conv_id").distinct()
    for told in (counts(marked), parses, digests(repaired(rows, parses))):
        own = told.withColumnRenamed("conv_id", "_id")
        result = result.join(own, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    numbers = [F.when(F.col("cost").isNull(), F.lit(0).cast("long")).otherwise(F.col(c)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return result.select("conv_id", *numbers, *[F.coalesce(c, F.lit(v)).alias(c) for c, v in nothing.items()])
