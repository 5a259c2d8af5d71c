"""Byte-level BPE: encoding with offsets, and decoding.

Pre-tokenisation is vectorised.  Each code point gets a class, refined by what follows it
(a space before a word, an apostrophe before a clitic); a class is a function from
automaton state to automaton state, and since composing functions is associative, the state
before every code point comes from a scan by blocks over the functions' numbers.  State
and class tell where a slice starts; no regular expression is run.  A slice is
merged once and remembered.

A task works on one Arrow batch after another and on at most ``CHUNK`` bytes of
short texts at a time (a text is never cut, so a longer one is a piece of its own).  Lost
tasks are simply run again; nothing is kept outside a task but its cache, which is bounded.

Defined results: null texts encode to no tokens and decode to an empty text, as empty ones
do; lone surrogates cannot occur in a string column; repeated rows and ids are
independent; empty tables give empty tables; other columns pass through, and a column that
has the name of a result is replaced by it.
"""

from __future__ import annotations

import base64
import heapq
import struct
import sys
import unicodedata
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rungworks.llm.common import ship

CHUNK = 1_000_000
CACHED_SLICES = 150_000
#: Slices longer than this are merged each time instead of being remembered.
LONGEST_CACHED = 64
NONE_MADE = np.int32(2**31 - 1)

# Classes of code points, the last four being refinements by what follows.
LETTER, NUMBER, OTHER, SPACE, BLANK, CLITIC1, CLITIC2, BIND, LAST, START = range(10)
# States: what the code point before belongs to.
NONE, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_BLANKS, BOUND, ONE_LEFT, TWO_LEFT = range(8)


def _step(kind: int, state: int) -> int:
    """State after a code point of class ``kind`` read in ``state``."""
    if state == TWO_LEFT:
        return ONE_LEFT
    if state == ONE_LEFT:
        return NONE
    if kind in (LETTER, NUMBER, OTHER):
        return {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHER}[kind]
    if kind in (SPACE, BLANK):
        return IN_BLANKS
    if kind == BIND:
        return BOUND
    if kind == LAST:
        return NONE
    if kind in (CLITIC1, CLITIC2):
        if state in (IN_OTHER, BOUND):
            return IN_OTHER
        return ONE_LEFT if kind == CLITIC1 else TWO_LEFT
    return NONE


def _starts(kind: int, state: int) -> bool:
    """Whether a slice starts at a code point of class ``kind`` read in ``state``."""
    if state in (ONE_LEFT, TWO_LEFT, BOUND):
        return False
    same = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHER, CLITIC1: IN_OTHER, CLITIC2: IN_OTHER, SPACE: IN_BLANKS, BLANK: IN_BLANKS}
    return same.get(kind) != state


@cache
def _machine() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The transition functions under composition, by number.

    Returns the number of each class's function, the composition table (first, then), what
    each function makes of the state NONE, and the start table (class, state).  The first
    code point of a text is read through a constant function before its own, so the table of
    classes has each class twice: inside a text, and first in one.
    """
    own = [tuple(_step(k, s) for s in range(8)) for k in range(START)]
    first = [(f[NONE],) * 8 for f in own]
    numbers = {tuple(range(8)): 0}
    for f in own + first:
        numbers.setdefault(f, len(numbers))
    known = list(numbers)
    done = 0
    while done < len(known):  # close the set under composition with the generators
        f = known[done]
        done += 1
        for g in own + first:
            h = tuple(g[s] for s in f)
            if h not in numbers:
                numbers[h] = len(numbers)
                known.append(h)
    table = np.array([[numbers[tuple(g[s] for s in f)] for g in known] for f in known], dtype=np.int16)
    of_class = np.array([numbers[f] for f in own + first], dtype=np.int16)
    from_none = np.array([f[NONE] for f in known], dtype=np.int8)
    starts = np.array([[_starts(k, s) for s in range(8)] for k in range(START)])
    return of_class, table, from_none, starts


@cache
def _classes() -> np.ndarray:
    """Class of every code point, by Unicode category; white space as Unicode defines it."""
    of_category = {"L": LETTER, "N": NUMBER}
    # Code points with the property White_Space.
    white = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    found = np.fromiter((of_category.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), dtype=np.int8, count=sys.maxunicode + 1)
    found[white] = BLANK
    found[0x20] = SPACE
    return found


def _scan(functions: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Inclusive scan of function numbers under composition, by blocks."""
    n = len(functions)
    if n <= 64:
        out = functions.copy()
        for i in range(1, n):
            out[i] = table[out[i - 1], out[i]]
        return out
    width = 64
    rows = -(-n // width)
    grid = np.zeros((rows, width), dtype=functions.dtype)  # 0 is the identity
    grid.reshape(-1)[:n] = functions
    grid = np.ascontiguousarray(grid.T)  # a step for all blocks at once
    for i in range(1, width):
        grid[i] = table[grid[i - 1], grid[i]]
    before = np.zeros(rows, dtype=functions.dtype)
    before[1:] = _scan(grid[-1].copy(), table)[:-1]
    return np.ascontiguousarray(table[before[None, :], grid].T).reshape(-1)[:n]


def slice_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Places where a slice starts in texts laid end to end as code points.

    ``text_starts`` holds the places where a text that is not empty starts.
    """
    of_class, table, from_none, starts = _machine()
    n = len(points)
    kinds = _classes()[points]
    is_first = np.zeros(n + 1, dtype=bool)
    is_first[text_starts] = True
    is_first[n] = True
    ends = is_first[1:]  # the text ends with this code point
    white = (kinds == SPACE) | (kinds == BLANK)
    white_next = np.ones(n, dtype=bool)
    white_next[:-1] = white[1:]
    lone = white & ~white_next & ~ends
    quotes = np.flatnonzero((points == 0x27) & ~ends)
    spaces = kinds == SPACE
    kinds[lone] = LAST
    kinds[lone & spaces] = BIND
    if len(quotes):
        one = points[quotes + 1]
        kinds[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = CLITIC1
        after = quotes[~is_first[np.minimum(quotes + 2, n)]]
        pair = points[after + 1].astype(np.int64) << 32 | points[after + 2]
        kinds[after[np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])]] = CLITIC2
    functions = of_class[kinds + START * is_first[:n].astype(np.int8)]
    states = np.empty(n, dtype=np.int8)
    states[0:1] = NONE
    states[1:] = from_none[_scan(functions, table)[:-1]]
    states[text_starts] = NONE
    return np.flatnonzero(starts[kinds, states] | is_first[:n])


@cache
def _packed(n: int) -> struct.Struct:
    return struct.Struct(f"={n}i")


class Merger:
    """Token ids of a slice's bytes: the pair of lowest rank is merged until none is known."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        #: Slices met lately and their ids, as the bytes of 32-bit integers, in two
        #: generations: the older one is dropped when the younger is full.
        self.known: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.lengths = np.fromiter(map(len, self.tokens), dtype=np.int32, count=len(self.tokens))

        self._bytes = np.fromiter((ranks[bytes([b])] for b in range(256)), dtype=np.int32, count=256)
        # Pairs of tokens that make a token, wherever it is cut.
        pairs = sorted((ranks[t[:k]] << 32 | ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks)
        self._pairs = np.array([p for p, _ in pairs] or [-1], dtype=np.int64)
        self._makes = np.array([r for _, r in pairs] or [0], dtype=np.int32)

    def learn(self, pieces: Sequence[bytes]) -> dict[bytes, bytes]:
        """Ids of slices that ``known`` lacks; those that are not too long are remembered."""
        found, short = {}, []
        for piece in set(pieces):
            got = self._older.get(piece)
            if got is None and (whole := self.ranks.get(piece)) is not None:
                got = _packed(1).pack(whole)
            elif got is None and len(piece) > LONGEST_CACHED:
                got = np.array(self._merged_long(piece), dtype=np.int32).tobytes()
            if got is None:
                short.append(piece)
            else:
                found[piece] = got
        short.sort(key=len)
        for start in range(0, len(short), 4096):
            part = short[start : start + 4096]
            found.update(zip(part, self._merged_many(part), strict=True))
        if len(self.known) + len(found) > CACHED_SLICES:
            self._older, self.known = self.known, {}
        self.known.update((p, c) for p, c in found.items() if len(p) <= LONGEST_CACHED)
        return found

    def _made(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that two tokens make, NONE if there is no such token."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        return np.where((self._pairs[at] == key) & (a >= 0) & (b >= 0), self._makes[at], NONE_MADE)

    def _merged_many(self, pieces: Sequence[bytes]) -> list[bytes]:
        """Merges of many short slices side by side: in each round, the lowest pair of each."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        columns = np.arange(int(lengths.max()))
        ids = np.full((len(pieces), len(columns)), -1, dtype=np.int32)
        ids[columns < lengths[:, None]] = self._bytes[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        done = ids.copy()
        rows = np.arange(len(pieces))
        made = np.full(ids.shape, NONE_MADE, dtype=np.int32)
        made[:, :-1] = self._made(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = made.argmin(axis=1)
            low = made[np.arange(len(rows)), at]
            more = low < NONE_MADE
            done[rows[~more]] = ids[~more]
            rows, ids, made, at, low = rows[more], ids[more], made[more], at[more], low[more]
            if not len(rows):
                break
            each = np.arange(len(rows))
            ids[each, at] = low
            following = np.minimum(columns + (columns > at[:, None]), len(columns) - 1)
            ids, made = np.take_along_axis(ids, following, axis=1), np.take_along_axis(made, following, axis=1)
            ids[:, -1] = -1  # a merge leaves one place free
            made[:, -1] = NONE_MADE
            right = np.minimum(at + 1, len(columns) - 1)
            made[each, at] = np.where(at < len(columns) - 1, self._made(low, ids[each, right]), NONE_MADE)
            left = at > 0
            made[each[left], at[left] - 1] = self._made(ids[each[left], at[left] - 1], low[left])
        counts = (done >= 0).sum(axis=1)
        flat = done[done >= 0].tobytes()
        edges = [0, *np.cumsum(counts * 4).tolist()]
        return [flat[a:b] for a, b in zip(edges, edges[1:])]  # noqa: B905

    def _merged_long(self, piece: bytes) -> list[int]:
        """By a heap of pairs, for slices of any length."""
        ranks, n = self.ranks, len(piece)
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or after[i] >= n or end[after[i]] != stop:
                continue
            j = after[i]
            alive[j] = False
            after[i], end[i] = after[j], end[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get(piece[i : end[after[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[after[i]]))
            if before[i] >= 0:
                b = before[i]
                if (r := ranks.get(piece[b : end[i]])) is not None:
                    heapq.heappush(heap, (r, b, end[i]))
        return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


_loaded: dict[str, Merger] = {}


def _merger(path: str) -> Merger:
    """The vocabulary of a task's process, read once."""
    if path not in _loaded:
        _loaded[path] = Merger(read_ranks(path))
    return _loaded[path]


def _chunks(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most CHUNK bytes together, or one text."""
    start = size = 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and size + n > CHUNK:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield start, len(lengths)


def encode_texts(texts: Sequence[str], merge: Merger) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts end to end, and where each text's ids start and end."""
    whole = "".join(texts)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    if not whole:
        return np.empty(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
    data = whole.encode("utf-8")
    points = np.frombuffer(whole.encode("utf-32-le"), dtype=np.int32)
    edges = np.concatenate([[0], np.cumsum(lengths)])
    first = slice_starts(points, edges[:-1][lengths > 0])
    if len(data) == len(points):
        places = first
    else:
        width = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
        places = (np.cumsum(width, dtype=np.int64) - width)[first]
    starts = places.tolist()
    pieces = [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)])]  # noqa: B905
    coded = list(map(merge.known.get, pieces))
    missing = [i for i, c in enumerate(coded) if c is None]
    if missing:
        found = merge.learn([pieces[i] for i in missing])
        for i in missing:
            coded[i] = found[pieces[i]]
    ids = np.frombuffer(b"".join(coded), dtype=np.int32)
    tokens = np.concatenate([[0], np.cumsum(np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) >> 2)])
    return ids, tokens[np.searchsorted(first, edges)]


def _encoded(batches: Iterator[pa.RecordBatch], merge: Merger, place: int, names: Sequence[str], offsets: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(place)
        for a, b in _chunks(pc.coalesce(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)):
            rows = batch.slice(a, b - a)
            ids, edges = encode_texts([t or "" for t in rows.column(place).to_pylist()], merge)
            arrays = [ids]
            if offsets:
                ends = np.cumsum(merge.lengths[ids], dtype=np.int64)
                before = np.concatenate([[0], ends])[edges[:-1]]
                arrays.append((ends - np.repeat(before, np.diff(edges))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(x)) for x in arrays]
            yield pa.RecordBatch.from_arrays([*rows.columns, *lists], names=names)


def _decoded(batches: Iterator[pa.RecordBatch], tokens: Sequence[bytes], place: int, names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            rows = batch.slice(start, 256)
            column = rows.column(place)
            pieces = list(map(tokens.__getitem__, column.flatten().to_numpy(zero_copy_only=False).tolist()))
            edges = np.concatenate([[0], np.cumsum(pc.coalesce(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))]).tolist()
            texts = [b"".join(pieces[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, type=pa.binary())], names=names)


def _coded_schema(base: DataFrame, offsets: bool) -> T.StructType:
    results = ["ids", "ends"] if offsets else ["ids"]
    return T.StructType([*base.schema.fields, *[T.StructField(r, T.ArrayType(T.IntegerType(), False)) for r in results]])


def encode(df: DataFrame, ranks: str, text: str = "text", offsets: bool = True) -> DataFrame:
    """``df`` with ``ids`` and, if wanted, ``ends``: where each token ends in the text's bytes.

    ``ranks`` is the path of a rank file that every task can open.
    """
    base = df.drop("ids", "ends")
    schema = _coded_schema(base, offsets)
    names, place = schema.names, base.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _encoded(batches, _merger(ranks), place, names, offsets)

    ship(df.sparkSession)
    return base.mapInArrow(run, schema)


def decode(df: DataFrame, ranks: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the bytes that the ids stand for."""
    base = df.drop("decoded")
    schema = T.StructType([*base.schema.fields, T.StructField("decoded", T.BinaryType())])
    names, place = schema.names, base.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decoded(batches, _merger(ranks).tokens, place, names)

    ship(df.sparkSession)
    return base.mapInArrow(run, schema)


def encode_and_decode(df: DataFrame, ranks: str, text: str = "text", offsets: bool = True) -> DataFrame:
    """:func:`encode`, then :func:`decode`, by one Python process a task instead of two.

    Ids go from one to the other in chunks of ``CHUNK`` bytes of text; between two processes Spark would gather
    them, with the texts, into batches of 10,000 rows, which is most of the memory that both take.
    """
    base = df.drop("ids", "ends", "decoded")
    coded = _coded_schema(base, offsets)
    schema = T.StructType([*coded.fields, T.StructField("decoded", T.BinaryType())])
    between, names, place = coded.names, schema.names, base.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = _merger(ranks)
        encoded = _encoded(batches, merge, place, between, offsets)
        return _decoded(encoded, merge.tokens, between.index("ids"), names)

    ship(df.sparkSession)
    return base.mapInArrow(run, schema)


def digests(df: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``."""
    listed = F.array_join(F.col(ids).cast("array<string>"), " ")
    return df.withColumns({"n_tokens": F.size(ids).cast("long"), "ids_sha256": F.sha2(listed.cast("binary"), 256), "decoded_sha256": F.sha2(F.col(decoded), 256)})
