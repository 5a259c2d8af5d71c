"""Personal data: patterns, and the terms that give protected entities away.

Patterns find e-mail addresses, IP addresses, card and phone numbers.  Each value found is
a protected entity.  A term that stands in a document with an entity time and again reveals it even
where the entity itself is masked.  How much, the corpus says: with N documents, of which
n_c hold the entity, n_t the term and n_ct both, the term's
disclosure is the pointwise mutual information over the entity's own information,

    ln(N n_ct / (n_c n_t)) / ln(N / n_c),

which is 1 if the term never occurs without the entity.  Terms above a threshold are
generalised, or removed if they give away (nearly) everything.  A pair counts only if it was
seen in some number of different texts (spaces and case aside), so that copies of one text
reveal nothing.

Everything is built-in column code.  Counts cover all documents, all of them in rows, so a
corpus repeated as a whole gives the same terms; and a term meets the entities of its whole document.  Since n_ct is n_c at most, a term can only reach the threshold
with an entity if n_t <= n_c (N / n_c)^(1 - threshold); others are dropped before pairs are
formed, exactly.

Defined results: null texts are empty and have no spans; places are code points, ends
exclusive; matches of one kind do not overlap, those of different kinds may, and
``sanitise`` then replaces what comes first; terms never overlap an address (they must stand
free of its characters); repeated rows get the same spans each; empty tables give empty
tables; other columns pass through, and a column that has the name of a result is
replaced by it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rungworks.llm.common import bind, free_name
from rungworks.session import stage

# The patterns as agreed, in a form that never looks at a character more than a few times: a
# match can only start where a run of its first characters starts, or where the last ended.
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A word that is no part of an address or a number.
_TERM = r"(?<![\p{L}\p{N}@._%+-])\p{L}{2,}+(?![\p{L}\p{N}@_%+]|[.-][\p{L}\p{N}@])"

#: Different texts a pair must be seen in, and the disclosures from which a term is
#: generalised or removed.
MIN_CONTEXTS = 3
GENERALISE = 0.8
REMOVE = 0.95

TERM = "term"
RESULTS = ("spans",)


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def part(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int") * (i % 2 + 1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda total, i: total + part(i)) % 10 == 0


def _valid_ip(value: Column) -> Column:
    small = lambda p: F.try_to_number(F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))), F.lit("9999")) <= 255
    return F.forall(F.split(value, r"\."), lambda p: F.when(F.length(F.ltrim(p, F.lit("0"))) <= 3, small(p)).otherwise(False))


def _valid_card(value: Column) -> Column:
    digits = F.translate(value, " -", "")
    return F.when(F.length(digits).between(14, 19), bind(digits, _luhn)).otherwise(False)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


#: Kind, what a text must hold to be searched, pattern, test, and the value an entity is known by.
KINDS: tuple[tuple[str, str, str, Callable[[Column], Column], Callable[[Column], Column]], ...] = (
    ("email", "@", _EMAIL, lambda v: F.lit(True), F.lower),
    ("ip", ".", _IP, _valid_ip, lambda v: v),
    ("card", "", _CARD, _valid_card, _digits),
    ("phone", "+", _PHONE, lambda v: F.length(_digits(v)).between(10, 15), _digits),
)


def _before(values: Column, start: Column, combine: Callable[[Column, Column], Column], block: int = 128) -> Column:
    """For each element, all elements before it combined, in two levels of blocks."""
    fold = lambda part: F.aggregate(part, start, combine)

    def by_blocks(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / block).cast("int")), lambda b: fold(F.slice(v, b * block + 1, F.lit(block))))
        ahead = bind(blocks, lambda s: F.transform(s, lambda x, i: fold(F.slice(s, F.lit(1), i))))
        of = lambda i: F.floor(i / block).cast("int")
        return bind(ahead, lambda a: F.transform(v, lambda x, i: combine(F.get(a, of(i)), fold(F.slice(v, of(i) * block + 1, i % block)))))

    return bind(values, lambda v: F.when(F.size(v) > 0, by_blocks(v)).otherwise(F.array().cast("array<int>")))


def matches(text: Column, pattern: str) -> Column:
    """``start, end, value`` of each match, leftmost first.

    Matches and what lies between them alternate, so places are running sums of lengths.
    """

    def placed(found: Column) -> Column:
        between = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))

        def spans(gaps: Column) -> Column:
            steps = F.transform(found, lambda m, i: F.get(gaps, i) + F.length(m))
            start = lambda b, i: b + F.get(gaps, i)
            return F.transform(
                _before(steps, F.lit(0), lambda x, y: x + y),
                lambda b, i: F.struct(start(b, i).alias("start"), (start(b, i) + F.length(F.get(found, i))).alias("end"), F.get(found, i).alias("value")),
            )

        return F.when(F.size(found) > 0, bind(between, spans)).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))

    return bind(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


_SPANS = "array<struct<start:int,nr:int,end:int,kind:string,entity:string>>"


def base_spans(text: Column) -> Column:
    """Spans of the patterns by start, then kind: ``start, nr, end, kind, entity``."""

    def of_kind(t: Column, nr: int) -> Column:
        kind, sign, pattern, valid, name = KINDS[nr]
        found = F.filter(matches(t, pattern), lambda m: valid(m["value"]))
        entity = lambda m: F.concat(F.lit(kind + ":"), name(m["value"]))
        spans = F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(nr).alias("nr"), m["end"].alias("end"), F.lit(kind).alias("kind"), entity(m).alias("entity")))
        return F.when(F.contains(t, F.lit(sign)), spans).otherwise(F.array().cast(_SPANS))

    return bind(F.coalesce(text, F.lit("")), lambda t: F.array_sort(F.concat(*[of_kind(t, nr) for nr in range(len(KINDS))])))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _row_key(doc_id: str, text: str) -> tuple[Column, Column]:
    """Names a row by its id and text, whatever they are."""
    return F.xxhash64(doc_id, text), F.xxhash64(F.lit(1), text, doc_id)


def disclosing_terms(df: DataFrame, held: DataFrame, text: str = "text", min_contexts: int = MIN_CONTEXTS, threshold: float = GENERALISE) -> DataFrame:
    """``entity, term, disclosure`` of the pairs above the threshold.

    ``held`` has a row per document with entities: ``x, y`` (its key), ``content`` (a hash of
    its text, spaces and case aside), ``words`` (its terms, each once) and ``spans``.
    """
    n = F.lit(float(df.count()))
    entities = held.select("x", "y", F.explode(F.array_distinct(F.transform("spans", lambda s: s["entity"]))).alias("entity")).groupBy("x", "y", "entity").agg(F.count("*").alias("m"))
    with_entity = entities.groupBy("entity").agg(F.sum("m").alias("n_c")).where(F.col("n_c") < n)
    # n_ct is n_c at most, so a term of more documents than this cannot reach the threshold.
    most = F.col("n_c") * F.pow(n / F.col("n_c"), F.lit(1 - threshold)) * (1 + 1e-9)
    of_document = stage(entities.join(with_entity.withColumn("most", most), "entity"), "pii-entities")
    limits = of_document.groupBy("x", "y").agg(F.max("most").alias("limit"))
    highest = of_document.agg(F.max("most")).first()[0] or 0.0
    distinct = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(F.col(c)), F.lit(_TERM), F.lit(0)))
    with_term = df.select(F.explode(distinct(text)).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    words = held.select("x", "y", "content", F.explode("words").alias("term"))
    # As many documents as a pair needs, and no more than the commonest entity allows.
    rare = stage(with_term.where((F.col("n_t") >= min_contexts) & (F.col("n_t") <= highest)), "pii-rare")
    terms = words.join(rare, "term").join(limits, ["x", "y"]).where(F.col("n_t") <= F.col("limit"))
    pairs = terms.dropDuplicates(["x", "y", "term"]).drop("limit").join(of_document, ["x", "y"]).where(F.col("n_t") <= F.col("most"))
    by_content = pairs.groupBy("entity", "term", "content").agg(F.sum("m").alias("k"), F.first("n_c").alias("n_c"), F.first("n_t").alias("n_t"))
    together = by_content.groupBy("entity", "term").agg(F.count("*").alias("contents"), F.sum("k").alias("n_ct"), F.first("n_c").alias("n_c"), F.first("n_t").alias("n_t"))
    disclosure = F.log(n * F.col("n_ct") / (F.col("n_c") * F.col("n_t"))) / F.log(n / F.col("n_c"))
    return together.where(F.col("contents") >= min_contexts).select("entity", "term", disclosure.alias("disclosure")).where(F.col("disclosure") >= threshold)


def _terms(held: DataFrame) -> DataFrame:
    """``x, y, term, start, end`` of the words of documents with entities."""
    found = held.select("x", "y", F.explode(matches(F.col("text"), _TERM)).alias("m"))
    return found.select("x", "y", F.lower("m.value").alias("term"), F.col("m.start").alias("start"), F.col("m.end").alias("end"))


def find(df: DataFrame, text: str = "text", doc_id: str = "doc_id", **options: object) -> DataFrame:
    """``df`` with ``spans``: ``start, nr, end, kind, entity`` by start, then kind.

    Kind ``term`` marks a word of a document that discloses an entity of the same
    document; its ``entity`` field says ``generalise`` or ``remove``.
    """
    base = df.drop(*RESULTS)
    x, y, more = free_name(base, "_x", "_y", "_more")
    key = _row_key(doc_id, text)
    some = base.select(key[0].alias("x"), key[1].alias("y"), F.col(text).alias("text")).withColumn("spans", base_spans(F.col("text"))).where(F.size("spans") > 0)
    # Worked out here, once per text: next to an explode they would be worked out per term.
    content = F.xxhash64(F.lower(F.regexp_replace(F.trim("text"), r"\s+", " ")))
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col("text")), F.lit(_TERM), F.lit(0)))
    held = stage(some.withColumns({"content": content, "words": words}), "pii-held")
    told = stage(disclosing_terms(base, held, text, **options), "pii-terms")  # type: ignore[arg-type]
    holds = held.select("x", "y", F.explode(F.array_distinct(F.transform("spans", lambda s: s["entity"]))).alias("entity"))
    wanted = holds.join(told, "entity").groupBy("x", "y", "term").agg(F.max("disclosure").alias("disclosure"))
    action = F.when(F.col("disclosure") >= REMOVE, F.lit("remove")).otherwise(F.lit("generalise"))
    span = F.struct(F.col("start"), F.lit(len(KINDS)).alias("nr"), F.col("end"), F.lit(TERM).alias("kind"), action.alias("entity"))
    added = _terms(held).join(wanted, ["x", "y", "term"]).groupBy(F.col("x").alias(x), F.col("y").alias(y)).agg(F.collect_set(span).alias(more))
    all_spans = base.withColumns({x: key[0], y: key[1], "spans": base_spans(F.col(text))}).join(added, [x, y], "left")
    return all_spans.withColumn("spans", F.when(F.col(more).isNull(), F.col("spans")).otherwise(F.array_sort(F.concat("spans", F.col(more))))).select(*base.columns, "spans")


def sanitise(df: DataFrame, text: str = "text", doc_id: str = "doc_id", **options: object) -> DataFrame:
    """``df`` with entities and generalised terms replaced by their kind in brackets, others removed.

    A column named ``spans`` is left out.
    """
    spans, = free_name(df, "_spans")
    found = find(df, text, doc_id, **options).withColumnRenamed("spans", spans)
    ends = _before(F.transform(spans, lambda s: s["end"]), F.lit(0), lambda a, b: F.greatest(a, b))
    # What a span leaves: the text since the furthest end so far, and its mark if it starts there or later.
    mark = lambda s: F.when(s["entity"] == "remove", F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))

    def pieces(past: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            done = F.get(past, i)
            return F.when(s["start"] >= done, F.concat(F.substring(F.col(text), done + 1, s["start"] - done), mark(s))).otherwise(F.lit(""))

        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(F.transform(spans, piece), ""), F.substring(F.col(text), last + 1, F.length(text)))

    rewritten = F.when(F.size(spans) > 0, bind(ends, pieces)).otherwise(F.col(text))
    return found.withColumn(text, rewritten).select(*[c for c in df.columns if c in found.columns])
