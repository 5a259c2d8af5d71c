"""Quality rules as a short-circuit cascade.

A sample tells how often each rule rejects and how long it takes; the rules are then put
in order of rejection per cost and folded into one conditional expression, so that a text is
only measured until the first rule rejects it.  The order decides the work and which of
several rules that reject a text is named, never the verdict.  Rules are stated in figures of
the text; a caller who has figures as columns hands them in, and they are not worked out again.

Costs are times of the rules on the staged sample, less that of reading it.  They vary from run to
run, so ``rejected_by`` may; ``kept`` does not.

Everything is built-in column code.  Defined results: null and empty texts have no words
and fail the rule on length; texts of any length are measured whole; repeated rows get
the same verdict each; an empty table gives an empty table; other columns pass through, and
a column that has the name of a result is replaced by it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rungworks.llm.common import bind, without_space, words
from rungworks.session import stage, staging

#: Share of the rows that costs and rejection rates of rules are estimated on.
SAMPLE = 0.01


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(without_space(text)).cast("long")


def n_symbols(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long")


def n_lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.size(_lines(text)).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return bind(_lines(text), lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long")


def n_repeat_words(text: Column) -> Column:
    """Words that lie in a three-word window found at least twice, the first time included.

    Windows are compared by 64-bit hash.  Only a text in which two windows agree goes
    on to the sort that tells which.
    """
    return bind(_windows(text), lambda found: F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(_covered(found))).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: without_space(line) != "")


def _windows(text: Column) -> Column:
    def hashes(found: Column) -> Column:
        at = lambda i, k: F.get(found, i + k)
        some = F.transform(F.sequence(F.lit(0), F.size(found) - 3), lambda i: F.xxhash64(at(i, 0), at(i, 1), at(i, 2)))
        return F.when(F.size(found) >= 3, some).otherwise(F.array().cast("array<bigint>"))

    return bind(words(text), hashes)


def _covered(found: Column) -> Column:
    """Length of the union of [i, i + 3) over the windows i that have an equal."""
    in_order = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(row: Column) -> Column:
        same = lambda x, i, k: F.coalesce(F.get(row, i + k)["h"] == x["h"], F.lit(False))
        kept = F.filter(row, lambda x, i: same(x, i, -1) | same(x, i, 1))
        return F.array_sort(F.transform(kept, lambda x: x["i"]))

    def union(starts: Column) -> Column:
        steps = F.transform(starts, lambda s, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - s, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    return bind(bind(in_order, repeated), union)


def n_capitals(text: Column) -> Column:
    return _n_of(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def n_bangs(text: Column) -> Column:
    return _n_of(text, "!")


def _n_of(text: Column, characters: str) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


#: What rules may ask of a text.
FIGURES: dict[str, Callable[[Column], Column]] = {
    f.__name__: f for f in (n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_capitals, n_bangs)
}
#: The figures that :func:`metrics` adds.
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

Ask = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """``rejects`` says whether a text fails, given a way to ask for its figures."""

    name: str
    rejects: Callable[[Ask], Column]


def _asking(text: Column, known: Mapping[str, Column]) -> Ask:
    return lambda name: known[name] if name in known else FIGURES[name](text)


TOO_SHORT = Rule("too_short", lambda ask: ask("n_words") < 50)
REPETITIVE = Rule("repetitive", lambda ask: 100 * ask("n_repeat_words") > 50 * ask("n_words"))
BASE = (TOO_SHORT, REPETITIVE)

#: The production rules: the two of the base and four wide bounds that prose stays inside.  Shouting
#: is more than two capitals (A-Z) in five characters of words, and a bang in ten.
RULES = (
    *BASE,
    Rule("symbols", lambda ask: ask("n_symbols") > 0.10 * ask("word_chars")),
    Rule("long_words", lambda ask: ask("word_chars") > 20.0 * ask("n_words")),
    Rule("duplicate_lines", lambda ask: (ask("n_dup_lines") > 0) & bind(ask("n_lines"), lambda n: (n >= 4) & (ask("n_dup_lines") > 0.70 * n))),
    Rule("shouting", lambda ask: (ask("n_bangs") > 0.1 * ask("word_chars")) & (ask("n_capitals") > 0.4 * ask("word_chars"))),
)


@dataclass(frozen=True)
class Measured:
    rule: Rule
    rejection: float
    cost: float

    @property
    def worth(self) -> float:
        return self.rejection / max(self.cost, 1e-9)


def measure(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample: float = SAMPLE, seed: int = 7, clock: Callable[[], float] = time.perf_counter) -> list[Measured]:
    """Rejection rate and seconds of each rule on a sample; one row a rule reaches the driver.

    Each rule runs twice over the staged sample.  The first run compiles it; the second is timed.
    """
    with staging(df.sparkSession):
        part = stage(df.select(F.col(text).alias("t")).sample(sample, seed=seed), "quality-sample")

        def timed(value: Column) -> tuple[float, float]:
            asked = part.agg(F.avg(value.cast("double")).alias("rate"))
            asked.first()
            start = clock()
            rate = asked.first()["rate"]
            return rate or 0.0, clock() - start

        _, reading = timed(F.length("t"))
        found = [(rule, *timed(rule.rejects(_asking(F.col("t"), {})))) for rule in rules]
    return [Measured(rule, rate, max(seconds - reading, 0.0)) for rule, rate, seconds in found]


def cascade_order(measured: Sequence[Measured]) -> list[Rule]:
    """The best rejection per cost first; cheap ones first among equals."""
    return [m.rule for m in sorted(measured, key=lambda m: (-m.worth, m.cost, m.rule.name))]


def first_rejection(text: Column, rules: Sequence[Rule], known: Mapping[str, Column] | None = None) -> Column:
    """Name of the first rule that rejects, null if none does; later rules are not looked at."""
    ask = _asking(text, known or {})
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects(ask), F.lit(rule.name)).otherwise(verdict)
    return verdict


def judge(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample: float = SAMPLE, known: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``rejected_by`` (a rule's name or null) and ``kept``.

    ``known`` names columns of ``df`` that hold the figure of their name.
    """
    order = cascade_order(measure(df, rules, text, sample))
    verdict = first_rejection(F.col(text), order, {name: F.col(name) for name in known})
    return df.withColumn("rejected_by", verdict).withColumn("kept", F.col("rejected_by").isNull())


def keep_good(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample: float = SAMPLE) -> DataFrame:
    """Rows that no rule rejects, with the columns they came with."""
    order = cascade_order(measure(df, rules, text, sample))
    return df.where(first_rejection(F.col(text), order).isNull())


def metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the figures that the base rules are stated in."""
    return df.withColumns({name: FIGURES[name](F.col(text)) for name in METRICS})
