"""Toxicity: a logistic classifier that is kept indifferent to who is spoken of.

Features are the words of a text and their first letters (which also meet unseen forms of a
stem), each present or not, so that length alone says nothing.  Those that tell the
classes apart best, by the likelihood ratio, are kept.  For every labelled text that names
a group of people a counterfactual is made in which the group's name is swapped for
another of its kind; the fit pays for each change of score that the swap causes.  So a
group that toxic texts happen to mention often does not become a sign of toxicity.

Learning uses a sample of labelled texts of ``MAX_LABELLED`` rows at most (in expectation; the rows
are chosen by a hash of their id), in tasks but for the last step, which fits at most
``MAX_FEATURES`` weights on the driver.  Scoring is one pass over whole texts.

Defined results: null and empty texts have no features and get the score of the bias; a null
label is no label; an id labelled several times is toxic if any label says so; without labels of both
classes every score is the smoothed rate; repeated rows get the same score;
a null id counts as held out; empty tables give empty tables; other columns pass through,
and a column that has the name of a result is replaced by it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rungworks.llm.common import ship
from rungworks.session import stage

#: Bounds of what is learned from and of what is learned.
MAX_LABELLED = 20_000
MAX_FEATURES = 2_048
#: Least likelihood ratio and least number of texts of a feature.
MIN_RATIO = 25.0
MIN_TEXTS = 4
#: Prices of weights and of score changes under a swap.
RIDGE = 1e-4
INDIFFERENCE = 5.0
STEPS = 400

#: Names of groups by kind; a name is swapped for the next of its kind.
IDENTITIES: tuple[tuple[str, ...], ...] = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual"), ("black", "white", "asian", "latino"), ("immigrants", "locals", "refugees"),
    ("africans", "americans", "europeans", "asians"), ("germans", "french", "spaniards", "turks", "poles"), ("old", "young"), ("disabled", "deaf", "blind"),
    ("frauen", "männer"), ("frau", "mann"), ("muslime", "christen", "juden"), ("ausländer", "einheimische"),
    ("femmes", "hommes"), ("femme", "homme"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("musulmanes", "cristianos", "judíos"),
)

_WORD = re.compile(r"[^\W\d_]{2,}")
_PREFIXES = (4, 5, 6)


def swaps(identities: Sequence[Sequence[str]] = IDENTITIES) -> dict[str, str]:
    return {name: kind[(i + 1) % len(kind)] for kind in identities for i, name in enumerate(kind)}


def vocabulary(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features(words: set[str]) -> set[str]:
    """The words, and as ``abcd*`` their first letters."""
    found = set(words)
    for n in _PREFIXES:
        found.update([w[:n] + "*" for w in words if len(w) > n])
    return found


def swapped(words: set[str], swap: dict[str, str]) -> set[str] | None:
    """The words of the counterfactual, or None if no group is named."""
    named = words & swap.keys()
    return (words - named) | {swap[w] for w in named} if named else None


@dataclass
class Model:
    bias: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self._whole = frozenset(f for f in self.weights if not f.endswith("*"))
        self._parts = [(n, frozenset(f[:-1] for f in self.weights if f.endswith("*") and len(f) == n + 1)) for n in _PREFIXES]

    def present(self, words: set[str]) -> list[str]:
        found = list(words & self._whole)
        for n, parts in self._parts:
            found += [p + "*" for p in {w[:n] for w in words if len(w) > n} & parts]
        return found

    def score(self, text: str | None) -> float:
        z = self.bias + math.fsum(self.weights[f] for f in self.present(vocabulary(text)))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", most: int = MAX_LABELLED) -> DataFrame:
    """``id, toxic, text`` of labelled rows that are not held out, some ``most`` at most."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).alias("toxic")).where(~held_out(F.col("id")) & F.col("toxic").isNotNull() & F.col("id").isNotNull())
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    share = min(1.0, most / max(n, 1))
    chosen = known.where(F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # The chosen labels are bounded by ``most``: some hundreds of kilobytes.
    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")


def _counts(sample: DataFrame) -> DataFrame:
    """``feature, n, k``: texts with the feature, and toxic ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: dict[str, int] = {}
            k: dict[str, int] = {}
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
                for f in features(vocabulary(text)):
                    n[f] = n.get(f, 0) + 1
                    if toxic:
                        k[f] = k.get(f, 0) + 1
            names = list(n)
            for i in range(0, len(names), 50_000):
                part = names[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([n[f] for f in part], pa.int64()), pa.array([k.get(f, 0) for f in part], pa.int64())], names=["feature", "n", "k"])

    ship(sample.sparkSession)
    return sample.select("text", "toxic").mapInArrow(run, "feature string, n bigint, k bigint").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))


def _ratio(n: Column, k: Column, total: int, toxic: int) -> Column:
    """Likelihood ratio of the feature's table against independence."""

    def term(seen: Column, rows: Column, columns: float) -> Column:
        return F.when(seen > 0, seen * F.log(seen * total / (rows * columns))).otherwise(0.0)

    without = F.lit(total) - n
    return 2 * (term(k, n, toxic) + term(n - k, n, total - toxic) + term(toxic - k, without, toxic) + term(without - (toxic - k), without, total - toxic))


def choose_features(sample: DataFrame, total: int, toxic: int, most: int = MAX_FEATURES) -> list[str]:
    counted = _counts(sample).where(F.col("n") >= MIN_TEXTS).withColumn("ratio", _ratio(F.col("n"), F.col("k"), total, toxic)).where(F.col("ratio") >= MIN_RATIO)
    return [r["feature"] for r in counted.orderBy(F.desc("ratio"), "feature").limit(most).collect()]


def _examples(sample: DataFrame, chosen: list[str], swap: dict[str, str]) -> list[tuple[int, list[int], list[int] | None]]:
    """Label, features present, and those of the counterfactual, by number."""
    number = {f: i for i, f in enumerate(chosen)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blank = Model(0.0, dict.fromkeys(number, 0.0))
        for batch in batches:
            own, other = [], []
            for text in batch["text"].to_pylist():
                words = vocabulary(text)
                own.append(sorted(number[f] for f in blank.present(words)))
                changed = swapped(words, swap)
                other.append(None if changed is None else sorted(number[f] for f in blank.present(changed)))
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch["id"], batch["toxic"].cast(pa.int32()), pa.array(own, kind), pa.array(other, kind)], names=["id", "toxic", "own", "other"])

    schema = T.StructType([sample.schema["id"], T.StructField("toxic", T.IntegerType()), T.StructField("own", T.ArrayType(T.IntegerType())), T.StructField("other", T.ArrayType(T.IntegerType()))])
    rows = sample.select("id", "text", "toxic").mapInArrow(run, schema).collect()
    return [(int(r.toxic > 0), r.own, r.other) for r in sorted(rows, key=lambda r: (r.id, r.toxic, r.own))]


def fit_weights(examples: Sequence[tuple[int, Sequence[int], Sequence[int] | None]], n_features: int, indifference: float = INDIFFERENCE, ridge: float = RIDGE, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """Bias and weights of least loss: logistic, plus prices of weights and of swaps."""
    y = np.array([e[0] for e in examples], dtype=float)
    row = np.repeat(np.arange(len(examples)), [len(e[1]) for e in examples])
    col = np.array([i for e in examples for i in e[1]], dtype=np.int64)
    changed = [(set(e[1]), set(e[2])) for e in examples if e[2] is not None and set(e[1]) != set(e[2])]
    swap_row = np.array([j for j, (a, b) in enumerate(changed) for _ in a ^ b], dtype=np.int64)
    swap_col = np.array([i for a, b in changed for i in sorted(a ^ b)], dtype=np.int64)
    sign = np.array([1.0 if i in a else -1.0 for a, b in changed for i in sorted(a ^ b)])
    # The rarer class weighs more, by the root of how much rarer it is.
    positive = max(y.sum(), 1.0)
    per_row = np.where(y > 0, math.sqrt(max(len(y) - positive, 1.0) / positive), 1.0)
    per_row /= per_row.sum()
    rate = float((per_row * y).sum())
    bias, w = math.log(max(rate, 1e-6) / max(1 - rate, 1e-6)), np.zeros(n_features)
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for t in range(1, steps + 1):
        z = bias + np.bincount(row, weights=w[col], minlength=len(y))
        error = per_row * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        g = np.bincount(col, weights=error[row], minlength=n_features) + ridge * w
        if len(changed):
            change = np.bincount(swap_row, weights=sign * w[swap_col], minlength=len(changed))
            g += indifference / len(changed) * np.bincount(swap_col, weights=sign * change[swap_row], minlength=n_features)
        g = np.append(g, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return float(bias), w


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", identities: Sequence[Sequence[str]] = IDENTITIES, indifference: float = INDIFFERENCE) -> Model:
    """Learn from the labelled rows that are not held out."""
    sample = stage(labelled_sample(docs, labels, text, doc_id, label), "toxicity-sample")
    got = sample.agg(F.count("*").alias("n"), F.sum((F.col("toxic") > 0).cast("int")).alias("k")).first()
    total, toxic = got["n"], got["k"] or 0
    if toxic in (0, total):
        return Model(math.log((toxic + 0.5) / (total - toxic + 0.5)))
    chosen = choose_features(sample, total, toxic)
    bias, w = fit_weights(_examples(sample, chosen, swaps(identities)), len(chosen), indifference)
    return Model(bias, {f: float(x) for f, x in zip(chosen, w, strict=True)})


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    base = df.drop("score", "predicted")
    names, place = [*base.columns, "score"], base.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256)
                scores = [model.score(t) for t in rows.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(scores, pa.float64())], names=names)

    ship(df.sparkSession)
    scored = base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType())]))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
