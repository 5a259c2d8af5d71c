"""The cascade: costs measured on a sample, figures worked out once, work cut short."""

import itertools

from pyspark.sql import functions as F

from rungworks.llm import quality

TEXTS = [
    None,
    "",
    "few words",
    " ".join(f"w{i}" for i in range(60)),
    "the same three " * 40,
    " ".join(f"w{i}$$" for i in range(60)),
    " ".join(f"{'x' * 30}{i}" for i in range(60)),
    "\n".join(["this line comes again"] * 30 + [f"v{i} u{i}" for i in range(10)]),
    " ".join(f"WORD{i}!!" for i in range(60)),
]
WANT = [{"too_short"}] * 3 + [set(), {"repetitive"}, {"symbols"}, {"long_words"}, {"repetitive", "duplicate_lines"}, {"shouting"}]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_each_rule_rejects_what_it_is_for(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string")
    named = {rule.name: quality.first_rejection(F.col("text"), [rule]).alias(rule.name) for rule in quality.RULES}
    got = df.select("i", *named.values()).orderBy("i").collect()
    short = [{n for n in named if r[n]} for r in got]
    assert [s & w if "too_short" in w else s for s, w in zip(short, WANT, strict=True)] == WANT


def test_known_figures_give_the_same_verdicts_and_are_not_worked_out_again(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string")
    plain = quality.judge(df, sample=1.0)
    given = quality.judge(quality.metrics(df), sample=1.0, known=quality.METRICS)
    assert sorted((r.i, r.kept) for r in plain.collect()) == sorted((r.i, r.kept) for r in given.collect())
    hashed = _plan(quality.metrics(df)).count("xxhash64")
    assert hashed and _plan(given).count("xxhash64") == hashed


def test_costs_are_times_less_that_of_reading(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    # Each timed run looks at the clock twice: reading takes 1, the rules 3, 1, 6, ...
    marks = itertools.chain.from_iterable((10.0 * k, 10.0 * k + took) for k, took in enumerate((1.0, 3.0, 1.0, 6.0, 0.5, 2.0, 2.0)))
    found = quality.measure(df, sample=1.0, clock=lambda: next(marks))
    assert [round(m.cost, 6) for m in found] == [2.0, 0.0, 5.0, 0.0, 1.0, 1.0]
    assert [round(m.rejection * len(TEXTS), 6) for m in found][0] == 3
    assert all(0 <= m.rejection <= 1 for m in found)


def test_an_empty_sample_rejects_nothing_and_orders_by_cost(spark):
    df = spark.createDataFrame([], "text string")
    found = quality.measure(df, sample=1.0)
    assert all(m.rejection == 0 for m in found) and len(quality.cascade_order(found)) == len(quality.RULES)


def test_a_text_is_not_measured_after_its_first_rejection(spark):
    fails = lambda ask: F.raise_error(F.lit("measured in vain")).cast("boolean")
    df = spark.createDataFrame([("few words",)], "text string")
    rules = [quality.TOO_SHORT, quality.Rule("never", fails)]
    assert df.select(quality.first_rejection(F.col("text"), rules).alias("by")).first().by == "too_short"
