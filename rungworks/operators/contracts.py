"""Payload contracts and table constraints.

A payload arrives as JSON text.  It is parsed to a variant, which - unlike a typed
read - tells a missing field from one that is present but null.  Each contract is
an expression giving null for a sound payload and otherwise the first violation
with its place, so one pass over the data yields both the sound rows and the rest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rungworks.schemas import Table

LEAGUE_KEY_FIELDS = ("season_id", "queue_id", "league_id", "team_type")


def _object(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, "map<string,variant>")


def _list(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "array<variant>")


def _has(obj: Column, name: str) -> Column:
    return F.coalesce(F.map_contains_key(obj, name), F.lit(False))


def _first(problems: Column) -> Column:
    return F.get(F.filter(problems, lambda p: p.isNotNull()), F.lit(0))


def _list_contract(payload: Column, name: str) -> Column:
    value = F.try_parse_json(payload)
    return (
        F.when(_object(value).isNull(), F.lit("payload is not an object"))
        .when(_list(value, f"$.{name}").isNull(), F.lit(f"{name}: list missing"))
    )


def league_violation(payload: Column) -> Column:
    value = F.try_parse_json(payload)

    def division_problem(where: Column) -> Callable[[Column, Column], Column]:
        def check(division: Column, j: Column) -> Column:
            place = F.concat(where, F.lit(".division["), j.cast("string"), F.lit("]"))
            return F.when(
                ~_has(_object(division), "ladder_id"), F.concat(place, F.lit(".ladder_id: missing"))
            )

        return check

    def tier_problem(tier: Column, i: Column) -> Column:
        where = F.concat(F.lit("tier["), i.cast("string"), F.lit("]"))
        divisions = _list(tier, "$.division")
        return F.when(divisions.isNull(), F.concat(where, F.lit(".division: list missing"))).otherwise(
            _first(F.transform(divisions, division_problem(where)))
        )

    key = _object(value, "$.key")
    tiers = _list(value, "$.tier")
    problem = F.when(_object(value).isNull(), F.lit("payload is not an object")).when(
        key.isNull(), F.lit("key: object missing")
    )
    for name in LEAGUE_KEY_FIELDS:
        problem = problem.when(~_has(key, name), F.lit(f"key.{name}: missing"))
    return problem.when(tiers.isNull(), F.lit("tier: list missing")).otherwise(
        _first(F.transform(tiers, tier_problem))
    )


def modern_ladder_violation(payload: Column) -> Column:
    return _list_contract(payload, "team")


def legacy_ladder_violation(payload: Column) -> Column:
    return _list_contract(payload, "ladderMembers")


def match_history_violation(payload: Column) -> Column:
    return _list_contract(payload, "matches")


CONTRACTS: dict[str, Callable[[Column], Column]] = {
    "league": league_violation,
    "modern_ladder": modern_ladder_violation,
    "legacy_ladder": legacy_ladder_violation,
    "match_history": match_history_violation,
}


def without_empty_results(df: DataFrame, payload: str, list_name: str) -> DataFrame:
    """Leave out objects whose list is missing, null or empty: answers that hold nothing.

    This runs before the contract, which would call a missing list a violation.  What
    is no object, or holds something else in place of the list, stays to be reported.
    """
    value = F.try_parse_json(payload)
    held = F.try_variant_get(value, f"$.{list_name}", "variant")
    nothing = F.coalesce(F.to_json(held), F.lit("null")).isin("null", "[]", "{}", '""', "0", "false")
    return df.where(_object(value).isNull() | ~nothing)


def check_payloads(df: DataFrame, payload: str, contract: str) -> DataFrame:
    """Add ``violation``: null, or what is wrong first and where."""
    return df.withColumn("violation", CONTRACTS[contract](F.col(payload)))


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound rows without the ``violation`` column, quarantined rows with it)."""
    sound = checked.where(F.col("violation").isNull()).drop("violation")
    return sound, checked.where(F.col("violation").isNotNull())


def require_any(df: DataFrame, what: str) -> DataFrame:
    """Raise if ``df`` is empty: a run in which no partition passed must not go on."""
    if df.isEmpty():
        raise ValueError(f"no {what} to process")
    return df


# ---------------------------------------------------------- table constraints

_RANGES = {T.ShortType: (-(2**15), 2**15 - 1), T.IntegerType: (-(2**31), 2**31 - 1)}


def row_violation(df: DataFrame, table: Table) -> DataFrame:
    """Add ``violation`` for null in a required column or a number out of its column's range."""
    problem = F.lit(None).cast("string")
    types = {f.name: f.dataType for f in table.schema.fields}
    for name in reversed(table.payload):
        value = F.col(name)
        bounds = _RANGES.get(type(types[name]))
        numeric = isinstance(df.schema[name].dataType, (T.IntegralType, T.DecimalType))
        if bounds and numeric:
            problem = F.when(
                ~value.between(*bounds), F.lit(f"{name}: out of range")
            ).otherwise(problem)
        if name in table.required and name != table.audit:
            problem = F.when(value.isNull(), F.lit(f"{name}: null")).otherwise(problem)
    return df.withColumn("violation", problem)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def constraint_report(df: DataFrame, table: Table) -> DataFrame:
    """Rows that break each constraint of the table; constraints nobody breaks are absent."""
    rows = (
        row_violation(df, table)
        .where(F.col("violation").isNotNull())
        .groupBy(F.col("violation").alias("constraint"))
        .agg(F.count("*").alias("rows"))
    )
    spare = (
        duplicate_keys(df, list(table.key))
        .agg(F.sum(F.col("rows") - 1).alias("rows"))
        .where(F.col("rows") > 0)
        .select(F.lit("key: duplicate").alias("constraint"), "rows")
    )
    return rows.unionByName(spare)
