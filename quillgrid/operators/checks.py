"""Data checks: many conditions in one pass over the table, one verdict row per condition."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = {
    "null_check": lambda c: F.sum(F.col(c).isNull().cast("bigint")),
    "distinct_check": lambda c: F.count_distinct(F.col(c)),
    "unique_check": lambda c: F.count(F.col(c)) - F.count_distinct(F.col(c)),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
}


def verdict(value: Column, rule: Mapping[str, float], accept_none: bool = False) -> Column:
    """equal_to, greater_than, less_than, geq_to, leq_to; `tolerance` widens each by that share."""
    t = rule.get("tolerance", 0.0)
    tests = {
        "equal_to": lambda x: value.between(x * (1 - t), x * (1 + t)) if x >= 0 else value.between(x * (1 + t), x * (1 - t)),
        "greater_than": lambda x: value > x * (1 - t),
        "less_than": lambda x: value < x * (1 + t),
        "geq_to": lambda x: value >= x * (1 - t),
        "leq_to": lambda x: value <= x * (1 + t),
    }
    return F.coalesce(reduce(Column.__and__, [tests[k](float(x)) for k, x in rule.items() if k in tests]), F.lit(accept_none))


def column_checks(df: DataFrame, checks: Mapping[str, Mapping[str, Mapping[str, float]]], accept_none: bool = False, where: str | None = None) -> DataFrame:
    """column_name, check_name, value, passed for {column: {check: rule}}, from one aggregation."""
    df = df.where(where) if where else df
    named = [(c, k, rule) for c, by in checks.items() for k, rule in by.items()]
    row = df.agg(*(MEASURES[k](c).cast("double").alias(f"v{i}") for i, (c, k, _) in enumerate(named)))
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("check_name"), F.col(f"v{i}").alias("value"), verdict(F.col(f"v{i}"), rule, accept_none).alias("passed")) for i, (c, k, rule) in enumerate(named)]
    return row.select(F.inline(F.array(*rows)))


def table_checks(df: DataFrame, checks: Mapping[str, str]) -> DataFrame:
    """check_name, passed: an aggregate condition, or a row condition that every row must meet."""
    aggregate = lambda sql: re.search(r"\b(count|sum|min|max|avg)\s*\(", sql.lower()) is not None
    named = list(checks.items())
    row = df.agg(*((F.expr(q) if aggregate(q) else F.min(F.when(F.expr(q), 1).otherwise(0)) == 1).alias(f"v{i}") for i, (_, q) in enumerate(named)))
    return row.select(F.inline(F.array(*(F.struct(F.lit(n).alias("check_name"), F.coalesce(F.col(f"v{i}"), F.lit(False)).alias("passed")) for i, (n, _) in enumerate(named)))))


def value_check(df: DataFrame, passes: float | str, tolerance: float | None = None) -> DataFrame:
    """Every cell of the first row against a value: numbers exactly or within a share of it, a text by the cells' texts."""
    if isinstance(passes, str):
        ok = reduce(Column.__and__, [F.col(c).cast("string") == passes for c in df.columns])
        return df.limit(1).select(*df.columns, F.coalesce(ok, F.lit(False)).alias("passed"))
    low, high = (passes * (1 - tolerance), passes * (1 + tolerance)) if tolerance is not None else (passes, passes)
    ok = reduce(Column.__and__, [F.col(c).cast("double").between(low, high) for c in df.columns])
    return df.limit(1).select(*df.columns, F.coalesce(ok, F.lit(False)).alias("passed"))


def interval_check(df: DataFrame, date: str, metrics: Mapping[str, str], day: str, back: int, thresholds: Mapping[str, float], formula: str = "max_over_min", ignore_zero: bool = True) -> DataFrame:
    """metric, current, reference, ratio, passed: each metric at `day` against `back` days before; ratio must stay below its threshold."""
    today, before = F.to_date(F.lit(day)), F.date_sub(F.to_date(F.lit(day)), back)
    d = F.to_date(date)
    when = lambda q, on: F.expr(q.replace("(", "(CASE WHEN _on = '" + on + "' THEN ", 1)[:-1] + " END)")
    marked = df.where((d == today) | (d == before)).withColumn("_on", F.when(d == today, "a").otherwise("b"))
    row = marked.agg(*(when(q, on).cast("double").alias(f"{on}{i}") for i, q in enumerate(metrics.values()) for on in "ab"))
    out = []
    for i, name in enumerate(metrics):
        a, b = F.col(f"a{i}"), F.col(f"b{i}")
        ratio = F.greatest(a, b) / F.nullif(F.least(a, b), F.lit(0.0)) if formula == "max_over_min" else F.abs(a - b) / F.nullif(b, F.lit(0.0))
        out.append(F.struct(F.lit(name).alias("metric"), a.alias("current"), b.alias("reference"), ratio.alias("ratio"), F.coalesce(ratio < thresholds[name], F.lit(ignore_zero)).alias("passed")))
    return row.select(F.inline(F.array(*out)))


def threshold_check(df: DataFrame, value: str, low: Column | float, high: Column | float) -> DataFrame:
    """value, low, high, passed; limits may be aggregates of the same table."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    row = df.agg(F.expr(value).cast("double").alias("value"), as_col(low).cast("double").alias("low"), as_col(high).cast("double").alias("high"))
    return row.withColumn("passed", F.coalesce(F.col("value").between(F.col("low"), F.col("high")), F.lit(False)))


def rule_violations(df: DataFrame, key: str, rules: Mapping[str, str]) -> DataFrame:
    """key, rule for every row and rule that it breaks (null counts as broken)."""
    broken = F.array(*(F.when(~F.coalesce(F.expr(q), F.lit(False)), n) for n, q in rules.items()))
    return df.select(key, F.explode(F.filter(broken, lambda x: x.isNotNull())).alias("rule"))


def truthy(df: DataFrame, column: str) -> Column:
    """Whether a cell counts as true: no null, no zero of any number type, no empty text, array or map, not false. The text "0" is true."""
    kind, c = dict(df.dtypes)[column].split("<")[0].split("(")[0], F.col(f"`{column}`")
    if kind == "boolean":
        ok = c
    elif kind in ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal"):
        ok = c != 0
    elif kind in ("string", "char", "varchar", "binary"):
        ok = F.length(c) > 0
    elif kind in ("array", "map"):
        ok = F.size(c) > 0
    else:
        ok = c.isNotNull()
    return F.coalesce(ok, F.lit(False))


def all_truthy(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """passed: whether the first row exists and all its cells are truthy."""
    ok = reduce(Column.__and__, [truthy(df, c) for c in columns or df.columns])
    return df.limit(1).agg(F.coalesce(F.bool_and(ok), F.lit(False)).alias("passed"))
