"""List views: filters by suffix, sorting, paging, and chart groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.operators.load import assign_keys


def like(column: str, text: str | None) -> Column:
    """Contains, and nothing asked where text is None."""
    return F.lit(True) if text is None else F.col(column).contains(text)


SUFFIXES = {
    "_like": lambda c, v: c.contains(v),
    "_equals": lambda c, v: c == v,
    "_gt": lambda c, v: c > v,
    "_lt": lambda c, v: c < v,
    "_in": lambda c, v: c.isin(*v),
}


def search(df: DataFrame, arguments: Mapping[str, object], allowed: Sequence[str]) -> DataFrame:
    """Filters named column + suffix; columns that aren't allowed and unknown suffixes are ignored, None asks nothing."""
    for name, value in arguments.items():
        for suffix, test in SUFFIXES.items():
            column = name.removesuffix(suffix)
            if name.endswith(suffix) and column in allowed and value is not None:
                df = df.where(test(F.col(column), value))
                break
    return df


ILIKE = {"starts": "{}%", "ends": "%{}", "contains": "%{}%"}


def ilike(column: Column, how: str, text: str, negate: bool = False) -> Column:
    pattern = ILIKE[how].format(text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_"))
    return ~column.ilike(pattern) if negate else column.ilike(pattern)


def typed(df: DataFrame, column: str, op: str, text: str) -> DataFrame:
    """eq, neq, gt, lt with the text taken as the column's type; a text that isn't of that type asks nothing."""
    value = F.lit(text).try_cast(df.schema[column].dataType)
    test = {"eq": lambda c: c == value, "neq": lambda c: c != value, "gt": lambda c: c > value, "lt": lambda c: c < value}[op]
    return df.where(value.isNull() | test(F.col(column)))


def all_tokens(column: Column, text: str) -> Column:
    """Every token of text occurs, in any case."""
    return reduce(Column.__and__, [F.lower(column).contains(t) for t in text.lower().split()], F.lit(True))


def order_by(df: DataFrame, spec: Sequence[str], allowed: Sequence[str], nulls: str = "last") -> DataFrame:
    """`-name` sorts downwards; names that aren't allowed are refused."""
    keys = []
    for s in spec:
        name = s.lstrip("-")
        if name not in allowed:
            raise ValueError(f"can't sort by {name}")
        keys.append(getattr(F.col(name), f"{'desc' if s[0] == '-' else 'asc'}_nulls_{nulls}")())
    return df.orderBy(*keys)


def nulls_last_places(df: DataFrame, name: str, order: Sequence[str], rows_per_range: int = 1_000_000) -> DataFrame:
    """Every row with its place from 1 in ascending order; rows whose first key is null come last, among themselves by the other keys."""
    key = df[order[0]]
    known = df.where(key.isNotNull())
    first = assign_keys(known, name, order, rows_per_range=rows_per_range)
    last = assign_keys(df.where(key.isNull()), name, list(order[1:]) or list(order), known.count(), rows_per_range=rows_per_range)
    return first.unionByName(last).withColumn(name, F.col(name).cast("bigint"))


def page(df: DataFrame, number: int, size: int, most: int = 1000) -> DataFrame:
    size = min(size, most)
    return df.offset(number * size).limit(size)


def in_given_order(df: DataFrame, key: str, values: Sequence) -> DataFrame:
    """Rows whose key is in the list, with their place in it."""
    places = df.sparkSession.createDataFrame(list(enumerate(values)), f"place int, {key} {df.schema[key].dataType.simpleString()}")
    return df.join(F.broadcast(places), key)


def by_month(df: DataFrame, date: str, aggregates: Sequence[Column]) -> DataFrame:
    """Groups of (year, month) with a label; null dates are left out."""
    d = F.col(date)
    return df.where(d.isNotNull()).groupBy(F.year(d).alias("year"), F.month(d).alias("month"), F.date_format(d, "MMMM yyyy").alias("label")).agg(*aggregates)


def slot_stats(instances: DataFrame, pools: DataFrame, states: Sequence[str] = ("running", "queued", "deferred", "scheduled")) -> DataFrame:
    """pool, total, one column per state and open slots; total -1 has no limit (open null)."""
    used = instances.groupBy("pool").pivot("state", list(states)).agg(F.sum("slots"))
    df = pools.join(used, "pool", "left").na.fill(0, list(states))
    return df.withColumn("open", F.when(F.col("total") >= 0, F.col("total") - F.col("running") - F.col("queued")))


def related(df: DataFrame, other: DataFrame, key: str, other_key: str, negate: bool = False) -> DataFrame:
    """Rows with (or without) a related row."""
    keys = other.select(F.col(other_key).alias(key)).distinct()
    return df.join(keys, key, "left_anti" if negate else "left_semi")


def excluding(df: DataFrame, pairs: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose tuple of keys isn't listed; null-safe."""
    renamed = pairs.select(*(F.col(c).alias(f"_x_{c}") for c in on)).distinct()
    return df.join(renamed, reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_x_{c}")) for c in on]), "left_anti")


#: Tests of a store's filters on (cell, asked text); numbers where both are.
STORE_FILTERS = {
    "contains": all_tokens,
    "not_contains": lambda c, v: ~all_tokens(c, v),
    "starts_with": lambda c, v: F.lower(c).startswith(v.lower()),
    "not_starts_with": lambda c, v: ~F.lower(c).startswith(v.lower()),
    "equal": lambda c, v: c == v,
    "not_equal": lambda c, v: c != v,
    "greater": lambda c, v: F.coalesce(c.try_cast("double") > F.lit(v).try_cast("double"), F.lit(False)),
    "smaller": lambda c, v: F.coalesce(c.try_cast("double") < F.lit(v).try_cast("double"), F.lit(False)),
}


def store_filter(column: Column, op: str, text: str) -> Column:
    """A store's filter on a cell; a null cell never matches."""
    cell = column.cast("string")
    return cell.isNotNull() & F.coalesce(STORE_FILTERS[op](cell, text), F.lit(False))


def apply_all(df: DataFrame, filters: Sequence[tuple[str, str, str | Sequence[str]]], allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """store_filter()s (column, op, text) one after the other; a list of texts asks for all of them. A column or op that isn't allowed is an error."""
    for column, op, texts in filters:
        if op not in allowed.get(column, ()):
            raise ValueError(f"filter {op} isn't allowed on {column}")
        for text in [texts] if isinstance(texts, str) else texts:
            df = df.where(store_filter(F.col(column), op, text))
    return df


def page_then_join(df: DataFrame, order: Sequence[Column], size: int, page: int, others: DataFrame, on: Column, how: str = "left") -> DataFrame:
    """A page of rows (the feature: `size` of them) and then their related rows, so that relations don't count as rows of the page."""
    return df.orderBy(*order).offset(size * page).limit(size).join(others, on, how)
