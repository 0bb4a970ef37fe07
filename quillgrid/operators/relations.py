"""Lists over tables that refer to each other: columns are named by a path of relations, and the joins that the paths need are made once each.

    r = Relations(tables).add("orders", "o_custkey", "customer", "c_custkey").add("customer", "c_nationkey", "nation", "n_nationkey")
    r.of("orders").where("customer.nation.n_name", "eq", "FRANCE").sort("-customer.c_acctbal").select("o_orderkey", "nation.n_name")
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Relation:
    """A row of `table` belongs to at most one row of `target` (many=False), or has any number of them."""

    name: str
    table: str
    columns: tuple[str, ...]
    target: str
    target_columns: tuple[str, ...]
    many: bool = False


#: Conditions by name; a null value satisfies none but `null`, and `neq`, as unequal to anything.
CONDITIONS: dict[str, Callable[[Column, object], Column]] = {
    "eq": lambda c, v: c == F.lit(v), "neq": lambda c, v: ~c.eqNullSafe(F.lit(v)), "gt": lambda c, v: c > F.lit(v), "lt": lambda c, v: c < F.lit(v), "in": lambda c, v: c.isin(list(v)),
    "contains": lambda c, v: F.lower(c).contains(str(v).lower()), "starts": lambda c, v: F.lower(c).startswith(str(v).lower()), "null": lambda c, v: c.isNull() if v else c.isNotNull(),
}


class Relations:
    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables = dict(tables)
        self.edges: dict[str, list[Relation]] = {t: [] for t in tables}

    def add(self, table: str, columns: str | tuple[str, ...], target: str, target_columns: str | tuple[str, ...], name: str | None = None, back: str | None = None) -> Relations:
        """A foreign key. name: the relation's name in paths (the target's by default); back: the name of the way back, to many rows (the table's by default)."""
        one = lambda c: (c,) if isinstance(c, str) else tuple(c)
        for r in (Relation(name or target, table, one(columns), target, one(target_columns)), Relation(back or table, target, one(target_columns), table, one(columns), True)):
            if any(e.name == r.name for e in self.edges[r.table]):
                raise ValueError(f"{r.table} has two relations named {r.name}")
            self.edges[r.table].append(r)
        return self

    def steps(self, table: str, name: str) -> list[Relation]:
        """The relations from a table to what `name` names: one of its own, or the shortest way over relations to one row each. Two ways of one length are an error."""
        for e in self.edges[table]:
            if e.name == name:
                return [e]
        found: list[list[Relation]] = []
        todo, seen = deque([(table, [])]), {table}
        while todo:
            at, way = todo.popleft()
            if found and len(way) >= len(found[0]):
                break
            for e in self.edges[at]:
                if e.many:
                    continue
                if e.name == name:
                    found.append([*way, e])
                elif e.target not in seen or any(len(w) == len(way) + 1 and t == e.target for t, w in todo):
                    seen.add(e.target)
                    todo.append((e.target, [*way, e]))
        if not found:
            raise KeyError(f"no way from {table} to {name}")
        if len(found) > 1:
            ways = " or ".join(".".join(e.name for e in w) for w in found)
            raise ValueError(f"{name} can be reached from {table} in two ways: {ways}")
        return found[0]

    def of(self, table: str) -> Listing:
        return Listing(self, table)


@dataclass
class Listing:
    """Rows of a table. A path is the names of relations and then a column, joined by dots; a table that is met by two paths is joined under two names."""

    relations: Relations
    table: str
    conditions: list[tuple[str, str, object]] = field(default_factory=list)
    order: list[str] = field(default_factory=list)

    def resolve(self, path: str) -> tuple[tuple[str, ...], str, list[Relation]]:
        """(names of the relations passed, column, relations) of a path."""
        *names, column = path.split(".")
        at, passed, way = self.table, [], []
        for name in names:
            for e in self.relations.steps(at, name):
                passed.append(e.name)
                way.append(e)
                at = e.target
        if column not in self.relations.tables[at].columns:
            raise KeyError(f"{at} has no column {column}")
        return tuple(passed), column, way

    def where(self, path: str, condition: str, value: object = None) -> Listing:
        """Keeps rows whose column meets a condition of CONDITIONS. Over a relation to many rows: one of them meets it (neq: none is equal)."""
        if condition not in CONDITIONS:
            raise ValueError(f"unknown condition {condition}")
        self.resolve(path)
        self.conditions.append((path, condition, value))
        return self

    def sort(self, *paths: str) -> Listing:
        """By columns, `-` for descending; nulls come last either way."""
        self.order += paths
        return self

    def _used(self, paths: list[str]) -> dict[tuple[str, ...], Relation]:
        """Every relation on the ways of these paths once, shorter ways first."""
        used: dict[tuple[str, ...], Relation] = {}
        for path in paths:
            passed, _, way = self.resolve(path)
            if any(e.many for e in way):
                raise ValueError(f"{path} has many values for a row")
            for i, e in enumerate(way):
                used[passed[: i + 1]] = e
        return dict(sorted(used.items(), key=lambda kv: len(kv[0])))

    def _frame(self, table: str, passed: tuple[str, ...]) -> DataFrame:
        df = self.relations.tables[table]
        return df.select(*(F.col(f"`{c}`").alias(_name(passed, c)) for c in df.columns))

    def _joined(self, paths: list[str]) -> DataFrame:
        df = self._frame(self.table, ())
        for passed, e in self._used(paths).items():
            on = [F.col(_name(passed[:-1], a)) == F.col(_name(passed, b)) for a, b in zip(e.columns, e.target_columns)]
            df = df.join(self._frame(e.target, passed), reduce(Column.__and__, on), "left")
        return df

    def _met(self, path: str, condition: str, value: object) -> tuple[list[str], Callable[[DataFrame], DataFrame]]:
        """(paths that must be joined, what filters)."""
        passed, column, way = self.resolve(path)
        many = next((i for i, e in enumerate(way) if e.many), None)
        if many is None:
            return [path], lambda df: df.where(CONDITIONS[condition](F.col(_name(passed, column)), value))
        # the rows beyond the first relation to many are a list of their own, met by a semi join
        e, rest = way[many], ".".join((*(x.name for x in way[many + 1 :]), column))
        inner = Listing(self.relations, e.target).where(rest, "eq" if condition == "neq" else condition, value)
        keys = inner.frame(*e.target_columns).toDF(*(f"_k{i}" for i in range(len(e.columns)))).distinct()
        head = passed[:many]
        need = ".".join((*head, e.columns[0]))

        def keep(df: DataFrame) -> DataFrame:
            on = [F.col(_name(head, a)) == F.col(f"_k{i}") for i, a in enumerate(e.columns)]
            return df.join(keys, reduce(Column.__and__, on), "left_anti" if condition == "neq" else "left_semi")

        return [need], keep

    def frame(self, *paths: str) -> DataFrame:
        """The columns that paths name, in one plan: every relation used by columns, conditions or order is joined once."""
        met = [self._met(*c) for c in self.conditions]
        order = [p.removeprefix("-") for p in self.order]
        df = self._joined([*paths, *order, *(p for need, _ in met for p in need)])
        for _, keep in met:
            df = keep(df)
        if order:
            column = lambda p: F.col(_name(*self.resolve(p)[:2]))
            df = df.orderBy(*(column(p).desc_nulls_last() if a.startswith("-") else column(p).asc_nulls_last() for p, a in zip(order, self.order)))
        return df.select(*(F.col(_name(*self.resolve(p)[:2])).alias(p.replace(".", "_")) for p in paths))

    select = frame


def _name(passed: tuple[str, ...], column: str) -> str:
    """A column's name while tables are joined: its path, so that no two are alike."""
    return "__".join(("", *passed, column))
