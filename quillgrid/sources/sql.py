"""Parameterised and named queries over temporary views, and reads through JDBC."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession


@dataclass
class NamedQueries:
    """A catalogue of SQL texts with named parameters (`:name`)."""

    spark: SparkSession
    texts: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, sql: str) -> None:
        self.texts[name] = sql

    def rows(self, name: str, **args) -> DataFrame:
        return self.spark.sql(self.texts[name], args=args)

    def row(self, name: str, **args) -> Row | None:
        return self.rows(name, **args).first()

    def one(self, name: str, **args):
        row = self.row(name, **args)
        return row[0] if row else None

    def check(self, name: str, **args) -> bool:
        """Whether the first cell is truthy."""
        return bool(self.one(name, **args))


def statements(text: str) -> list[str]:
    """SQL text split at semicolons outside quotes."""
    out, quote, start = [], None, 0
    for i, c in enumerate(text):
        if quote:
            quote = None if c == quote else quote
        elif c in "'\"`":
            quote = c
        elif c == ";":
            out.append(text[start:i].strip())
            start = i + 1
    return [s for s in [*out, text[start:].strip()] if s]


def run_all(spark: SparkSession, text: str, args: Mapping | None = None, last: bool = True):
    """Every statement in turn; the last one's rows, or all of them."""
    results = [spark.sql(s, args=dict(args or {})) for s in statements(text)]
    return results[-1] if last else results


def named(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    if len(df.columns) != len(columns):
        raise ValueError(f"{len(df.columns)} columns, {len(columns)} names")
    return df.toDF(*columns)


def jdbc(spark: SparkSession, url: str, query: str, partition: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 1, **options: str) -> DataFrame:
    """A query against another database; with a partition column it is read in parallel ranges."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition and bounds:
        reader = reader.option("dbtable", f"({query}) q").option("partitionColumn", partition).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts)
    else:
        reader = reader.option("query", query)
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, commit_every: int = 1000, mode: str = "append", **options: str) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", commit_every).options(**options).mode(mode).save()


def in_list(column: str, values: Iterable) -> str | None:
    """`column IN (...)` with escaped literals; None for no values."""
    values = list(values)
    quoted = ["'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else str(v) for v in values]
    return f"{column} IN ({', '.join(quoted)})" if values else None
