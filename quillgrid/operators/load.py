"""Loading structured records: keys, hierarchy, wide export and translation log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgrid.operators.relational import settle

#: Columns that one wide table may have.
MOST_COLUMNS = 10_000


def assign_keys(df: DataFrame, name: str, order: Sequence[str], start: int = 0, partitions: Sequence[str] = (), rows_per_range: int = 1_000_000) -> DataFrame:
    """Dense keys after `start` in the given order (nulls first), or from 1 within each of `partitions`.

    Over many rows the whole order is cut into ranges that are ranked in parallel. Rows equal in all of `order`, and so all nulls, are dealt to several
    ranges, in any order among themselves. The ranges are kept in the shared folder, so a recomputed task finds the same ones.
    """
    if partitions:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*partitions).orderBy(*order)) + start)
    ranges = max(1, min(2000, df.count() // rows_per_range))
    if ranges == 1:  # at most rows_per_range rows, or twice as many
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)) + start)
    spread = settle(df.withColumn("_tie", F.rand(7)).repartitionByRange(ranges, *order, "_tie").withColumn("_range", F.spark_partition_id()))
    sizes = {r[0]: r[1] for r in spread.groupBy("_range").count().collect()}  # at most 2000 rows
    before = accumulate((sizes.get(i, 0) for i in range(max(sizes, default=0))), initial=start)
    before = F.element_at(F.array(*(F.lit(b).cast("bigint") for b in before)), F.col("_range") + 1)
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order, "_tie"))
    return spread.withColumn(name, before + inside).drop("_range", "_tie")


def insert_plan(tables: Mapping[str, tuple[DataFrame, str | None]], start: Mapping[str, int] | None = None) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """What to insert, at any depth: (rows by table with their pk and parent_pk), (doc_id, table_name, pk) of all, (doc_id, table_name, _id, reason) of what can't be.

    tables: name to (rows with doc_id, _id, _par_id, parent table or None). Parents come first. A table without a parent takes exactly one record of a
    document: several are an error of all of them, and what hangs on them fails, too. A row whose _par_id names no inserted row of its document fails. Keys
    are dense after `start` in the order of doc_id and _id.
    """
    done: dict[str, DataFrame] = {}
    failed: list[DataFrame] = []
    todo = dict(tables)
    while todo:
        ready = [n for n, (_, parent) in todo.items() if parent is None or parent in done]
        if not ready:
            raise ValueError(f"tables without a way to a root: {sorted(todo)}")
        for name in ready:
            rows, parent = todo.pop(name)
            if parent is None:
                rows = rows.withColumn("_n", F.count("*").over(Window.partitionBy("doc_id"))).withColumn("parent_pk", F.lit(None).cast("bigint"))
                bad, reason = F.col("_n") > 1, "several roots"
            else:
                heads = done[parent].select(F.col("doc_id").alias("_doc"), F.col("_id").alias("_head"), F.col("pk").cast("bigint").alias("parent_pk"))
                rows = rows.join(heads, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_par_id") == F.col("_head")), "left").drop("_doc", "_head").withColumn("_n", F.lit(1))
                bad, reason = F.col("parent_pk").isNull(), "parent missing"
            failed.append(rows.where(bad).select("doc_id", F.lit(name).alias("table_name"), "_id", F.lit(reason).alias("reason")))
            done[name] = assign_keys(rows.where(~bad).drop("_n"), "pk", ["doc_id", "_id"], (start or {}).get(name, 0))
    kept = reduce(DataFrame.unionByName, [d.select("doc_id", F.lit(n).alias("table_name"), F.col("pk").cast("bigint").alias("pk")) for n, d in done.items()])
    return done, kept, reduce(DataFrame.unionByName, failed)


def child_rows(children: DataFrame, parents: DataFrame, on: Sequence[str], parent_key: str) -> DataFrame:
    """Children with their parent's key; children without a parent are left to violations()."""
    return children.join(parents.select(*on, parent_key), list(on))


def violations(children: DataFrame, parents: DataFrame, on: Sequence[str], key: str) -> DataFrame:
    """Rows that can't be loaded: no parent, or several parents."""
    counts = parents.groupBy(*on).agg(F.count("*").alias("_n"))
    joined = children.join(counts, list(on), "left").where(F.coalesce("_n", F.lit(0)) != 1)
    return joined.select(key, F.when(F.coalesce("_n", F.lit(0)) == 0, "parent missing").otherwise("several parents").alias("reason"))


def wide(cells: DataFrame, by: Sequence[str], name: str, value: str, names: Sequence[str] | None = None) -> DataFrame:
    """One row per record, columns in sorted order of their names; missing cells are empty."""
    if names is None:
        names = [r[0] for r in cells.select(name).distinct().limit(MOST_COLUMNS + 1).collect()]
        if len(names) > MOST_COLUMNS:
            raise ValueError(f"more than {MOST_COLUMNS} columns; a sheet can't be made of them")
    names = sorted(names)
    return cells.groupBy(*by).pivot(name, names).agg(F.max(value)).na.fill("", names)


def translation_rows(df: DataFrame, key: str, table: str, columns: Sequence[str], foreign: Column | None, log: DataFrame) -> DataFrame:
    """One log row per text cell that needs translating; a row without one logs itself. Rows already in the log are left out."""
    todo = df.join(log.where(F.col("table_name") == table).select(F.col("row_key").alias(key)).distinct(), key, "left_anti")
    cells = todo.select(F.col(key).cast("string").alias("row_key"), F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("text")) for c in columns))).alias("c"))
    cells = cells.select("row_key", "c.*")
    wanted = cells.where((F.trim("text") != "") & (foreign if foreign is not None else F.lit(True)))
    own = todo.select(F.col(key).cast("string").alias("row_key")).join(wanted.select("row_key").distinct(), "row_key", "left_anti")
    own = own.select("row_key", F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("string").alias("text"))
    return wanted.unionByName(own).select(F.lit(table).alias("table_name"), "row_key", "column_name", "text")


def dictionary_hits(texts: DataFrame, text: str, words: Sequence[str]) -> DataFrame:
    """How often each dictionary word occurs in all texts, without overlap."""
    t = F.coalesce(F.col(text), F.lit(""))
    hits = texts.agg(*(F.sum((F.length(t) - F.length(F.replace(t, F.lit(w), F.lit("")))) / len(w)).cast("bigint").alias(f"w{i}") for i, w in enumerate(words)))
    return hits.select(F.inline(F.array(*(F.struct(F.lit(w).alias("word"), F.coalesce(F.col(f"w{i}"), F.lit(0)).alias("hits")) for i, w in enumerate(words)))))
