"""Joins, choices and merges that the pipeline needs beyond plain SQL verbs."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def latest_value(df: DataFrame, by: Sequence[str], value: str, order: str) -> DataFrame:
    """The value of the row with the highest `order` in each group."""
    return df.groupBy(*by).agg(F.max_by(value, order).alias(value))


def queue_head(df: DataFrame, status: str, created: str, key: str, ranks: dict[str, int], other: int, n: int = 1) -> DataFrame:
    """The first n rows by status rank, creation and key."""
    rank = reduce(lambda c, kv: c.when(F.col(status) == kv[0], kv[1]), list(ranks.items())[1:], F.when(F.col(status) == next(iter(ranks)), ranks[next(iter(ranks))])).otherwise(other)
    return df.orderBy(rank, created, key).limit(n)


def choose(df: DataFrame, by: Sequence[str], accepted: Column, score: str, order: str, values: Sequence[str], least: float = 0.5) -> DataFrame:
    """Among accepted rows the one with the highest score (ties: the first); it counts only above `least`. No accepted row: score -1."""
    best = F.max(F.when(accepted, F.struct(F.col(score).alias("s"), (-F.col(order)).alias("o"), *values)))
    out = df.groupBy(*by).agg(best.alias("b")).withColumn("confidence", F.coalesce("b.s", F.lit(-1.0)))
    return out.select(*by, "confidence", *(F.when(F.col("confidence") > least, F.col(f"b.{v}")).alias(v) for v in values))


def merge_maps(df: DataFrame, by: Sequence[str], entries: str, order: str) -> DataFrame:
    """Maps of a group merged; the later row wins."""
    pairs = df.select(*by, order, F.explode(entries).alias("k", "v"))
    last = pairs.groupBy(*by, "k").agg(F.max_by("v", order).alias("v"))
    return last.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias(entries))


def positional_merge(a: DataFrame, b: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Rows matched by position within each group; unmatched rows of either side stay."""
    numbered = lambda d: d.withColumn("pos", F.row_number().over(Window.partitionBy(*by).orderBy(order))).drop(order)
    return numbered(a).join(numbered(b), [*by, "pos"], "full")


def update_by_position(old: Column, new: Column) -> Column:
    """Lists of maps merged by position: a later value of a key takes the place of the earlier one; the longer list's rest stays."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return F.zip_with(old, new, lambda a, b: F.map_concat(F.map_filter(F.coalesce(a, empty), lambda k, _: ~F.array_contains(F.map_keys(F.coalesce(b, empty)), k)), F.coalesce(b, empty)))


def not_in_log(df: DataFrame, log: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows that no log entry names."""
    return df.join(log.select(*on).distinct(), list(on), "left_anti")


def keep_last(df: DataFrame, by: Sequence[str], order: str, n: int = 1) -> DataFrame:
    """The n latest rows of each group."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(F.col(order).desc()))).where(f"_k <= {n}").drop("_k")


def superseded(df: DataFrame, by: Sequence[str], order: str, n: int = 1) -> DataFrame:
    """The rows of each group beyond its n latest, from one pass: what a cleanup that keeps those deletes."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(F.col(order).desc()))).where(f"_k > {n}").drop("_k")


def by_status(df: DataFrame, status: str, good: str = "success") -> tuple[DataFrame, DataFrame]:
    """(rows with the good status, without that column, so that they can be used again; all others, those without a status among them)."""
    ok = F.col(status).eqNullSafe(good)
    return df.where(ok).drop(status), df.where(~ok)


def orphans(df: DataFrame, key: str, *others: tuple[DataFrame, str]) -> DataFrame:
    """Rows that none of the other tables refers to."""
    return reduce(lambda d, o: d.join(o[0].select(F.col(o[1]).alias(key)).distinct(), key, "left_anti"), others, df)


def union_counts(parts: Sequence[tuple[str, DataFrame]], by: Sequence[str], states: Sequence[str], state: str) -> DataFrame:
    """Counts per group and state of several relations together, zero where there are none."""
    both = reduce(DataFrame.unionByName, (d.select(*by, state) for _, d in parts))
    counts = both.groupBy(*by, state).count()
    every = both.select(*by).distinct().select("*", F.explode(F.array(*map(F.lit, states))).alias(state))
    return every.join(counts, [*by, state], "left").select(*by, state, F.coalesce("count", F.lit(0)).alias("n"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; only where that is unset and all runs on one machine, a temporary one."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if sc.getCheckpointDir() is None:
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="quillgrid-"))
    return (named or sc.getCheckpointDir()).rstrip("/")


def work_folder(spark: SparkSession) -> str:
    """A new folder in the shared one, which goes when the application ends."""
    path = f"{shared_folder(spark)}/work-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def settle(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def hierarchy(edges: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, ancestor, level) for every ancestor at any depth, by doubling: each round joins the farthest ancestors known with all of theirs.

    A chain of n nodes takes log2 n rounds. Nodes in a circle would have ancestors without end: they are an error.
    """
    up = edges.where(F.col(parent).isNotNull()).select(F.col(node).alias("node"), F.col(parent).alias("ancestor"), F.lit(1).alias("level")).distinct()
    up, reach = settle(up), 1
    nodes = up.select("node").distinct().count()
    while True:
        far = up.where(F.col("level") == reach).select("node", F.col("ancestor").alias("via"))
        more = far.join(up.select(F.col("node").alias("via"), "ancestor", (F.col("level") + reach).alias("level")), "via").select("node", "ancestor", "level")
        more = settle(more)
        if more.isEmpty():
            return up
        if reach > nodes:
            raise ValueError("the hierarchy has a circle")
        up, reach = settle(up.unionByName(more)), reach * 2


def page_merge(pages: DataFrame, by: Sequence[str], page: str, rows: str) -> DataFrame:
    """Row lists of consecutive pages folded into one. A page's first row is held against the row that the fold so far has as many rows from its end as the page has
    rows (its first one, if it has fewer): when they share no key and the lists are as long, rows merge by position (the later value wins); otherwise they
    are appended. A page without rows changes nothing. `rows` is array<map<string, string>>."""
    def fold(acc: Column, item: Column) -> Column:
        over = F.greatest(F.lit(1), F.size(acc) - F.size(item) + 1)
        shared = F.arrays_overlap(F.map_keys(F.try_element_at(acc, over)), F.map_keys(F.try_element_at(item, F.lit(1))))
        merged = F.zip_with(acc, item, lambda a, b: F.map_concat(F.map_filter(a, lambda k, _: ~F.array_contains(F.map_keys(b), k)), b))
        return F.when(F.size(item) == 0, acc).when(F.size(acc) == 0, item).when(F.coalesce(shared, F.lit(True)) | (F.size(acc) != F.size(item)), F.concat(acc, item)).otherwise(merged)

    ordered = pages.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(page, F.to_json(rows).alias("r")))).alias("p"))
    lists = F.transform("p", lambda s: F.from_json(s["r"], "array<map<string,string>>"))
    empty = F.array().cast("array<map<string,string>>")
    return ordered.select(*by, F.aggregate(lists, empty, fold).alias(rows))


def points_in_boxes(points: DataFrame, boxes: DataFrame, x: str, y: str, cell: float) -> DataFrame:
    """points with the boxes (box, x0, y0, x1, y1) that hold them, edges included. Both sides meet by the y cells that a box covers, then exactly."""
    low, high = F.floor(F.col("y0") / cell), F.floor(F.col("y1") / cell)
    spread = boxes.where("x0 <= x1 and y0 <= y1").withColumn("_cell", F.explode(F.sequence(low, high)))
    near = points.withColumn("_cell", F.floor(F.col(y) / cell)).join(spread, "_cell")
    return near.where(F.col(x).between(F.col("x0"), F.col("x1")) & F.col(y).between(F.col("y0"), F.col("y1"))).drop("_cell")


def latest_joined(fact: DataFrame, by: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """fact with the values that its group's latest row has (named latest_...)."""
    last = fact.groupBy(*by).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_l"))
    return fact.join(last, list(by)).select(*fact.columns, *(F.col(f"_l.{c}").alias(f"latest_{c}") for c in columns))


def optional_join(df: DataFrame, other: DataFrame, on: Column, asked: Column | None) -> DataFrame:
    """Outer while nothing is asked of the other side; inner, filtered, once something is."""
    return df.join(other, on, "left") if asked is None else df.join(other, on).where(asked)


def first_gap(df: DataFrame, by: Sequence[str], start: str, length: str, least: float, after: float) -> DataFrame:
    """The first gap of at least `least` to the next part that begins (where the part before it ends) after `after`: gap_start, gap."""
    along = Window.partitionBy(*by).orderBy(start, length)
    end = F.col(start) + F.col(length)
    gaps = df.withColumn("gap_start", end).withColumn("gap", F.lead(start).over(along) - end).where((F.col("gap") >= least) & (F.col("gap_start") > after))
    return gaps.groupBy(*by).agg(F.min_by(F.struct("gap_start", "gap"), start).alias("g")).select(*by, "g.*")
