"""Row, column and record structure from coordinates and order, by window functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _gap_sum(flag: Column, over) -> Column:
    return F.sum(flag.cast("int")).over(over.rowsBetween(Window.unboundedPreceding, 0))


def grid(blocks: DataFrame, by: Sequence[str], x: str, y: str, order: str, gap: float | None = None) -> DataFrame:
    """Adds row and col (from 1). A row ends where y grows by more than `gap`; without one, by more than mean + population deviation of the growths.

    A single block is (1, 1). The first block opens row 1 only if its y is above 0; at 0 it stays in row 0.
    """
    down = Window.partitionBy(*by).orderBy(y, order)
    whole = Window.partitionBy(*by)
    df = blocks.withColumn("_dy", F.col(y) - F.lag(y).over(down)).withColumn("_n", F.count("*").over(whole))
    limit = F.lit(float(gap)) if gap is not None else F.coalesce(F.avg("_dy").over(whole) + F.stddev_pop("_dy").over(whole), F.lit(100.0))
    df = df.withColumn("_limit", limit)
    new = F.when(F.col("_dy").isNull(), F.col(y) > 0).otherwise(F.col("_dy") > F.col("_limit"))
    df = df.withColumn("_rank", F.row_number().over(down)).withColumn("row", _gap_sum(new, down))
    across = Window.partitionBy(*by, "row").orderBy(x, "_rank")
    df = df.withColumn("col", F.row_number().over(across))
    return df.withColumn("row", F.when(F.col("_n") == 1, 1).otherwise(F.col("row")).cast("int")).drop("_dy", "_n", "_limit", "_rank")


def gap_clusters(df: DataFrame, by: Sequence[str], value: str, order: str, method: str) -> DataFrame:
    """Adds cluster (from 1): a new one where the gap to the previous value exceeds mean_std, median_std or p75 of the gaps."""
    along, whole = Window.partitionBy(*by).orderBy(value, order), Window.partitionBy(*by)
    df = df.withColumn("_gap", F.col(value) - F.lag(value).over(along))
    limits = {
        "mean_std": F.avg("_gap").over(whole) + F.stddev_pop("_gap").over(whole),
        "median_std": F.expr("percentile(_gap, 0.5)").over(whole) + F.stddev_pop("_gap").over(whole),
        "p75": F.expr("percentile(_gap, 0.75)").over(whole),
    }
    df = df.withColumn("_limit", limits[method])
    return df.withColumn("cluster", (1 + _gap_sum(F.coalesce(F.col("_gap") > F.col("_limit"), F.lit(False)), along)).cast("int")).drop("_gap", "_limit")


def islands(df: DataFrame, by: Sequence[str], flag: str, order: str) -> DataFrame:
    """Runs of rows with a true flag: start, length of each."""
    marked = df.withColumn("_id", F.col(order) - F.row_number().over(Window.partitionBy(*by, flag).orderBy(order))).where(F.col(flag))
    return marked.groupBy(*by, "_id").agg(F.min(order).alias("start"), F.count("*").alias("length")).drop("_id")


def first_run(df: DataFrame, by: Sequence[str], flag: str, order: str, least: int, after: int = -1) -> DataFrame:
    """The first run of true flags of at least `least` rows that starts after `after`."""
    runs = islands(df, by, flag, order).where((F.col("length") >= least) & (F.col("start") > after))
    return runs.groupBy(*by).agg(F.min("start").alias("start"), F.min_by("length", "start").alias("length"))


def join_words(df: DataFrame, by: Sequence[str], text: str, left: str, width: str, height: str, share: float = 0.55) -> DataFrame:
    """One text per line: a space unless the gap to the next word is below `share` of the mean height of the words that have one."""
    along, whole = Window.partitionBy(*by).orderBy(left), Window.partitionBy(*by)
    gap = F.lead(left).over(along) - (F.col(left) + F.col(width))
    tall = F.avg(F.when(F.col(height) > 0, F.col(height))).over(whole)
    tail = F.when(gap.isNull() | F.coalesce(gap < share * tall, F.lit(False)), F.lit("")).otherwise(F.lit(" "))
    df = df.select(*by, F.row_number().over(along).alias("_k"), F.concat(text, tail).alias("_t"))
    return df.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", "_t"))), lambda s: s["_t"]), "").alias("text"))


def merge_segments(df: DataFrame, by: Sequence[str], start: str, end: str, level: str, gap: float = 10, slack: float = 5) -> DataFrame:
    """Segments joined with the one before when the level differs by at most `slack` and the gap by at most `gap`: start, end, length. Missing values come last."""
    along = Window.partitionBy(*by).orderBy(*(F.col(c).asc_nulls_last() for c in (level, start, end)))
    new = (F.abs(F.col(level) - F.lag(level).over(along)) > slack) | (F.col(start) - F.lag(end).over(along) > gap) | (F.col(start) < F.lag(start).over(along))
    df = df.withColumn("_new", F.coalesce(new, F.lit(True)))
    df = df.withColumn("segment", _gap_sum(F.col("_new"), along))
    return df.groupBy(*by, "segment").agg(F.min(start).alias("start"), F.max(end).alias("end")).withColumn("length", F.col("end") - F.col("start"))


def template_row(row: Column, first: Column, count: Column) -> Column:
    """The template row that a repeated row stands for."""
    return F.pmod(row - first, count) + first


def expand_template(template: DataFrame, grid_rows: DataFrame, by: Sequence[str], needed: str, row: str = "row", kind: str = "cell_type") -> DataFrame:
    """Template cells, those of kind `val` repeated with shifted row numbers until the template's rows reach the grid's `needed` rows; adds repeat (0: as given).

    What repeats is as high as the value rows reach; other cells (headers) stay at their place, once.
    """
    val = F.when(F.col(kind) == "val", F.col(row))
    size = template.groupBy(*by).agg(F.max(row).alias("_last"), (F.max(val) - F.min(val) + 1).alias("_step"))
    joined = template.join(size, list(by)).join(grid_rows, list(by))
    more = F.when((F.col(kind) == "val") & (F.col(needed) > F.col("_last")), F.ceil((F.col(needed) - F.col("_last")) / F.col("_step"))).otherwise(0).cast("int")
    out = joined.withColumn("repeat", F.explode(F.sequence(F.lit(0), more)))
    return out.withColumn(row, (F.col(row) + F.col("_step") * F.col("repeat")).cast("int")).drop("_last", "_step")


def record_numbers(cells: DataFrame, by: Sequence[str], column: str, order: Sequence[str]) -> DataFrame:
    """Adds record_no: reading each group in order, a new record starts where a column comes that the current record already has.

    Where records start depends on where the one before started, so it is folded over each group's repeated columns (their places only); the numbers
    themselves are a running count.
    """
    along = Window.partitionBy(*by).orderBy(*order)
    cells = cells.withColumn("_k", F.row_number().over(along))
    cells = cells.withColumn("_before", F.coalesce(F.lag("_k").over(Window.partitionBy(*by, column).orderBy("_k")), F.lit(0)))
    again = cells.where("_before > 0").groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_k", "_before"))).alias("_a"))
    starts = F.aggregate("_a", F.array(F.lit(1)), lambda s, x: F.when(x["_before"] >= F.element_at(s, -1), F.concat(s, F.array(x["_k"]))).otherwise(s))
    starts = again.select(*(F.col(b).alias(f"_b{i}") for i, b in enumerate(by)), F.explode(F.slice(starts, F.lit(2), F.size(starts))).alias("_start"))
    same = [F.col(b).eqNullSafe(F.col(f"_b{i}")) for i, b in enumerate(by)]
    joined = cells.join(starts, [*same, F.col("_k") == F.col("_start")], "left")
    return joined.withColumn("record_no", (1 + _gap_sum(F.col("_start").isNotNull(), along)).cast("int")).drop("_k", "_before", "_start", *(f"_b{i}" for i in range(len(by))))


def first_seen(df: DataFrame, by: Sequence[str], field: str, order: str) -> DataFrame:
    """Rows whose field value wasn't there before."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*by, field).orderBy(order))).where("_k = 1").drop("_k")
