"""Queues of work as rows: what comes next, and what an end changes. States as in streaming.runs: H before W; U isn't ready."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How runs are named by what started them. Fixed values.
BY_HAND, BY_TIME, BY_CHAIN = "manual__", "scheduled__", "manual--"


def ranked(queue: DataFrame, by: Sequence[str], created: str, key: str) -> DataFrame:
    """Adds turn: the place of each waiting row (H before W, then by time and key) in its queue; null for others."""
    rank = F.when(F.col("status") == "H", 1).when(F.col("status") == "W", 2)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(rank.asc_nulls_last(), created, key))
    return queue.withColumn("turn", F.when(rank.isNotNull(), place))


def targets(queue: DataFrame, by: Sequence[str], created: str, key: str, run_id: Column) -> DataFrame:
    """What each queue's run takes, as a target: by, key, run_id. A queue in which nothing waits has none."""
    return ranked(queue, by, created, key).where("turn = 1").select(*by, key, run_id.alias("run_id"))


def finish(queue: DataFrame, by: Sequence[str], created: str, key: str, run_id: Column) -> DataFrame:
    """by, key, status, kind after each queue's first row is done. key is null for a new row.

    The row is `closed` (C), and a `new` one for the same work waits unready (U), so that a chain can't run in a circle. A run that was started by hand makes all that is unready ready (`promoted`, W);
    one that was started by time or by a chain goes on with the `next` waiting row, and only when there is none makes them ready. Any other run changes nothing else. A queue without a waiting row stays.
    """
    rows = ranked(queue, by, created, key)
    waiting = F.count("turn").over(Window.partitionBy(*by))
    chained = run_id.startswith(BY_TIME) | run_id.startswith(BY_CHAIN)
    ready = run_id.startswith(BY_HAND) | (chained & (waiting <= 1))
    rows = rows.withColumn("_some", waiting > 0).withColumn("_ready", F.coalesce(ready, F.lit(False)) & (waiting > 0)).withColumn("_chained", F.coalesce(chained, F.lit(False)))
    kind = F.when(F.col("turn") == 1, "closed").when((F.col("turn") == 2) & F.col("_chained"), "next").when((F.col("status") == "U") & F.col("_ready"), "promoted").otherwise("kept")
    status = F.when(kind == "closed", "C").when(kind == "promoted", "W").otherwise(F.col("status"))
    old = F.struct(F.col(key).alias("key"), status.alias("status"), kind.alias("kind"))
    none = F.lit(None).cast(queue.schema[key].dataType)
    new = F.struct(none.alias("key"), F.when(F.col("_ready"), "W").otherwise("U").alias("status"), F.lit("new").alias("kind"))
    made = F.when(F.col("turn") == 1, F.array(old, new)).otherwise(F.array(old))
    return rows.select(*by, F.inline(made)).withColumnRenamed("key", key)
