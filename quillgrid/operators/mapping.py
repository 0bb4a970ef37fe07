"""Mapped inputs, trigger rules and schedule intervals."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST_MAPPED = 1024

#: Rule name to a condition on counts of upstream states: n all, s success, f failed, u upstream_failed, k skipped, d done. Fixed values.
TRIGGER_RULES = {
    "all_success": "s = n", "all_failed": "f + u = n", "all_done": "d = n", "all_skipped": "k = n",
    "one_success": "s > 0", "one_failed": "f + u > 0", "one_done": "s + f > 0",
    "none_failed": "d = n and f + u = 0", "none_skipped": "d = n and k = 0",
    "none_failed_min_one_success": "d = n and f + u = 0 and s > 0", "all_done_setup_success": "d = n and s > 0",
    "always": "true", "dummy": "true", "none_failed_or_skipped": "d = n and f + u = 0 and s > 0",
}


def trigger(df: DataFrame, by: list[str], state: str) -> DataFrame:
    """by, rule, ready for every group of upstream states."""
    is_ = lambda *names: F.count_if(F.col(state).isin(*names))
    counts = df.groupBy(*by).agg(
        F.count("*").alias("n"), is_("success").alias("s"), is_("failed").alias("f"), is_("upstream_failed").alias("u"), is_("skipped").alias("k"),
        is_("success", "failed", "upstream_failed", "skipped").alias("d"),
    )
    rows = F.array(*(F.struct(F.lit(r).alias("rule"), F.expr(q).alias("ready")) for r, q in TRIGGER_RULES.items()))
    return counts.select(*by, F.inline(rows))


def cartesian(lists: Mapping[str, Column], df: DataFrame, keep: list[str]) -> DataFrame:
    """All combinations of a row's lists with map_index, the last list fastest. A row with more than MOST_MAPPED combinations is an error."""
    size = None
    for values in lists.values():
        size = F.size(values).cast("bigint") if size is None else size * F.size(values)
    many = F.raise_error(F.concat(F.lit("combinations of one row, of which "), F.lit(str(MOST_MAPPED)), F.lit(" may be mapped: "), size.cast("string")))
    df = df.withColumn("_most", F.when(size > MOST_MAPPED, many.cast("int")).otherwise(F.lit(0)))
    for i, (name, values) in enumerate(lists.items()):
        df = df.select("*", F.posexplode(values).alias(f"_p{i}", name))
    index = F.col("_most")
    for i, values in enumerate(lists.values()):
        index = index * F.size(values) + F.col(f"_p{i}")
    return df.select(*keep, *lists, index.cast("int").alias("map_index"))


def zipped(a: Column, b: Column, longest: bool) -> Column:
    """Pairs by position; the longer list is cut unless `longest`, which pads with null."""
    both = F.arrays_zip(a.alias("a"), b.alias("b"))
    return both if longest else F.slice(both, 1, F.least(F.size(a), F.size(b)))


def zip_checked(a: Column, b: Column, message: str) -> Column:
    """Pairs by position as structs a, b, error; where the lists aren't as long, one pair without values and an error with both lengths."""
    wrong = F.struct(F.get(a, F.lit(-1)).alias("a"), F.get(b, F.lit(-1)).alias("b"), F.concat(F.lit(message), F.lit(": "), F.size(a).cast("string"), F.lit(" and "), F.size(b).cast("string")).alias("error"))
    pairs = F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b"), F.lit(None).cast("string").alias("error")))
    return F.when(F.size(a) == F.size(b), pairs).otherwise(F.array(wrong))


def intervals(ts: Column, unit: str) -> tuple[Column, Column]:
    """Start and end of the schedule interval that a time lies in."""
    start = F.date_trunc(unit, ts)
    step = {"hour": "INTERVAL 1 HOUR", "day": "INTERVAL 1 DAY", "month": "INTERVAL 1 MONTH", "week": "INTERVAL 7 DAYS"}[unit]
    return start, start + F.expr(step)


def last_status(log: DataFrame, key: str, status: str, ts: str, order: str) -> DataFrame:
    """Current status of every run from its event log."""
    return log.groupBy(key).agg(F.max_by(status, F.struct(ts, order)).alias(status), F.max(ts).alias(ts))


def requeue(log: DataFrame, key: str, status: str, ts: str, order: str, open_states: list[str]) -> DataFrame:
    """Runs left unfinished, as closing events."""
    return last_status(log, key, status, ts, order).where(F.col(status).isin(*open_states)).select(key, F.lit("E").alias(status))


def neighbours(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """Adds the previous and next run's time."""
    along = Window.partitionBy(*by).orderBy(order)
    return df.withColumn("previous", F.lag(order).over(along)).withColumn("following", F.lead(order).over(along))


def delta_intervals(ts: Column, start: str, step: str) -> tuple[Column, Column]:
    """Start and end of the interval of a fixed length, counted from `start`, that a time lies in."""
    first = F.to_timestamp(F.lit(start))
    length = F.unix_seconds(first + F.expr(f"INTERVAL {step}")) - F.unix_seconds(first)
    begin = F.unix_seconds(first) + F.floor((F.unix_seconds(ts.cast("timestamp")) - F.unix_seconds(first)) / length) * length
    return F.timestamp_seconds(begin), F.timestamp_seconds(begin + length)


def next_event(df: DataFrame, ts: str, events: list[str]) -> DataFrame:
    """Adds event: the first of a schedule's listed times at or after each time, null behind the last."""
    times = F.array(*(F.to_timestamp(F.lit(e)) for e in sorted(events)))
    return df.withColumn("event", F.get(F.filter(times, lambda e: e >= F.col(ts)), F.lit(0)))


def conditions(df: DataFrame, by: list[str], name: str, ready: Column, wanted: list[str]) -> DataFrame:
    """by, any_ready, all_ready: whether one, or every one, of the wanted datasets has an update that counts."""
    updated = F.collect_set(F.when(ready & F.col(name).isin(wanted), F.col(name)))
    return df.groupBy(*by).agg(updated.alias("_u")).select(*by, (F.size("_u") > 0).alias("any_ready"), (F.size("_u") == len(wanted)).alias("all_ready"))


def branch(df: DataFrame, choice: Column, tasks: list[str]) -> DataFrame:
    """One row per row and task: state `run` for the chosen one, `skipped` for the others; a choice that is no task is an error."""
    chosen = F.when(choice.isin(tasks), choice).otherwise(F.raise_error(F.concat(F.lit("no such task: "), F.coalesce(choice, F.lit("null")))).cast("string"))
    rows = df.withColumn("_c", chosen).withColumn("task", F.explode(F.array(*map(F.lit, tasks))))
    return rows.withColumn("state", F.when(F.col("task") == F.col("_c"), "run").otherwise("skipped")).drop("_c")
