"""Windowed aggregation with watermarks, deduplication and run state on streams of events.

The *_by_stream functions read the events table as a file stream, process what is there (AvailableNow) and give the rows that the sink wrote.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.operators.relational import work_folder
from quillgrid.sources.page_source import place
from quillgrid.sources.transactions import Tables
from quillgrid.streaming import runs
from quillgrid.streaming.sinks import take_in, to_end

LATENESS = "30 days"


def tumbling(events: DataFrame, length: str, slide: str | None = None, late: str = LATENESS) -> DataFrame:
    """Counts by window and event type; tumbling, or sliding with `slide`."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    events = events.withWatermark("ts", late) if events.isStreaming else events
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    return events.groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str, late: str = LATENESS) -> DataFrame:
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    events = events.withWatermark("ts", late) if events.isStreaming else events
    return events.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events.parquet as a stream of arriving files."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        return spark.readStream.schema(schema).parquet(path)
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def first_by_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of every user and type."""
    return to_end(source(spark, sf_dir).groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id")), "complete")


def totals_by_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_end(source(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")), "complete")


def states_by_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last status reported for every run, and the number of reports."""
    return to_end(source(spark, sf_dir).groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("status"), F.count("*").alias("n")), "complete")


def twice_by_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event reported twice, as two runs of a query deliver it, taken in once. The second run begins from the first one's checkpoint."""
    work = work_folder(spark)
    tables = Tables(spark, f"{work}/tables")
    for _ in range(2):
        events = source(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
        again = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 MINUTE"))
        take_in(events.unionByName(again), ["event_id"], "ts", LATENESS, tables, "events", f"{work}/checkpoint").awaitTermination()
    return tables.read("events")


def moves_by_stream(spark: SparkSession, sf_dir: str, limit: int) -> DataFrame:
    """The moves of every user's run: the status of an event is the letter of runs.STATES that its id stands for. Marks after the last event close what is open."""
    work = work_folder(spark)
    ts = F.col("ts").cast("timestamp")
    reports = source(spark, sf_dir).select(
        F.col("user_id").cast("bigint").alias("run_id"), ts.alias("ts"), F.unix_micros(ts).alias("at"), F.col("event_id").cast("bigint").alias("event_id"),
        F.substr(F.lit(runs.STATES), (F.col("event_id") % len(runs.STATES) + 1).cast("int"), F.lit(1)).alias("status"),
    )
    schema = "run_id bigint, ts timestamp, at bigint, event_id bigint, status string"
    place(f"{work}/marks")[0].create_dir(place(f"{work}/marks")[1], recursive=True)
    end = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.max("ts").cast("date").cast("string")).first()[0]
    later = [str(pd.Timestamp(end) + pd.Timedelta(days=d)) for d in (400, 401)] if end else []
    out = None
    for _ in (None, *runs.marks(spark, f"{work}/marks", later)):
        closing = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{work}/marks")
        with runs.state_store(spark):
            out = to_end(runs.run_states(reports.unionByName(closing), limit, "10 minutes"), "append", work)
    return out
