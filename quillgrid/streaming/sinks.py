"""Ends of streams in the shared folder, so that no result passes through the driver, and a run that stops goes on where it was."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from quillgrid.operators.relational import not_in_log, work_folder
from quillgrid.sources.page_source import place
from quillgrid.sources.transactions import Tables


def batches(out: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each batch is a folder of its own; a batch that is run again takes the place of its first run."""

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return write


def written(spark: SparkSession, out: str, schema, last: bool = False) -> DataFrame:
    """What batches() wrote, or only its last batch (for complete mode)."""
    system, root = place(out)
    found = [f.base_name for f in system.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.base_name.startswith("batch=")]
    numbers = sorted(int(n.removeprefix("batch=")) for n in found)
    if not numbers:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{out}/batch={n}" for n in (numbers[-1:] if last else numbers)))


def to_end(df: DataFrame, mode: str, work: str | None = None) -> DataFrame:
    """Everything that is there now, as the rows of a table under `work` (checkpoint and batches). The same folder goes on where the last run ended."""
    work = work or work_folder(df.sparkSession)
    q = df.writeStream.foreachBatch(batches(f"{work}/out")).outputMode(mode).option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return written(df.sparkSession, f"{work}/out", df.schema, last=mode == "complete")


def take_in(df: DataFrame, keys: Sequence[str], time: str, late: str, tables: Tables, table: str, checkpoint: str, order: Sequence[str] = ()):
    """Starts a query that takes every key into a table once, whatever comes twice, in one batch or in two, late or after a restart.

    Repeats within the watermark go by state; a repeat that comes later is found in the table, as each batch leaves out what the table has. A batch is one
    transaction named by its number: run again, it is already there. Gives the running query (trigger: what is there now).
    """
    once = df.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))

    def write(batch: DataFrame, number: int) -> None:
        with tables.transaction(f"{table}-{number}") as t:
            if t.done:  # run again: only the stream's state has to be made
                batch.write.format("noop").mode("overwrite").save()
            else:
                log = tables.read(table)
                new = batch if log is None else not_in_log(batch, log, keys)
                t.insert(table, new, order=order)

    return once.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

