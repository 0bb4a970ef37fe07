"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: U+0020 and U+0009 to U+000D.
GAP = "[ \\t-\\r]+"
GAP_CHARS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The maximal runs of characters other than GAP_CHARS; none for null."""
    return F.array_remove(F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARS)), GAP), "")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the decimal id modulo n; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it was."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only where that is unset and all runs on one machine (tests), a temporary folder is set."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if current is None:
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="quillgrid-"))
    return named or sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder, so that a lost executor costs no earlier stage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(df: DataFrame) -> DataFrame:
    """Like cut(), as a columnar table: smaller than a checkpoint, and later readers can prune columns. It goes when the application ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches of at most `rows` rows to Python workers, so that long texts don't fill their memory. Lowers the session's own setting, which
    has to hold when the query runs; a setting that is lower already stays."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
