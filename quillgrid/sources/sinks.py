"""Writing: append, replace by key, archive, dated folders, exports and transfers between formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.operators.load import assign_keys


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _fs(spark, path)
    return fs.exists(place)


def save_json(df: DataFrame, path: str, duplicate: str = "overwrite") -> str:
    """overwrite, skip, or exists_backup (what was there moves to the first free `path.bakN`)."""
    spark = df.sparkSession
    fs, place = _fs(spark, path)
    if fs.exists(place):
        if duplicate == "skip":
            return path
        if duplicate == "exists_backup":
            n = 1
            while exists(spark, f"{path}.bak{n}"):
                n += 1
            fs.rename(place, _fs(spark, f"{path}.bak{n}")[1])
    df.write.mode("overwrite").json(path)
    return path


def copy_file(spark: SparkSession, source: str, target: str, duplicate: str = "auto_rename", move: bool = False) -> str:
    """auto_rename picks the first free `stem_N.suffix`; skip, overwrite as named."""
    fs, place = _fs(spark, source)
    if exists(spark, target):
        if duplicate == "skip":
            return target
        if duplicate == "auto_rename":
            stem, dot, suffix = target.rpartition(".")
            stem, suffix = (stem, dot + suffix) if dot else (target, "")
            n = 1
            while exists(spark, f"{stem}_{n}{suffix}"):
                n += 1
            target = f"{stem}_{n}{suffix}"
    other, to = _fs(spark, target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, place, other, to, move, True, spark._jsc.hadoopConfiguration())
    return target


def delete(spark: SparkSession, path: str) -> bool:
    fs, place = _fs(spark, path)
    return fs.delete(place, True)


def insert(df: DataFrame, path: str, key: str | None = None, order: Sequence[str] = ()) -> None:
    """Append, with new keys after the highest one stored."""
    spark = df.sparkSession
    if key:
        high = spark.read.parquet(path).agg(F.max(key)).first()[0] if exists(spark, path) else None
        df = assign_keys(df, key, list(order), int(high or 0))
    df.write.mode("append").parquet(path)


def replace_rows(stored: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """stored with the rows of `new` instead of those with the same keys: to be written as the table's next version."""
    return stored.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def update_rows(stored: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """stored with `columns` of the rows that `changes` names by keys set to what it has, nulls too: the table's next version. Keys of changes that aren't stored do nothing; several
    changes of one row are an error."""
    named = changes.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.struct(*columns).alias("_new"))
    once = named.groupBy(*(f"_k{i}" for i in range(len(keys)))).agg(F.max("_new").alias("_new"), F.count("*").alias("_n"))
    once = once.withColumn("_new", F.when(F.col("_n") == 1, F.col("_new")).otherwise(F.raise_error(F.lit("several changes of one row"))))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    set_ = lambda c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
    return stored.join(once, on, "left").select(*(set_(c) if c in columns else F.col(c) for c in stored.columns))


def split_archive(df: DataFrame, gone: Column) -> tuple[DataFrame, DataFrame]:
    """(archive, remainder) for archive-then-delete; null counts as staying."""
    flag = F.coalesce(gone, F.lit(False))
    return df.where(flag), df.where(~flag)


def archive_dated(df: DataFrame, path: str, day: Column, mode: str = "append") -> None:
    """Completed or failed documents under y=/m=/d= folders."""
    df.withColumns({"y": F.year(day), "m": F.month(day), "d": F.dayofmonth(day)}).write.mode(mode).partitionBy("y", "m", "d").parquet(path)


def sheet(name: Column) -> Column:
    """Sheet names have 31 characters at most."""
    return F.substring(name, 1, 31)


def export(df: DataFrame, path: str, form: str = "csv", null_marker: str = "", max_rows_per_file: int = 0) -> None:
    """csv (with header), json, parquet or orc; only nulls become the marker."""
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_rows_per_file)
    {"csv": lambda: writer.option("header", True).option("nullValue", null_marker).csv(path), "json": lambda: writer.option("ignoreNullFields", False).json(path), "parquet": lambda: writer.parquet(path), "orc": lambda: writer.orc(path)}[form]()


def transfer(source: DataFrame, target: str, form: str = "parquet", before: Sequence[str] = (), columns: Sequence[str] | None = None, rename: dict[str, str] | None = None) -> None:
    """Select, run statements, then write: the common part of moves between stores."""
    for sql in before:
        source.sparkSession.sql(sql)
    df = source.select(*columns) if columns else source
    for a, b in (rename or {}).items():
        df = df.withColumnRenamed(a, b)
    export(df, target, form)
