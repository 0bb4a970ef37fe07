"""Files as tables: folder scans, page rows, JSON and correction dictionaries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

IMAGES = r"\.(png|jpe?g)$"
CHARSETS = ("utf-8", "cp949", "utf-16")


def scan(spark: SparkSession, folder: str, recursive: bool = True, pattern: str | None = None) -> DataFrame:
    """path, modificationTime, length, content of every file; `pattern` is matched against the lower-cased path."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return df.where(F.lower("path").rlike(pattern)) if pattern else df


def image_paths(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    return scan(spark, folder, recursive, IMAGES).select("path")


def file_info(files: DataFrame) -> DataFrame:
    """file_id (a digest of the path, the same in every run), name, stem, suffix."""
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(F.sha2("path", 256).alias("file_id"), "path", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1)).alias("suffix"))


def pages(files: DataFrame, render: Callable[[bytes], list[bytes]] | None = None) -> DataFrame:
    """file_id, layout_id, page_num, image: PDFs become one row per page through `render`; other files are one page without a layout."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for file_id, path, content in zip(b["file_id"], b["path"], b["content"]):
                if path.lower().endswith(".pdf") and render is not None:
                    rows += [(file_id, f"{file_id}_{i}", i, page) for i, page in enumerate(render(bytes(content)), 1)]
                else:
                    rows.append((file_id, None, 1, bytes(content)))
            yield pd.DataFrame(rows, columns=["file_id", "layout_id", "page_num", "image"])

    source = files.select(F.sha2("path", 256).alias("file_id"), "path", "content")
    return source.mapInPandas(run, "file_id string, layout_id string, page_num int, image binary")


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise FileNotFoundError("no file found")
    return df


def decode(content: Column, charsets: tuple[str, ...] = CHARSETS) -> Column:
    """Text in the first character set that fits; null if none does."""

    def run(batch: pd.Series) -> pd.Series:
        def one(raw):
            for charset in charsets:
                try:
                    return bytes(raw).decode(charset)
                except UnicodeDecodeError:
                    continue
            return None

        return batch.map(one)

    return F.pandas_udf(run, "string")(content)


def read_json(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """path and data of every JSON file; data is null where a file can't be read as the schema."""
    files = scan(spark, folder, pattern=r"\.json$")
    return files.select("path", F.from_json(decode(F.col("content")), schema, {"mode": "PERMISSIVE"}).alias("data"))


def correction_dictionary(spark: SparkSession, path: str, charset: str = "cp949") -> DataFrame:
    """err, fix from a two-column CSV: quotes stripped, blank errors dropped, longest first, then by text."""
    content = spark.read.format("binaryFile").load(path).select(decode(F.col("content"), (charset,)).alias("t"))
    lines = content.select(F.posexplode(F.split("t", "\r?\n")).alias("pos", "line")).where("pos > 0 and line <> ''")
    df = lines.select(F.from_csv("line", "err string, fix string").alias("r")).select("r.*")
    strip = lambda c: F.regexp_replace(F.trim(c), "^[\"']|[\"']$", "")
    return df.select(strip("err").alias("err"), F.coalesce(strip("fix"), F.lit("")).alias("fix")).where("err <> ''").orderBy(F.length("err").desc(), "err")


def deep_get(config: Column, *keys: str) -> Column:
    """A nested JSON value by key path; null where a key is missing."""
    return F.get_json_object(config, "$" + "".join(f"['{k}']" for k in keys))
