"""Documents that are done, or that failed, under folders of their day: the original moved, its pages copied, a JSON file beside it, and a row in the table of completed documents.

Files come first, under names that a second run writes again alike; then the rows, in one transaction; only then the originals go from where they were. So a run that stops
anywhere can be run again: nothing is lost, and no document is listed twice.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.sources.page_source import place, write_files
from quillgrid.sources.transactions import Tables

#: The class of a document that has none. Fixed value.
NO_CLASS = "0"


def _each_file(rows: DataFrame, columns: list[str], work) -> None:
    """Runs work(row) for every row, in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            for row in batch.to_pylist():
                work(row)
                n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]})

    rows.select(*columns).mapInArrow(run, "n bigint").agg(F.sum("n")).collect()


def _copy(row: dict) -> None:
    """The original to its new place, and the JSON file beside it; each appears whole. An original that has gone already was copied by an earlier run."""
    system, source = place(row["origin"])
    other, target = place(row["target"])
    other.create_dir(target.rpartition("/")[0], recursive=True)
    if system.get_file_info(source).type == fs.FileType.File:
        hidden = f"{target.rpartition('/')[0]}/.{target.rpartition('/')[2]}"
        with system.open_input_stream(source) as a, other.open_output_stream(hidden) as b:
            while part := a.read(1 << 20):
                b.write(part)
        other.move(hidden, target)
    elif other.get_file_info(target).type != fs.FileType.File:
        raise FileNotFoundError(row["origin"])
    with other.open_output_stream(row["sidecar"]) as stream:
        stream.write(row["content"].encode())


def _remove(row: dict) -> None:
    system, source = place(row["origin"])
    if system.get_file_info(source).type == fs.FileType.File:
        system.delete_file(source)


def placed(docs: DataFrame, folder: str, day: datetime.date, failed: bool = False) -> DataFrame:
    """docs (doc_id, doc_class_id, origin) with folder, target and sidecar: folder/yyyy/mm/dd/<class>_<id>, or of a failed one folder/yyyy/mm/dd/<id>."""
    name = F.col("doc_id").cast("string") if failed else F.concat_ws("_", F.coalesce(F.col("doc_class_id").cast("string"), F.lit(NO_CLASS)), F.col("doc_id").cast("string"))
    docs = docs.withColumn("folder", F.concat(F.lit(f"{folder.rstrip('/')}/{day:%Y/%m/%d}/"), name))
    docs = docs.withColumn("target", F.concat_ws("/", "folder", F.element_at(F.split("origin", "/"), -1)))
    return docs.withColumn("sidecar", F.concat(F.regexp_replace("target", r"\.[^./]*$", ""), F.lit(".json")))


def complete(tables: Tables, docs: DataFrame, pages: DataFrame, folder: str, day: datetime.date, run_id: str) -> DataFrame:
    """Files the documents of a run away and gives their rows: complete_id, run_id, doc_id, content (JSON), use_yn.

    docs: doc_id, doc_class_id, origin (path), info (JSON of what is known). pages: doc_id, page_num, image. content has the new paths of the original and of each page, `_page<n>_normalized.png` in
    the document's folder. Documents without pages have none in their list. Run again with the same run_id it changes nothing.
    """
    rows = placed(docs, folder, day)
    images = pages.join(rows.select("doc_id", "folder"), "doc_id")
    file = F.concat(F.lit("_page"), F.col("page_num").cast("string"), F.lit("_normalized.png"))
    write_files(images.select(F.concat_ws("/", F.expr(f"substring(folder, {len(folder.rstrip('/')) + 2})"), file).alias("name"), F.col("image").alias("content")), folder)
    listed = images.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_num", F.struct(F.concat_ws("/", "folder", file).alias("_normalize")).alias("file_path")))).alias("page_infos"))
    rows = rows.join(listed, "doc_id", "left")
    content = F.to_json(F.struct(F.col("doc_id").cast("string").alias("file_id"), "doc_class_id", F.struct(F.col("target").alias("_originfile")).alias("doc_path"), F.coalesce("page_infos", F.array()).alias("page_infos"), "info"))
    rows = rows.withColumn("content", content)
    _each_file(rows, ["origin", "target", "sidecar", "content"], _copy)
    with tables.transaction(f"complete {run_id}") as t:
        if not t.done:
            t.insert("complete", rows.select(F.lit(run_id).alias("run_id"), "doc_id", "content", F.lit("Y").alias("use_yn")), key="complete_id", order=["doc_id"])
    _each_file(rows, ["origin"], _remove)
    return tables.read("complete", f"complete {run_id}")


def fail(docs: DataFrame, folder: str, day: datetime.date) -> None:
    """Files failed documents away: the original moved, and `info` beside it with its new path; no pages, no row."""
    rows = placed(docs, folder, day, failed=True)
    content = F.to_json(F.struct(F.col("doc_id").cast("string").alias("file_id"), "doc_class_id", F.struct(F.col("target").alias("_originfile")).alias("doc_path"), "info"))
    rows = rows.withColumn("content", content)
    _each_file(rows, ["origin", "target", "sidecar", "content"], _copy)
    _each_file(rows, ["origin"], _remove)
