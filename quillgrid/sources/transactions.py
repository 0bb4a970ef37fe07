"""Tables of Parquet files with commits: rows of several tables appear together, once, with dense keys, or not at all.

    tables = Tables(spark, folder)
    with tables.transaction("run-7") as t:
        heads = t.insert("head", rows, key="pk", order=["doc_id"])
        t.insert("line", ...)

Tasks write files that no reader looks at. When all tasks are done, the writer notes the files and their rows; the commit names the files of all tables of the
transaction in one new log file, which appears whole or not at all. A transaction that is already in the log isn't written again, so a batch that
is run twice is there once. Whatever fails before the commit is deleted. Readers take the files that the log names.

One process commits at a time to a folder; a second one that takes the same number finds the name gone and is an error.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from quillgrid.sources.page_source import place

#: Rows of a staged file's row group.
GROUP_ROWS = 100_000


@dataclass
class Staged(WriterCommitMessage):
    """A task's file and its rows; the part tells the order of files."""

    part: int
    file: str
    rows: int


class StagingWriter(DataSourceArrowWriter):
    """Writes each task's rows to a file of its own; the files of tasks that ended are noted in one file, those of a failed job are deleted."""

    def __init__(self, options):
        self.folder = options["folder"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        task = TaskContext.get()
        system, root = place(self.folder)
        system.create_dir(root, recursive=True)
        # a second attempt has a file of its own
        name = f"part-{task.partitionId():06d}-{uuid.uuid4().hex}.parquet"
        rows, writer = 0, None
        try:
            for batch in iterator:
                if writer is None:
                    writer = pq.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=system)
                writer.write_batch(batch, row_group_size=GROUP_ROWS)
                rows += batch.num_rows
        except BaseException:
            if writer is not None:
                writer.close()
                system.delete_file(f"{root}/{name}")
            raise
        if writer is not None:
            writer.close()
        return Staged(task.partitionId(), name if rows else "", rows)

    def commit(self, messages) -> None:
        system, root = place(self.folder)
        system.create_dir(root, recursive=True)
        done = sorted((m.part, m.file, m.rows) for m in messages if m is not None and m.rows)
        named = {f for _, f, _ in done}
        for f in system.get_file_info(fs.FileSelector(root)):
            if f.base_name.endswith(".parquet") and f.base_name not in named:
                system.delete_file(f.path)  # of an attempt that lost
        with system.open_output_stream(f"{root}/.staged") as stream:
            stream.write(json.dumps([[f, n] for _, f, n in done]).encode())
        system.move(f"{root}/.staged", f"{root}/staged.json")

    def abort(self, messages) -> None:
        system, root = place(self.folder)
        if system.get_file_info(root).type != fs.FileType.NotFound:
            system.delete_dir(root)


class Staging(DataSource):
    @classmethod
    def name(cls) -> str:
        return "staging"

    def writer(self, schema, overwrite) -> StagingWriter:
        return StagingWriter(self.options)


@dataclass
class Transaction:
    tables: Tables
    name: str
    staged: dict[str, dict] = field(default_factory=dict)
    done: bool = False

    def insert(self, table: str, rows: DataFrame, key: str | None = None, order: Sequence[str] = ()) -> None:
        """Rows for a table. With a key, dense new keys after the highest committed one are given, in `order`."""
        if self.done:
            return
        if table in self.staged:
            raise ValueError(f"{table} has its rows in this transaction already")
        if order:
            rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        folder = self.tables.folder(table, self.name)
        rows.sparkSession.dataSource.register(Staging)  # a stream has a session of its own
        rows.write.format("staging").option("folder", folder).mode("append").save()
        system, root = place(folder)
        with system.open_input_file(f"{root}/staged.json") as stream:
            self.staged[table] = {"key": key, "schema": rows.schema.json(), "files": json.loads(stream.read())}


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def folder(self, table: str, transaction: str) -> str:
        """Where a transaction's files of a table lie; names are made safe for a path."""
        return f"{self.root}/data/{_safe(table)}/{_safe(transaction)}"

    def log(self) -> list[dict]:
        """All commits, in order."""
        system, root = place(f"{self.root}/log")
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        out = []
        for f in sorted(found, key=lambda f: f.path):
            if f.base_name.endswith(".json"):
                with system.open_input_file(f.path) as stream:
                    out.append(json.loads(stream.read()))
        return out

    @contextmanager
    def transaction(self, name: str):
        """Commits at the end; an error deletes what was staged. A transaction that is in the log already does nothing."""
        t = Transaction(self, name, done=any(c["name"] == name for c in self.log()))
        if not t.done:
            self.clean(name)  # what a crashed run of it left
        try:
            yield t
            if not t.done:
                self._commit(t)
        except BaseException:
            if not t.done:
                self.clean(name)
            raise

    def clean(self, name: str) -> None:
        """Deletes the files of a transaction that isn't committed."""
        system, root = place(f"{self.root}/data")
        for table in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            mine = f"{table.path}/{_safe(name)}"
            if system.get_file_info(mine).type == fs.FileType.Directory:
                system.delete_dir(mine)

    def _commit(self, t: Transaction) -> None:
        commits = self.log()
        entry = {"name": t.name, "tables": {}}
        for table, s in t.staged.items():
            before = [c["tables"][table] for c in commits if table in c["tables"]]
            base, files = max((b["last"] for b in before), default=0), []
            for file, rows in s["files"]:
                files.append([file, base, rows])
                base += rows
            entry["tables"][table] = {"key": s["key"], "schema": s["schema"], "files": files, "last": base}
        system, root = place(f"{self.root}/log")
        system.create_dir(root, recursive=True)
        final = f"{root}/{len(commits):012d}.json"
        if system.get_file_info(final).type != fs.FileType.NotFound:
            raise RuntimeError("another process committed meanwhile")
        hidden = f"{root}/.{uuid.uuid4().hex}"
        with system.open_output_stream(hidden) as stream:
            stream.write(json.dumps(entry).encode())
        system.move(hidden, final)
        t.done = True

    def read(self, table: str, transaction: str | None = None) -> DataFrame | None:
        """The committed rows of a table, or those of one transaction; None where there are none. The key is a file's first key and a row's place in the file."""
        frames: dict[tuple, list] = {}
        for c in self.log():
            t = c["tables"].get(table)
            if t and t["files"] and transaction in (None, c["name"]):
                frames.setdefault((t["schema"], t["key"]), []).extend((f"{self.folder(table, c['name'])}/{f}", base) for f, base, _ in t["files"])
        out = None
        for (schema, key), files in frames.items():
            df = self.spark.read.schema(_schema(schema)).parquet(*(f for f, _ in files))
            if key:
                bases = self.spark.createDataFrame([(f.rsplit("/", 1)[1], b) for f, b in files], "_file string, _base bigint")  # one row per file
                df = df.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at")).join(bases, "_file")
                df = df.withColumn(key, F.col("_base") + F.col("_at") + 1).drop("_file", "_at", "_base")
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        return out


def _safe(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9_.-]", lambda m: f"%{ord(m.group()):06x}", name)


def _schema(text: str):
    from pyspark.sql.types import StructType

    return StructType.fromJson(json.loads(text))


def insert_documents(tables: Tables, transaction: str, plan: Mapping[str, tuple[DataFrame, str | None]], doc: str = "doc_id") -> DataFrame:
    """Inserts the rows of load.insert_plan() (all tables or none) and the list of what was inserted; gives that list: doc, table_name, pk.

    Keys follow the highest committed ones. Rows that can't be inserted (several roots, no parent) go to the table `_rejected` of the same transaction.
    """
    from quillgrid.operators.load import insert_plan
    from quillgrid.operators.relational import settle

    last = {name: 0 for name in plan}
    for c in tables.log():
        for name, t in c["tables"].items():
            if name in last:
                last[name] += sum(n for _, _, n in t["files"])
    done, kept, failed = insert_plan(plan, last)
    with tables.transaction(transaction) as t:
        if not t.done:
            for name, rows in done.items():
                t.insert(name, settle(rows))
            t.insert("_complete_map", kept.select(doc, "table_name", "pk"))
            t.insert("_rejected", failed)
    return tables.read("_complete_map", transaction)
