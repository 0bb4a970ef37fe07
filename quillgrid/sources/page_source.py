"""Pages of the files in a folder tree, as a batch and as a streaming source.

    spark.dataSource.register(PageSource)
    spark.read.format("pages").option("path", folder).option("render", "package.module:function").load()
    spark.readStream.format("pages").option("path", folder).option("log", shared_folder).load()

A PDF (or another `suffix`) gives one row per page through `render` (bytes -> page images); any other file is one page without a layout. Files are dealt to partitions by their
bytes and opened by the tasks. The stream keeps a log of the files that it has listed, in the order in which it met them; its offset is a place in that log.
So a file that arrives late with an old time is read, none is read twice, and a restarted query plans the batch it had begun with the same files.
"""

from __future__ import annotations

import datetime
import hashlib
import importlib
import json
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

PAGES = "file_id string, layout_id string, page_num int, path string, modified timestamp, length bigint, image binary, error string"
_ARROW = pa.schema(
    [
        ("file_id", pa.string()), ("layout_id", pa.string()), ("page_num", pa.int32()), ("path", pa.string()), ("modified", pa.timestamp("us", tz="UTC")), ("length", pa.int64()),
        ("image", pa.binary()), ("error", pa.string()),
    ]
)
#: Bytes of files in a partition (one file at least), and of page images in a batch (one page at least).
PARTITION_BYTES = 64 << 20
BATCH_BYTES = 16 << 20


@dataclass(frozen=True)
class Found:
    """A file as it was when it was listed; modified in microseconds."""

    path: str
    modified: int
    length: int


@dataclass
class Files(InputPartition):
    files: Sequence[Found]


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def listed(path: str, recursive: bool = True, pattern: str | None = None, newest: int | None = None) -> list[Found]:
    """The files under path by name; those that begin with `.` or `_` (being written) and those changed after `newest` are left for later."""
    system, root = place(path)
    found = system.get_file_info(fs.FileSelector(root, recursive=recursive, allow_not_found=True))
    out = []
    for f in found:
        if f.type != fs.FileType.File or f.base_name[:1] in "._" or (pattern and not re.search(pattern, f.path.lower())):
            continue
        changed = (f.mtime_ns or 0) // 1000
        if newest is None or changed <= newest:
            out.append(Found(f.path, changed, f.size))
    return sorted(out, key=lambda f: f.path)


def dealt(files: Sequence[Found], size: int = PARTITION_BYTES) -> list[Files]:
    """Files in partitions of at most `size` bytes, one file at least, largest first into the first that has room."""
    bins: list[list[Found]] = []
    room: list[int] = []
    open_from = 0
    for f in sorted(files, key=lambda f: (-f.length, f.path)):
        at = next((i for i in range(open_from, len(bins)) if room[i] >= f.length), None)
        if at is None:
            bins.append([])
            room.append(size)
            at = len(bins) - 1
        bins[at].append(f)
        room[at] -= f.length
        while open_from < len(bins) and (room[open_from] <= 0 or len(bins) - open_from > 100):
            open_from += 1  # full ones, and old ones with little room, are closed
    return [Files(b) for b in bins]


def file_id(path: str) -> str:
    """A digest of the path, the same in every run."""
    return hashlib.sha256(path.encode()).hexdigest()


def renderer(name: str | None) -> Callable[[bytes], Sequence[bytes]] | None:
    """The function that `module:function` names."""
    if not name:
        return None
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def text_pages(content: bytes) -> list[bytes]:
    """A renderer for plain text: pages end at form feeds."""
    return content.split(b"\f")


def page_rows(system: fs.FileSystem, f: Found, render: Callable[[bytes], Sequence[bytes]] | None, permissive: bool, suffix: str = ".pdf") -> Iterator[dict]:
    """One row per page. A file that can't be read or rendered raises, or (permissive) is one row with an error and no image."""
    row = {"file_id": file_id(f.path), "layout_id": None, "page_num": 1, "path": f.path, "length": f.length, "image": None, "error": None}
    row["modified"] = datetime.datetime.fromtimestamp(f.modified / 1e6, datetime.timezone.utc)
    try:
        with system.open_input_file(f.path) as stream:
            content = stream.read()
        if render is None or not f.path.lower().endswith(suffix):
            pages = [{**row, "image": content}]
        else:
            pages = ({**row, "layout_id": f"{row['file_id']}_{n}", "page_num": n, "image": image} for n, image in enumerate(render(content), 1))
        yield from pages
    except Exception as e:
        if not permissive:
            raise
        yield {**row, "error": f"{type(e).__name__}: {e}"}


class _Reading:
    """What batch and stream have in common."""

    def __init__(self, options):
        self.path = options["path"]
        self.recursive = options.get("recursive", "true").lower() == "true"
        self.pattern = options.get("pattern")
        self.size = int(options.get("partitionbytes", PARTITION_BYTES))
        self.render, self.suffix = options.get("render"), options.get("suffix", ".pdf")
        self.permissive = options.get("mode", "failfast").lower() == "permissive"

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = place(self.path)
        render, rows, size = renderer(self.render), [], 0
        for f in partition.files:
            for row in page_rows(system, f, render, self.permissive, self.suffix):
                rows.append(row)
                size += len(row["image"] or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


class PageReader(_Reading, DataSourceReader):
    def partitions(self) -> Sequence[InputPartition]:
        return dealt(listed(self.path, self.recursive, self.pattern), self.size) or [Files([])]


class PageStream(_Reading, DataSourceStreamReader):
    """Offsets are places in the log of listed files; each log file holds the files that one listing found new."""

    def __init__(self, options):
        super().__init__(options)
        self.log = options["log"]
        self.most = int(options.get("maxfilespertrigger", 0))
        self.min_age = int(float(options.get("minageseconds", 0)) * 1e6)
        self.entries: list[Found] = []
        self.given = 0
        system, root = place(self.log)
        system.create_dir(root, recursive=True)
        for name in sorted(f.path for f in system.get_file_info(fs.FileSelector(root)) if f.path.endswith(".json")):
            with system.open_input_file(name) as stream:
                self.entries += [Found(*e) for e in json.loads(stream.read())]
        self.known = {f.path for f in self.entries}

    def initialOffset(self) -> dict:
        return {"files": 0}

    def latestOffset(self) -> dict:
        newest = int(datetime.datetime.now().timestamp() * 1e6) - self.min_age if self.min_age else None
        new = sorted((f for f in listed(self.path, self.recursive, self.pattern, newest) if f.path not in self.known), key=lambda f: (f.modified, f.path))
        if new:
            system, root = place(self.log)
            hidden = f"{root}/.{uuid.uuid4().hex}"
            with system.open_output_stream(hidden) as stream:
                stream.write(json.dumps([[f.path, f.modified, f.length] for f in new]).encode())
            system.move(hidden, f"{root}/{len(self.entries):012d}.json")  # the log file appears whole
            self.entries += new
            self.known |= {f.path for f in new}
        self.given = min(len(self.entries), self.given + self.most) if self.most else len(self.entries)
        return {"files": self.given}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.given = max(self.given, end["files"])
        return dealt(self.entries[start["files"] : end["files"]], self.size)

    def commit(self, end: dict) -> None:
        """The log stays: it is what tells known files from new ones."""


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return PAGES

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)

    def streamReader(self, schema) -> PageStream:
        return PageStream(self.options)


def write_files(files: DataFrame, folder: str) -> None:
    """Writes each row's content (binary) to folder/name. A file appears whole; a task that is run again writes the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place(folder)
        n = 0
        for batch in batches:
            for name, content in zip(batch["name"].to_pylist(), batch["content"].to_pylist()):
                path = f"{root}/{name}"
                parent, _, base = path.rpartition("/")
                system.create_dir(parent, recursive=True)
                hidden = f"{parent}/.{uuid.uuid4().hex}"
                with system.open_output_stream(hidden) as stream:
                    stream.write(content)
                system.move(hidden, path)
                n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]})

    files.select("name", "content").mapInArrow(run, "n bigint").agg(F.sum("n")).collect()


def targets(pages: DataFrame, run_id: Column) -> DataFrame:
    """run_id, target_id and content (JSON) of each page: what a run has to work on. The target of a page of a document is its layout, else its file."""
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    page = F.concat(name, F.lit("_page_"), F.col("page_num").cast("string"), F.lit(".png"))
    paths = F.when(F.col("layout_id").isNull(), F.struct(F.col("path").alias("_origin"), F.lit(None).cast("string").alias("_origindoc")))
    paths = paths.otherwise(F.struct(page.alias("_origin"), F.col("path").alias("_origindoc")))
    content = F.to_json(F.struct("file_id", "layout_id", "page_num", paths.alias("file_path")))
    return pages.where("error IS NULL").select(run_id.alias("run_id"), F.coalesce("layout_id", "file_id").alias("target_id"), content.alias("content"))
