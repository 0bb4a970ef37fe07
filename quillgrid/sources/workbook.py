"""Workbooks (OOXML) of a document's tables: one file per document, one sheet per table, written and read as streams of rows.

cells: doc_id, table_name, row (from 1), column_name, value. The first line of a sheet is the sorted union of its rows' columns.
"""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgrid.sources.page_source import place

#: Limits of the format. Fixed values.
NAME_LENGTH, SHEET_ROWS = 31, 1_048_576
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
#: Characters that XML can't hold; they are written as _xHHHH_, as the format has it.
_ODD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]|_(?=x[0-9A-Fa-f]{4}_)|\r")
CELLS = "doc_id string, table_name string, row int, column_name string, value string"


def column_letters(n: int) -> str:
    """A, B ... Z, AA ... for 0, 1 ..."""
    out = ""
    n += 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def sheet_name(table: str, taken: set[str]) -> str:
    """At most NAME_LENGTH characters, none that sheets can't have, and not one that is taken (in any case)."""
    base = re.sub(r"[\[\]:*?/\\]", "_", table).strip("'")[:NAME_LENGTH] or "_"
    name, n = base, 1
    while name.lower() in taken:
        n += 1
        name = f"{base[: NAME_LENGTH - len(str(n)) - 1]}~{n}"
    taken.add(name.lower())
    return name


def _cell(place: str, value: str) -> str:
    text = escape(_ODD.sub(lambda m: f"_x{ord(m.group()):04X}_", value))
    return f'<c r="{place}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


class Workbook:
    """A file that sheets are added to, row by row. Nothing is kept but names."""

    def __init__(self, stream):
        self.zip = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED)
        self.names: list[str] = []
        self.taken: set[str] = set()
        self.sheet, self.line, self.table, self.header = None, 0, None, ()

    def begin(self, table: str, header: Sequence[str]) -> None:
        self.end()
        self.table, self.header = table, tuple(header)
        self.names.append(sheet_name(table, self.taken))
        self.sheet = self.zip.open(f"xl/worksheets/sheet{len(self.names)}.xml", "w", force_zip64=True)
        self.sheet.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
        self.line = 0
        self.write(dict(zip(header, header)))

    def write(self, row: Mapping[str, str | None]) -> None:
        """A row's values by column; missing ones are empty."""
        if self.line == SHEET_ROWS:
            self.begin(self.table, self.header)
        self.line += 1
        cells = (_cell(f"{column_letters(i)}{self.line}", row[c]) for i, c in enumerate(self.header) if row.get(c) is not None)
        self.sheet.write(f'<row r="{self.line}">{"".join(cells)}</row>'.encode())

    def end(self) -> None:
        if self.sheet is not None:
            self.sheet.write(b"</sheetData></worksheet>")
            self.sheet.close()
            self.sheet = None

    def close(self) -> None:
        self.end()
        n = range(1, len(self.names) + 1)
        sheets = "".join(f'<sheet name="{escape(name, {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, name in zip(n, self.names))
        rels = "".join(f'<Relationship Id="rId{i}" Type="{_REL}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in n)
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        types = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in n)
        parts = {
            "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>{sheets}</sheets></workbook>',
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}/relationships">{rels}</Relationships>',
            "_rels/.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
            "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{types}</Types>',
        }
        for name, body in parts.items():
            self.zip.writestr(name, _HEAD + body)
        self.zip.close()


def write_workbooks(cells: DataFrame, folder: str) -> int:
    """Writes folder/doc_id.xlsx for every document; gives their number. A document without cells has no file. A file appears whole, and a task that is run
    again writes the same. Ids that can't be names have those characters as % and six hexadecimal digits."""
    header = cells.select("doc_id", "table_name", F.lit(0).alias("row"), "column_name", F.lit(None).cast("string").alias("value")).distinct()
    every = cells.select("doc_id", "table_name", "row", "column_name", "value").unionByName(header).select(F.col("doc_id").cast("string"), "table_name", F.col("row").cast("int"), "column_name", "value")
    rows = every.groupBy("doc_id", "table_name", "row").agg(F.array_sort(F.collect_list(F.struct("column_name", "value"))).alias("cells"))
    rows = rows.repartition("doc_id").sortWithinPartitions("doc_id", "table_name", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place(folder)
        system.create_dir(root, recursive=True)
        book, doc, stream, hidden, n = None, None, None, None, 0

        def finish() -> None:
            if book is not None:
                book.close()
                stream.close()
                system.move(hidden, f"{root}/{re.sub('[^A-Za-z0-9_.-]', lambda m: f'%{ord(m.group()):06x}', doc)}.xlsx")

        for batch in batches:
            for r in batch.to_pylist():
                if book is None or r["doc_id"] != doc:
                    finish()
                    doc, hidden, n = r["doc_id"], f"{root}/.{uuid.uuid4().hex}", n + 1
                    stream = system.open_output_stream(hidden)
                    book = Workbook(stream)
                if r["row"] == 0:
                    book.begin(r["table_name"], [c["column_name"] for c in r["cells"]])
                else:
                    book.write({c["column_name"]: c["value"] for c in r["cells"]})
        finish()
        yield pa.RecordBatch.from_pydict({"n": [n]})

    return rows.where("doc_id IS NOT NULL AND table_name IS NOT NULL").mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0] or 0


def sheet_rows(content: bytes) -> Iterator[tuple[str, int, str, str]]:
    """(sheet, row from 1, column, value) of a workbook whose first lines are headers, one sheet after the other."""
    tag = lambda name: f"{{{_MAIN}}}{name}"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = [s.get("name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(tag("sheet"))]
        for n, sheet in enumerate(names, 1):
            header: dict[str, str] = {}
            with z.open(f"xl/worksheets/sheet{n}.xml") as stream:
                for _, row in ElementTree.iterparse(stream):
                    if row.tag != tag("row"):
                        continue
                    line = int(row.get("r"))
                    for c in row.iter(tag("c")):
                        text = re.sub("_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m.group(1), 16)), "".join(t.text or "" for t in c.iter(tag("t"))))
                        column = re.match("[A-Z]+", c.get("r")).group()
                        if line == 1:
                            header[column] = text
                        else:
                            yield sheet, line - 1, header[column], text
                    row.clear()


def read_workbooks(spark: SparkSession, folder: str) -> DataFrame:
    """CELLS of the workbooks in a folder; table_name is the sheet's name, doc_id the file's. Each file is read by one task, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist()):
                doc = re.sub("%([0-9a-f]{6})", lambda m: chr(int(m.group(1), 16)), path.rsplit("/", 1)[1].removesuffix(".xlsx"))
                some = []
                for row in sheet_rows(content):
                    some.append((doc, *row))
                    if len(some) == 10_000:
                        yield _batch(some)
                        some = []
                yield _batch(some)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(folder)
    return files.select("path", "content").mapInArrow(run, CELLS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.string()]
    names = ["doc_id", "table_name", "row", "column_name", "value"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)


def read_back(complete_map: DataFrame, catalogue: DataFrame, stored: Mapping[str, DataFrame]) -> DataFrame:
    """The stored rows of documents as cells, through the list of what was inserted.

    complete_map: doc_id, table_id, pk_value. catalogue: table_id, table_name, column_name, is_pk. One keyed join per table that the list names (a catalogue has tens of
    tables), then a union of cells, since the tables have different columns. Rows are numbered by key. A table that isn't stored, or has no key column,
    is an error; keys without a row are left out. Nulls are cells without a value.
    """
    named = complete_map.select("table_id").distinct().join(catalogue, "table_id").where("is_pk = 'Y'").select("table_id", "table_name", "column_name").distinct()
    plan = named.collect()  # one row per table
    missing = sorted({r["table_name"] for r in plan} - set(stored))
    if missing:
        raise ValueError(f"tables that aren't stored: {', '.join(missing)}")
    parts = []
    for r in sorted(plan, key=lambda r: r["table_name"]):
        names = stored[r["table_name"]].columns
        rows = stored[r["table_name"]].select(*(F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(names)))
        pk = f"_c{names.index(r['column_name'])}"
        keys = complete_map.where(F.col("table_id") == r["table_id"]).select(F.col("doc_id").cast("string").alias("_doc"), F.col("pk_value").cast("string").alias("_pk")).distinct()
        joined = keys.join(rows, F.col(pk).cast("string") == F.col("_pk")).withColumn("_row", F.row_number().over(Window.partitionBy("_doc").orderBy(pk)))
        cell = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"_c{i}").cast("string").alias("value")) for i, c in enumerate(names))))
        parts.append(joined.select(F.col("_doc").alias("doc_id"), F.lit(r["table_name"]).alias("table_name"), F.col("_row").alias("row"), cell.alias("c")).select("doc_id", "table_name", "row", "c.*"))
    if not parts:
        return complete_map.sparkSession.createDataFrame([], CELLS)
    return reduce(DataFrame.unionByName, parts)

