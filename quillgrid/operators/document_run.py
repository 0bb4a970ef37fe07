"""A document's run from page images to the rows of its tables.

Each page is taken through its sections in one pass over its pixels: crop, cut into blocks, recognise the leaves. From then on only texts and places move: grid,
cleansing, template, records (assembly.structure), sections merged on the page, pages merged in the document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgrid.functions import imaging as I
from quillgrid.functions.params import typed
from quillgrid.operators import assembly, blocks, relational

#: From the images of a section's leaves to (text, confidence) of each.
Recognise = Callable[[Sequence[np.ndarray]], Sequence[tuple[str, float]]]
LEAVES = "section string, block_id string, x int, y int, w int, h int, text string, confidence double"
#: Pixels of the pages that one task looks at before it hands on what it read.
PIXELS_AT_ONCE = 64 << 20


@dataclass(frozen=True)
class Section:
    """area: parameters of imaging.area_box(); prepare, separate: steps of imaging.STEPS and blocks.STEPS by name."""

    name: str
    area: dict = field(default_factory=dict)
    prepare: Sequence[tuple[str, dict]] = ()
    separate: Sequence[tuple[str, dict]] = ()


def section_leaves(img: np.ndarray, section: Section, recognise: Recognise) -> list[tuple]:
    """Rows of LEAVES of one section of a page; x and y are the page's."""
    x0, y0, x1, y1 = I.area_box(img.shape, **typed(I.area_box, section.area))
    part = img[y0:y1, x0:x1]
    for name, params in section.prepare:
        part = I.step(part, name, params, {})
    made = blocks.cut(blocks.Block(section.name, (x0, y0, part.shape[1], part.shape[0]), part), section.separate)
    leaves = [b for b in made if b.child == 0]
    return [(section.name, b.name, *map(int, b.box), text, float(sure)) for b, (text, sure) in zip(leaves, recognise([b.img for b in leaves]), strict=True)]


def leaves(pages: DataFrame, sections: Sequence[Section], recognise: Recognise, keep: Sequence[str] = ("doc_id", "page_num")) -> DataFrame:
    """keep and LEAVES for each page row (columns of imaging.IMAGE). Unknown steps are an error before anything runs; a page without pixels has no leaves."""
    for s in sections:
        unknown = [n for n, _ in s.prepare if n not in I.STEPS and n not in I.MEASURING] + [n for n, _ in s.separate if n not in blocks.STEPS]
        if unknown:
            raise ValueError(f"section {s.name} has unknown steps: {', '.join(unknown)}")
    names = [c.split()[0] for c in LEAVES.split(", ")]
    schema = ", ".join([*(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keep), LEAVES])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, pixels = [], 0
        for b in batches:
            for row in zip(*(b[k] for k in keep), b["height"], b["width"], b["channels"], b["data"]):
                if row[-1] is None or not len(row[-1]):
                    continue
                img = I.to_array(*row[len(keep) :])
                for s in sections:
                    out += [(*row[: len(keep)], *leaf) for leaf in section_leaves(img, s, recognise)]
                pixels += img.size
                if pixels >= PIXELS_AT_ONCE:
                    yield pd.DataFrame(out, columns=[*keep, *names])
                    out, pixels = [], 0
        yield pd.DataFrame(out, columns=[*keep, *names])

    return pages.select(*keep, "height", "width", "channels", "data").mapInPandas(run, schema)


def merge_pages(records: DataFrame) -> DataFrame:
    """doc_id, table_name, id, column_name, text of a document's tables, from doc_id, page_num, table_name, id, column_name, text of its pages.

    Pages come by number. Rows of a page that bring other columns, as many as there are, complete the rows so far; else they are appended, and id counts on.
    """
    row = F.map_from_entries(F.collect_list(F.struct("column_name", "text")))
    rows = records.groupBy("doc_id", "page_num", "table_name", "id").agg(row.alias("_m"))
    pages = rows.groupBy("doc_id", "page_num", "table_name").agg(F.transform(F.array_sort(F.collect_list(F.struct("id", F.to_json("_m").alias("j")))), lambda r: F.from_json(r["j"], "map<string,string>")).alias("rows"))
    merged = relational.page_merge(pages, ["doc_id", "table_name"], "page_num", "rows")
    placed = merged.select("doc_id", "table_name", F.posexplode("rows").alias("_p", "_m"))
    return placed.select("doc_id", "table_name", (F.col("_p") + 1).alias("id"), F.explode("_m").alias("column_name", "text"))


def run(
    pages: DataFrame, sections: Sequence[Section], template: DataFrame, recognise: Recognise, common: Column, block_fixes: DataFrame | None = None, gap: float | None = None
) -> DataFrame:
    """doc_id, page_num, kind, table_name, id, column_name, text of documents, from page rows (doc_id, page_num and the columns of imaging.IMAGE).

    kind `record`: a value of a table of the document (page_num null, id its row). Else what doesn't fit, by page: `mismatch`, `missing`, `length`, with id the
    template's row (or the record), and name `unmatched1`, `unmatched2` ... over the document's pages in column_name's place. A page without a block of a section has no
    rows of it.
    """
    read = leaves(pages, sections, recognise)
    words = read.select(F.struct("doc_id", "page_num").alias("doc_id"), "section", "block_id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "text")
    order = {s.name: i for i, s in enumerate(sections)}
    found = assembly.structure(words, template, common, block_fixes, gap, order).select("doc_id.*", "section", "kind", "table_name", "id", "col", "column_name", "text")
    found = relational.settle(found)  # texts only, once, for the tables and for the errors
    records = merge_pages(found.where("kind = 'record'"))
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("page_num", "section", "id", "col", "column_name"))
    odd = found.where("kind <> 'record'").withColumn("column_name", F.concat(F.lit("unmatched"), number.cast("string")))
    records = records.select("doc_id", F.lit(None).cast("int").alias("page_num"), F.lit("record").alias("kind"), "table_name", "id", "column_name", "text")
    return records.unionByName(odd.select("doc_id", F.col("page_num").cast("int").alias("page_num"), "kind", "table_name", "id", "column_name", "text"))

