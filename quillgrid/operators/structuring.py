"""From positioned blocks to records: template match, key check, record numbers, document assembly.

The blocks of a section of a document meet once, by (document, section); what follows keeps that partitioning, so a document is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgrid.functions.text import same_key

#: Section kinds. Fixed values.
STATIC, ONE_ROW, MULTI_ROW = "STATIC_TEXT", "ONE_ROW", "MULTI_ROW"
_CELL = ("row", "col", "cell_type", "table_name", "column_name", "default_text")


def match_template(blocks: DataFrame, template: DataFrame) -> DataFrame:
    """Template cells (section, kind, row, col, cell_type key/val, table_name, column_name, default_text) with the block (doc_id, section, row, col, text) at
    their place. In sections of repeated rows the value cells come again, shifted by the height of the value rows, until they reach as many rows as the
    section has blocks in; key cells stay. A cell without a block has null text; found tells whether there is a block. Of several blocks at one place the one
    with the greatest text counts."""
    one = blocks.repartition("doc_id", "section").groupBy("doc_id", "section", "row", "col").agg(F.max("text").alias("text"))
    place = lambda row, col: F.concat_ws(":", row.cast("string"), col.cast("string"))
    entry = F.struct(place(F.col("row"), F.col("col")).alias("k"), F.struct("text", F.lit(True).alias("found")).alias("v"))
    pages = one.groupBy("doc_id", "section").agg(F.map_from_entries(F.collect_list(entry)).alias("_at"), F.size(F.collect_set("row")).alias("_rows"))
    val = F.when(F.col("cell_type") == "val", F.col("row"))
    sizes = [F.max("kind").alias("kind"), F.max("row").alias("_last"), (F.max(val) - F.min(val) + 1).alias("_step"), F.sort_array(F.collect_list(F.struct(*_CELL))).alias("_cells")]
    # the template is one document class: hundreds of cells, one row per section
    pages = pages.join(F.broadcast(template.groupBy("section").agg(*sizes)), "section")
    cells = pages.withColumn("_c", F.explode("_cells")).select("doc_id", "section", "kind", "_at", "_rows", "_last", "_step", "_c.*")
    more = (F.col("kind") == MULTI_ROW) & (F.col("cell_type") == "val") & (F.col("_rows") > F.col("_last"))
    more = F.when(more, F.ceil((F.col("_rows") - F.col("_last")) / F.col("_step"))).otherwise(0).cast("int")
    cells = cells.withColumn("repeat", F.explode(F.sequence(F.lit(0), more))).withColumn("row", (F.col("row") + F.coalesce("_step", F.lit(0)) * F.col("repeat")).cast("int"))
    cells = cells.withColumn("_b", F.try_element_at("_at", place(F.col("row"), F.col("col"))))
    return cells.select("doc_id", "section", "kind", *_CELL, "repeat", F.col("_b.text").alias("text"), F.coalesce("_b.found", F.lit(False)).alias("found"))


_ROWS = "array<struct<record_no:int,column_name:string,text:string>>"


def _numbered(cells: Column) -> Column:
    """Records of one table's cells in order: a new one where a column comes that the current one has."""

    def step(acc: Column, c: Column) -> Column:
        again = F.array_contains(acc["have"], c["column_name"])
        no = acc["no"] + F.when(again, 1).otherwise(0)
        have = F.when(again, F.array(c["column_name"])).otherwise(F.concat(acc["have"], F.array(c["column_name"])))
        row = F.struct(no.alias("record_no"), c["column_name"].alias("column_name"), F.coalesce(c["text"], F.lit("")).alias("text"))
        return F.struct(no.alias("no"), have.alias("have"), F.when(c["found"], F.concat(acc["rows"], F.array(row))).otherwise(acc["rows"]).alias("rows"))

    start = F.struct(F.lit(1).alias("no"), F.array().cast("array<string>").alias("have"), F.array().cast(_ROWS).alias("rows"))
    return F.aggregate(cells, start, step)["rows"]


def _last_of_equal(cells: Column) -> Column:
    """One record: of equal columns the last with a block counts."""
    found = F.filter(cells, lambda c: c["found"])
    last = F.filter(found, lambda c, i: ~F.exists(F.slice(found, i + 2, F.size(found)), lambda d: d["column_name"] == c["column_name"]))
    return F.transform(last, lambda c: F.struct(F.lit(1).alias("record_no"), c["column_name"].alias("column_name"), F.coalesce(c["text"], F.lit("")).alias("text")))


def records(matched: DataFrame) -> DataFrame:
    """doc_id, section, table_name, record_no, column_name, text of value cells. One-row sections make one record per table (the last of equal columns wins);
    in repeated sections a record ends where a column comes that it already has. A cell without a block keeps its place, so nothing moves into another
    record; it has no row here but one in missing_blocks()."""
    values = matched.where((F.col("cell_type") == "val") & (F.col("kind") != STATIC))
    cells = F.sort_array(F.collect_list(F.struct("repeat", "row", "col", "column_name", "text", "found")))
    tables = values.groupBy("doc_id", "section", "table_name").agg(F.max("kind").alias("kind"), cells.alias("_c"))
    rows = F.when(F.col("kind") == MULTI_ROW, _numbered(F.col("_c"))).otherwise(_last_of_equal(F.col("_c")))
    return tables.select("doc_id", "section", "table_name", F.inline(rows))


def key_mismatches(matched: DataFrame) -> DataFrame:
    """Key cells whose text isn't the template's, but for spaces."""
    return matched.where((F.col("cell_type") == "key") & F.col("found") & ~_as_template()).select("doc_id", "section", "repeat", "row", "col", "text", "default_text")


def _as_template() -> Column:
    return same_key(F.coalesce("text", F.lit("")), F.coalesce("default_text", F.lit("")))


def missing_blocks(matched: DataFrame) -> DataFrame:
    """Template cells without a block: rows to report instead of stopping at the first."""
    return matched.where(~F.col("found")).select("doc_id", "section", "repeat", "row", "col", "default_text")


_OUT = "array<struct<kind:string,table_name:string,id:int,col:int,column_name:string,text:string>>"


def outcomes(matched: DataFrame) -> DataFrame:
    """doc_id, section, kind, table_name, id, col, column_name, text of everything in one pass: `record` (id: its number in the section), `mismatch` and `missing` (id, col: the place)."""
    cells = F.sort_array(F.collect_list(F.struct("repeat", "row", "col", "cell_type", "table_name", "column_name", "text", "found", "default_text")))
    pages = matched.groupBy("doc_id", "section").agg(F.max("kind").alias("kind"), cells.alias("_c"))
    values = F.filter("_c", lambda c: (c["cell_type"] == "val") & (F.col("kind") != STATIC))

    def of(table: Column) -> Column:
        mine = F.filter(values, lambda c: c["table_name"].eqNullSafe(table))
        rows = F.when(F.col("kind") == MULTI_ROW, _numbered(mine)).otherwise(_last_of_equal(mine))
        return F.transform(rows, lambda r: F.struct(F.lit("record").alias("kind"), table.alias("table_name"), r["record_no"].alias("id"), F.lit(None).cast("int").alias("col"), r["column_name"], r["text"]))

    made = F.flatten(F.transform(F.array_distinct(F.transform(values, lambda c: c["table_name"])), of)).cast(_OUT)
    none = F.lit(None).cast("string")
    fits = lambda c: same_key(F.coalesce(c["text"], F.lit("")), F.coalesce(c["default_text"], F.lit("")))
    odd = F.filter("_c", lambda c: ~c["found"] | ((c["cell_type"] == "key") & ~fits(c)))
    odd = F.transform(odd, lambda c: F.struct(F.when(c["found"], "mismatch").otherwise("missing").alias("kind"), none.alias("table_name"), c["row"].alias("id"), c["col"], none.alias("column_name"), c["text"]))
    return pages.select("doc_id", "section", F.inline(F.concat(made, odd.cast(_OUT))))


def merge_sections(rows: DataFrame, order: dict[str, int] | None = None) -> DataFrame:
    """outcomes() with the records of several sections that fill one table merged by number: columns of later sections win.

    Sections come by `order`, then by name. The first section of a table says how many records it has; records of later ones beyond that are kind `length`
    and are in no record. Tables without a name are left out. Other rows stay as they are.
    """
    rank = F.create_map(*(F.lit(x) for kv in order.items() for x in kv)) if order else None
    rank = F.coalesce(F.try_element_at(rank, F.col("section")), F.lit(1 << 30)) if order else F.lit(0)
    rows = rows.where((F.col("kind") != "record") | (F.coalesce("table_name", F.lit("null")).isin("", "null") == F.lit(False)))
    rows = rows.withColumn("_s", F.struct(rank.alias("rank"), "section"))
    rows = rows.repartition("doc_id", "table_name")
    table = Window.partitionBy("doc_id", "table_name")
    first = F.min(F.when(F.col("kind") == "record", F.col("_s"))).over(table)
    rows = rows.withColumn("_first", first)
    most = F.max(F.when((F.col("kind") == "record") & (F.col("_s") == F.col("_first")), F.col("id"))).over(table)
    rows = rows.withColumn("kind", F.when((F.col("kind") == "record") & (F.col("id") > most), "length").otherwise(F.col("kind")))
    # a record's column is one row, from the last section that has it; every other row is a group of its own
    own = F.when(F.col("kind") != "record", F.struct("section", "col"))
    merged = rows.groupBy("doc_id", "table_name", "kind", "id", "column_name", own.alias("_own")).agg(F.max_by("section", "_s").alias("section"), F.max_by("text", "_s").alias("text"))
    return merged.select("doc_id", "section", "kind", "table_name", "id", F.col("_own.col").alias("col"), "column_name", "text")


def record_ids(rows: DataFrame, parents: dict[str, str]) -> DataFrame:
    """Adds _id (counted per document and table in page order) and _par_id (the latest parent record at or before; 0 for roots)."""
    per_table = Window.partitionBy("doc_id", "table_name").orderBy("page_num", "record_no")
    rows = rows.withColumn("_id", F.row_number().over(per_table))
    parent = F.try_element_at(F.create_map(*(F.lit(x) for kv in parents.items() for x in kv)), F.col("table_name")) if parents else F.lit(None).cast("string")
    names = rows.columns
    # parents and children of one document in page order, parents first; the running maximum is the latest parent
    heads = rows.select(*names, F.col("table_name").alias("_of"), F.lit(0).alias("_kind"), F.col("_id").alias("_head"))
    children = rows.select(*names, parent.alias("_of"), F.lit(1).alias("_kind"), F.lit(None).cast("int").alias("_head"))
    upto = Window.partitionBy("doc_id", "_of").orderBy("page_num", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = heads.unionByName(children).withColumn("_par_id", F.coalesce(F.max("_head").over(upto), F.lit(0)))
    return found.where("_kind = 1").select(*names, F.when(F.col("_of").isNotNull(), F.col("_par_id")).otherwise(0).alias("_par_id"))


def numbered_errors(errors: DataFrame) -> DataFrame:
    """Errors of a document renamed unmatched1, unmatched2 ... over its pages."""
    return errors.withColumn("name", F.concat(F.lit("unmatched"), F.row_number().over(Window.partitionBy("doc_id").orderBy("page_num", "pos")).cast("string")))
