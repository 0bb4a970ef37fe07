"""A document's run: positioned, recognised blocks to records, in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.functions import text as T
from quillgrid.operators import grid, structuring
from quillgrid.operators.structuring import MULTI_ROW


def correct(blocks: DataFrame, template: DataFrame, common: Column, block_fixes: DataFrame | None = None) -> DataFrame:
    """blocks with their text cleansed: white space and stray characters go, the common dictionary is applied (it may depend on columns of blocks, as the
    section), then the dictionary of the block that the place stands for. block_fixes: section, row, col (of the template), error, correct. A repeated row uses the dictionary of the value row that it repeats."""
    clean = T.apply_dictionary(T.sanitize_text(T.remove_whitespace(F.col("text"))), common)
    blocks = blocks.withColumn("text", clean)
    if block_fixes is None:
        return blocks
    val = F.when(F.col("cell_type") == "val", F.col("row"))
    size = template.groupBy("section").agg(F.max("kind").alias("_kind"), F.max("row").alias("_last"), F.min(val).alias("_first"), (F.max(val) - F.min(val) + 1).alias("_step"))
    placed = blocks.join(F.broadcast(size), "section", "left")  # one row per section of the template
    repeated = (F.col("_kind") == MULTI_ROW) & (F.col("row") > F.col("_last"))
    placed = placed.withColumn("_row", F.when(repeated, grid.template_row(F.col("row"), F.col("_first"), F.col("_step"))).otherwise(F.col("row")))
    fixes = block_fixes.select(F.col("section").alias("_s"), F.col("row").alias("_r"), F.col("col").alias("_c"), F.col("error").alias("_e"), "correct")
    same = (F.col("section") == F.col("_s")) & (F.col("_row") == F.col("_r")) & (F.col("col") == F.col("_c")) & (F.col("text") == F.col("_e"))
    return placed.join(fixes, same, "left").select(*(F.col(c) for c in blocks.columns if c != "text"), F.coalesce("correct", "text").alias("text"))


def structure(words: DataFrame, template: DataFrame, common: Column, block_fixes: DataFrame | None = None, gap: float | None = None, sections: dict[str, int] | None = None) -> DataFrame:
    """doc_id, section, kind, table_name, id, col, column_name, text of each document.

    words: doc_id, section, x, y, text of leaf blocks, and block_id, which settles the order of blocks at one place (without it, the text does). kind `record`:
    a value, id is its record's number within the document and table, where sections that fill one table are merged, later ones (by `sections`: name to place)
    winning; `length`: a record that the table's first section has no place for; `mismatch`: a key text that isn't the template's, `missing`: a template cell
    without a block, id and col are their place in the section. Documents with errors keep what fits.
    """
    last = "block_id" if "block_id" in words.columns else "text"
    numbered = words.withColumn("_order", F.struct("y", "x", last)).repartition("doc_id", "section")
    placed = grid.grid(numbered, ["doc_id", "section"], "x", "y", "_order", gap).select("doc_id", "section", "row", "col", "text")
    matched = structuring.match_template(correct(placed, template, common, block_fixes), template)
    return structuring.merge_sections(structuring.outcomes(matched), sections)
