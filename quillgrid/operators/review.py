"""The review side as rows: what keeps a configuration from being used, corrections that become dictionary entries, and translation with a hook."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.operators.grid import template_row

#: What a document class needs before it can be switched on, in the order in which it is looked at. Fixed values.
RULES = ("active layouts", "IMG_PREPROCESS_INFO", "CLASSIFY_AI_INFO", "model", "sections", "template file", "mask image")
#: What a failed translation holds. Fixed value.
FAILED = "Error: 번역에 실패했습니다."


def _blank(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c)) == "", F.lit(True))


def config_violations(docs: DataFrame, layouts: DataFrame, sections: DataFrame, files: DataFrame, class_folder: str) -> DataFrame:
    """doc_class_id, layout_class_id, rule (of RULES), detail of everything that is missing.

    docs: doc_class_id. layouts: doc_class_id, layout_class_id, use_yn, img_preprocess_info, classify_ai_info, ai_model_dir, template_file_path; only those in use count.
    sections: layout_class_id. files: path of every file there is. A class without a layout in use has one row. A model folder (ai_model_dir, else the usual one under
    class_folder) must hold a file; a layout without sections is looked at no further; a template that is named must be a file; the mask image must be there.
    """
    active = layouts.where("use_yn = 'Y'").join(docs.select("doc_class_id").distinct(), "doc_class_id")
    none = docs.select("doc_class_id").distinct().join(active.select("doc_class_id").distinct(), "doc_class_id", "left_anti")
    none = none.select("doc_class_id", F.lit(None).cast(layouts.schema["layout_class_id"].dataType).alias("layout_class_id"), F.lit(RULES[0]).alias("rule"), F.lit(None).cast("string").alias("detail"))
    own = F.concat_ws("/", F.lit(class_folder.rstrip("/")), F.col("doc_class_id").cast("string"), F.col("layout_class_id").cast("string"), F.lit("classify"))
    rows = active.withColumn("_model", F.when(_blank("ai_model_dir"), F.concat(own, F.lit("/model"))).otherwise(F.regexp_replace("ai_model_dir", "/+$", "")))
    rows = rows.withColumn("_mask", F.concat(own, F.lit("/asset/mask_image.png"))).withColumn("_template", F.when(~_blank("template_file_path"), F.col("template_file_path")))
    # only paths that are asked for are kept of the files
    there = files.select("path").distinct()
    folders = there.select(F.regexp_replace("path", "/[^/]*$", "").alias("path")).distinct()
    known = lambda df, name: df.select(F.col("path").alias(name), F.lit(True).alias(f"{name}_there"))
    rows = rows.join(known(folders, "_model"), "_model", "left").join(known(there, "_mask"), "_mask", "left").join(known(there, "_template"), "_template", "left")
    rows = rows.join(sections.groupBy("layout_class_id").agg(F.count("*").alias("_sections")), "layout_class_id", "left")
    some = F.coalesce("_sections", F.lit(0)) > 0
    checks = [
        (_blank("img_preprocess_info"), RULES[1], None), (_blank("classify_ai_info"), RULES[2], None), (F.col("_model_there").isNull(), RULES[3], "_model"), (~some, RULES[4], None),
        (some & F.col("_template").isNotNull() & F.col("_template_there").isNull(), RULES[5], "_template"), (some & F.col("_mask_there").isNull(), RULES[6], "_mask"),
    ]
    broken = F.array(*(F.when(c, F.struct(F.lit(r).alias("rule"), (F.col(d) if d else F.lit(None).cast("string")).alias("detail"))) for c, r, d in checks))
    found = rows.select("doc_class_id", "layout_class_id", F.explode(F.filter(broken, lambda x: x.isNotNull())).alias("b")).select("doc_class_id", "layout_class_id", "b.*")
    return none.unionByName(found)


def corrections(edits: DataFrame, sizes: DataFrame, blocks: DataFrame, dictionary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new dictionary entries: block_id, error_text, correct_text; edits without a block).

    edits: section, row, col, error_text, correct_text of a reviewer. sizes: section, first, step, the template's value rows, for sections whose rows repeat; an edit of a repeated row
    counts for the template row that it repeats. blocks: section, row, col, block_id. Spaces in both texts go; edits that change nothing, or whose error is empty, make
    no entry. An entry that the dictionary has already isn't made again; of several edits of one error in one block the greatest correction stays.
    """
    plain = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"\s", "")
    rows = edits.join(sizes.select("section", "first", "step"), "section", "left")
    rows = rows.withColumn("row", F.when(F.col("step").isNotNull() & (F.col("row") >= F.col("first")), template_row(F.col("row"), F.col("first"), F.col("step"))).otherwise(F.col("row")).cast("int"))
    rows = rows.select("section", "row", "col", plain("error_text").alias("error_text"), plain("correct_text").alias("correct_text")).where("error_text <> '' AND error_text <> correct_text")
    placed = rows.join(blocks.select("section", F.col("row").cast("int").alias("row"), "col", "block_id"), ["section", "row", "col"], "left")
    new = placed.where("block_id IS NOT NULL").groupBy("block_id", "error_text").agg(F.max("correct_text").alias("correct_text"))
    known = dictionary.select("block_id", "error_text", "correct_text").distinct()
    return new.join(known, ["block_id", "error_text", "correct_text"], "left_anti"), placed.where("block_id IS NULL").drop("block_id")


#: From texts and their language codes to translations; null, or a text with FAILED, where it fails.
Translate = Callable[[pd.Series, pd.Series], pd.Series]


def translations(cells: DataFrame, translate: Translate, at_once: int = 512) -> DataFrame:
    """lang, text, translated of every different text of cells (lang, text): each is translated once, however many rows have it; failed ones are left out."""
    distinct = cells.select("lang", "text").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), at_once):
                some = b.iloc[at : at + at_once]
                done = pd.Series(list(translate(some["text"], some["lang"])), index=some.index, dtype=object)
                good = done.map(lambda t: isinstance(t, str) and FAILED not in t)
                yield some[good].assign(translated=done[good])

    return distinct.mapInPandas(run, "lang string, text string, translated string")


def translation_log(df: DataFrame, key: str, table: str, detect: Callable[[Column], Column], translate: Translate, log: DataFrame, columns: Sequence[str] | None = None, own: str = "ko") -> DataFrame:
    """table_name, row_key, column_name, ori_text, trn_text to be logged for rows of a table that the log doesn't name yet.

    Each text column (all of them but the key) that isn't blank and whose language is known and not `own` is translated. A row without such a cell, or whose translations all fail,
    logs itself once (its key as column, text and translation), so that it isn't looked at again. Other tables go on where one is missing or done.
    """
    columns = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string" and f.name != key]
    done = log.where(F.col("table_name") == table).select(F.col("row_key").cast("string").alias("row_key")).distinct()
    rows = df.withColumn("row_key", F.col(key).cast("string")).join(done, "row_key", "left_anti")
    cells = rows.select("row_key", F.inline(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("text")) for c in columns)))) if columns else rows.select("row_key", F.lit("").alias("column_name"), F.lit("").alias("text"))
    cells = cells.where(F.coalesce(F.trim("text") != "", F.lit(False))).withColumn("lang", detect(F.col("text"))).where(~F.col("lang").isin("", own))
    told = translations(cells, translate)
    out = cells.join(told, ["lang", "text"]).select("row_key", "column_name", F.col("text").alias("ori_text"), F.col("translated").alias("trn_text"))
    # rows and what they log in one pass: each row once more, without a cell, which stays where it is alone
    marks = rows.select("row_key").distinct().select("row_key", F.lit(key).alias("column_name"), F.col("row_key").alias("ori_text"), F.col("row_key").alias("trn_text"), F.lit(0).alias("_real"))
    both = out.withColumn("_real", F.lit(1)).unionByName(marks).groupBy("row_key").agg(F.max("_real").alias("_any"), F.collect_list(F.struct("column_name", "ori_text", "trn_text", "_real")).alias("_c"))
    logged = both.select("row_key", F.inline(F.filter("_c", lambda c: c["_real"] == F.col("_any"))))
    return logged.select(F.lit(table).alias("table_name"), "row_key", "column_name", "ori_text", "trn_text")


def translate_tables(tables, targets: Sequence[tuple[str, DataFrame | None, str]], detect: Callable[[Column], Column], translate: Translate, name: str, log_table: str = "translate_log") -> DataFrame | None:
    """Translates what the log doesn't have of each table (name, rows or None, key) and appends the log, a table a transaction `name`-table: run again, nothing is logged
    twice. Tables that aren't there are passed over. Gives the log."""
    spark = tables.spark
    empty = spark.createDataFrame([], "table_name string, row_key string")
    for table, rows, key in targets:
        if rows is None:
            continue
        with tables.transaction(f"{name}-{table}") as t:
            if not t.done:
                log = tables.read(log_table)
                t.insert(log_table, translation_log(rows, key, table, detect, translate, empty if log is None else log))
    return tables.read(log_table)
