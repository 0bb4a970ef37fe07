"""Recognised words as rows: from an engine's lists, without what isn't one, in reading order, joined to lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The lists that a recogniser gives for a page, and what their entries are read as. Fixed names.
LISTS = {
    "level": "int", "page_num": "int", "block_num": "int", "par_num": "int", "line_num": "int", "word_num": "int", "left": "int", "top": "int", "width": "int", "height": "int", "conf": "double", "text": "string",
}


def words(df: DataFrame, keep: Sequence[str], lists: Sequence[str] = tuple(LISTS)) -> DataFrame:
    """One row per word of each row's lists (texts), by place. A confidence that isn't a number is -1, another number that can't be read 0, a missing text empty; shorter lists end
    in such values."""

    def read(c: Column, name: str) -> Column:
        if LISTS[name] == "string":
            return F.coalesce(c, F.lit(""))
        return F.coalesce(c.try_cast("double"), F.lit(-1.0 if name == "conf" else 0.0)).cast(LISTS[name])

    rows = df.select(*keep, F.posexplode(F.arrays_zip(*(F.col(f"`{n}`").alias(n) for n in lists))).alias("place", "w"))
    return rows.select(*keep, "place", *(read(F.col(f"w.{n}"), n).alias(n) for n in lists))


def real_words(df: DataFrame, text: str = "text", conf: str = "conf") -> DataFrame:
    """Words with a confidence and something in their text."""
    return df.where((F.col(conf) > -1) & (F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s", " ")) != ""))


def lines(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """by, text, left, top, width, height, conf, n of each line: words joined by a space in `order`, the box around all, the mean confidence to two places (half to even)."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "text"))), lambda s: s["text"]), " ")
    right, bottom = F.max(F.col("left") + F.col("width")), F.max(F.col("top") + F.col("height"))
    return df.groupBy(*by).agg(
        joined.alias("text"), F.min("left").alias("left"), F.min("top").alias("top"), (right - F.min("left")).alias("width"), (bottom - F.min("top")).alias("height"), F.bround(F.avg("conf"), 2).alias("conf"), F.count("*").alias("n")
    )


def large_boxes(df: DataFrame, width: str = "width", height: str = "height", least: int = 10) -> DataFrame:
    """Boxes wider and taller than `least`: smaller ones are noise."""
    return df.where((F.col(width) > least) & (F.col(height) > least))


def reading_order(df: DataFrame, by: Sequence[str], x: str, y: str, key: str, mode: str = "rows") -> DataFrame:
    """Adds place (from 1): `rows` by top, then left; `corners` by their sum; `left` by left alone. What is equal stays in the order of `key`."""
    order = {"rows": [y, x], "corners": [F.col(x) + F.col(y)], "left": [x]}[mode]
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order, key)))
