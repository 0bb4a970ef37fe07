"""Sections of a document to records: one pass, merged sections, odd rows."""

from pyspark.sql import functions as F

import __spark_entry__
from quillgrid.operators import assembly

TEMPLATE = "section string, kind string, row int, col int, cell_type string, table_name string, column_name string, default_text string"


def run(spark, cells, words, **more):
    frame = spark.createDataFrame(words, "doc_id int, section string, block_id string, x double, y double, text string").repartition(3)
    return [tuple(r) for r in assembly.structure(frame, spark.createDataFrame(cells, TEMPLATE), F.array().cast("array<struct<err:string,fix:string>>"), gap=25, **more).select("section", "kind", "table_name", "id", "col", "column_name", "text").collect()]


def key(row):
    return tuple(str(v) for v in row)


def test_sections_that_fill_one_table_are_merged(spark):
    cells = [(s, "MULTI_ROW", 1, c, "val", "t", n, None) for s, c, n in (("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), ("b", 2, "z"))]
    word = lambda s, r, c, t: (1, s, f"{s}{r}{c}", c * 50.0, 10 + r * 30.0, t)
    words = [word("a", r, c, f"a{r}{c}") for r in (1, 2) for c in (1, 2)] + [word("b", r, c, f"b{r}{c}") for r in (1, 2, 3) for c in (1, 2)]
    want = [("b", "record", "t", r, None, "x", f"b{r}1") for r in (1, 2)] + [("a", "record", "t", r, None, "y", f"a{r}2") for r in (1, 2)] + [("b", "record", "t", r, None, "z", f"b{r}2") for r in (1, 2)]
    long = [("b", "length", "t", 3, None, "x", "b31"), ("b", "length", "t", 3, None, "z", "b32")]
    assert sorted(run(spark, cells, words), key=key) == sorted(want + long, key=key)
    # the other way round b comes first and has three records
    got = run(spark, cells, words, sections={"b": 0, "a": 1})
    assert sorted(r for r in got if r[3] == 1) == sorted([("a", "record", "t", 1, None, "x", "a11"), ("a", "record", "t", 1, None, "y", "a12"), ("b", "record", "t", 1, None, "z", "b12")])
    assert [r for r in got if r[3] == 3 and r[5] == "x"] == [("b", "record", "t", 3, None, "x", "b31")] and all(r[1] == "record" for r in got)


def test_errors_name_their_section_and_place(spark):
    cells = [(s, "ONE_ROW", 1, c, "key", None, None, "Name") for s in "ab" for c in (1, 2)] + [(s, "ONE_ROW", 2, 1, "val", "t", "v", None) for s in "ab"]
    words = [(1, s, f"{s}{c}", c * 50.0, 10.0, t) for s, c, t in (("a", 1, "Na me"), ("a", 2, "Nome"), ("b", 1, "Nome"), ("b", 2, "Nome"))]
    got = sorted(run(spark, cells, words), key=key)
    assert got == sorted([("a", "mismatch", None, 1, 2, None, "Nome"), ("b", "mismatch", None, 1, 1, None, "Nome"), ("b", "mismatch", None, 1, 2, None, "Nome"), ("a", "missing", None, 2, 1, None, None), ("b", "missing", None, 2, 1, None, None)], key=key)


def test_blocks_at_one_place_come_by_their_id(spark):
    cells = [("a", "ONE_ROW", 1, c, "val", "t", f"c{c}", None) for c in (1, 2)]
    words = [(1, "a", "2", 50.0, 10.0, "same"), (1, "a", "1", 50.0, 10.0, "other")]
    assert sorted(r[5:] for r in run(spark, cells, words)) == [("c1", "other"), ("c2", "same")]


def test_tables_without_a_name_are_left_out(spark):
    cells = [("a", "ONE_ROW", 1, 1, "val", "null", "c", None), ("a", "ONE_ROW", 1, 2, "val", "", "c", None), ("a", "ONE_ROW", 1, 3, "val", None, "c", None), ("a", "ONE_ROW", 1, 4, "val", "t", "c", None)]
    words = [(1, "a", str(c), 50.0 * c, 10.0, f"v{c}") for c in (1, 2, 3, 4)]
    assert [r[2:] for r in run(spark, cells, words)] == [("t", 1, None, "c", "v4")]


def test_a_document_is_shuffled_at_most_ten_times(spark):
    df = __spark_entry__.queries()["document_pipeline"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 10, plan.count("Exchange")
    for name, most in (("structuring_by_type", 6), ("key_mismatches", 6), ("missing_blocks", 6)):
        plan = __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") <= most, (name, plan.count("Exchange"))
