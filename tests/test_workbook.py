"""Workbooks: what is written is read again, whatever it holds."""

import io
import zipfile

import pytest

from quillgrid.sources import workbook as W


def test_names_of_sheets_and_columns():
    taken = set()
    assert W.sheet_name("t" * 40, taken) == "t" * 31 and W.sheet_name("T" * 40, taken) == "T" * 29 + "~2" and W.sheet_name("a/b:c", taken) == "a_b_c" and W.sheet_name("", taken) == "_"
    assert [W.column_letters(i) for i in (0, 25, 26, 51, 52, 701, 702)] == ["A", "Z", "AA", "AZ", "BA", "ZZ", "AAA"]


def test_rows_beyond_a_sheet_go_on_in_another(monkeypatch):
    monkeypatch.setattr(W, "SHEET_ROWS", 4)
    out = io.BytesIO()
    book = W.Workbook(out)
    book.begin("t", ["a"])
    for i in range(7):
        book.write({"a": str(i)})
    book.close()
    got = list(W.sheet_rows(out.getvalue()))
    assert [r[0] for r in got] == ["t"] * 3 + ["t~2"] * 3 + ["t~3"] and [r[3] for r in got] == [str(i) for i in range(7)]


def test_round_trip(spark, tmp_path):
    odd = ["", " lead", "a<b>&\"'", "line\nbreak\ttab\r", "\x00\x0b", "_x0041_", "가나 😀", "\uffff", "=1+1", None]
    rows = [("d/1", "t", i + 1, "v", v) for i, v in enumerate(odd)] + [("d/1", "t", 3, "extra", "x"), ("d/1", "u" * 40, 1, "z", "1"), ("d/1", "u" * 40, 1, "a", "2"), ("2", "t", 1, "only", "y")]
    cells = spark.createDataFrame(rows, "doc_id string, table_name string, row int, column_name string, value string").repartition(4)
    assert W.write_workbooks(cells, str(tmp_path)) == 2
    got = sorted(tuple(r) for r in W.read_workbooks(spark, str(tmp_path)).collect())
    assert got == sorted((d, t[:31], r, c, v) for d, t, r, c, v in rows if v is not None)
    with zipfile.ZipFile(tmp_path / "d%00002f1.xlsx") as z:
        assert z.testzip() is None and set(z.namelist()) >= {"[Content_Types].xml", "_rels/.rels", "xl/workbook.xml", "xl/worksheets/sheet2.xml"}
        sheet = z.read("xl/worksheets/sheet2.xml").decode()
    assert sheet.index(">a<") < sheet.index(">z<")  # columns come sorted


def test_read_back_needs_what_the_list_names(spark, tmp_path):
    kept = spark.createDataFrame([("1", 1, "10"), ("1", 1, "10"), ("1", 1, "99"), ("2", 2, "x")], "doc_id string, table_id int, pk_value string")
    catalogue = spark.createDataFrame([(1, "a", "id", "Y"), (1, "a", "v", "N"), (2, "b", "code", "Y"), (3, "c", "id", "Y")], "table_id int, table_name string, column_name string, is_pk string")
    a, b = spark.createDataFrame([(10, "va"), (11, "vb")], "id int, v string"), spark.createDataFrame([("x", None)], "code string, w string")
    got = sorted((tuple(r) for r in W.read_back(kept, catalogue, {"a": a, "b": b}).collect()), key=lambda r: r[:4])
    assert got == [("1", "a", 1, "id", "10"), ("1", "a", 1, "v", "va"), ("2", "b", 1, "code", "x"), ("2", "b", 1, "w", None)]
    with pytest.raises(ValueError, match="aren't stored: b"):
        W.read_back(kept, catalogue, {"a": a})
    assert W.read_back(kept.limit(0), catalogue, {}).count() == 0
