"""Filing documents away, with runs that stop in between."""

import datetime
import json

import pytest

from quillgrid.sources import archive as A
from quillgrid.sources.transactions import Tables

DAY = datetime.date(2024, 2, 3)
SCHEMA = "doc_id string, doc_class_id int, origin string, info string"


def given(spark, tmp_path, names=("a.pdf", "b.PDF")):
    (tmp_path / "in").mkdir(exist_ok=True)
    for n in names:
        (tmp_path / "in" / n).write_bytes(n.encode() * 3)
    docs = spark.createDataFrame([(n[0], 7 if n[0] == "a" else None, str(tmp_path / "in" / n), '{"x": 1}') for n in names], SCHEMA)
    pages = spark.createDataFrame([("a", 2, bytearray(b"p2")), ("a", 1, bytearray(b"p1"))], "doc_id string, page_num int, image binary")
    return docs, pages


def files(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file())


def test_complete(spark, tmp_path):
    docs, pages = given(spark, tmp_path)
    tables = Tables(spark, str(tmp_path / "tables"))
    for _ in range(2):
        rows = A.complete(tables, docs, pages, str(tmp_path / "done") + "/", DAY, "r").orderBy("complete_id").collect()
    assert files(tmp_path / "done") == ["2024/02/03/0_b/b.PDF", "2024/02/03/0_b/b.json", "2024/02/03/7_a/_page1_normalized.png", "2024/02/03/7_a/_page2_normalized.png", "2024/02/03/7_a/a.json", "2024/02/03/7_a/a.pdf"]
    assert files(tmp_path / "in") == [] and (tmp_path / "done/2024/02/03/7_a/a.pdf").read_bytes() == b"a.pdf" * 3
    assert [(r.complete_id, r.doc_id, r.use_yn) for r in rows] == [(1, "a", "Y"), (2, "b", "Y")]
    told = json.loads((tmp_path / "done/2024/02/03/7_a/a.json").read_text())
    assert told == json.loads(rows[0].content) and [p["page_num"] for p in told["page_infos"]] == [1, 2] and told["doc_path"]["_originfile"].endswith("/7_a/a.pdf")
    assert json.loads(rows[1].content)["page_infos"] == []


def test_a_run_that_stops_can_be_run_again(spark, tmp_path, monkeypatch):
    docs, pages = given(spark, tmp_path)
    tables = Tables(spark, str(tmp_path / "tables"))
    commit = Tables._commit
    monkeypatch.setattr(Tables, "_commit", lambda self, t: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        A.complete(tables, docs, pages, str(tmp_path / "done"), DAY, "r")
    assert len(files(tmp_path / "in")) == 2 and tables.read("complete") is None  # originals stay until the rows are there
    monkeypatch.setattr(Tables, "_commit", commit)
    assert A.complete(tables, docs, pages, str(tmp_path / "done"), DAY, "r").count() == 2 and files(tmp_path / "in") == []


def test_failed(spark, tmp_path):
    docs, _ = given(spark, tmp_path)
    A.fail(docs, str(tmp_path / "failed"), DAY)
    A.fail(docs, str(tmp_path / "failed"), DAY)
    assert files(tmp_path / "failed") == ["2024/02/03/a/a.json", "2024/02/03/a/a.pdf", "2024/02/03/b/b.PDF", "2024/02/03/b/b.json"] and files(tmp_path / "in") == []
    with pytest.raises(Exception, match="none.pdf"):
        A.fail(spark.createDataFrame([("z", 1, str(tmp_path / "in/none.pdf"), None)], SCHEMA), str(tmp_path / "failed"), DAY)
