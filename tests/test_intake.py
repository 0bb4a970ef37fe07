"""The page source and the transactional tables."""

import os
import time

import pytest
from pyspark.sql import functions as F

from quillgrid.sources import page_source as P
from quillgrid.sources.transactions import Tables, insert_documents

RENDER = "tests.fake_render:pages"


def put(folder, name, content, age=0):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content)
    if age:
        os.utime(path, (time.time() - age,) * 2)
    return str(path)


def pages(rows):
    return sorted((os.path.basename(r["path"]), r["page_num"], bytes(r["image"]) if r["image"] is not None else None, r["layout_id"] is not None) for r in rows)


def read(spark, folder, **options):
    spark.dataSource.register(P.PageSource)
    return spark.read.format("pages").options(path=str(folder), render=RENDER, **options).load()


def test_batch(spark, tmp_path):
    put(tmp_path, "a/one.pdf", b"p1|p2|p3")
    put(tmp_path, "a/b/two.PNG", b"img")
    put(tmp_path, ".hidden", b"x")
    put(tmp_path, "_writing", b"x")
    put(tmp_path, "empty.png", b"")
    want = [("empty.png", 1, b"", False), ("one.pdf", 1, b"p1", True), ("one.pdf", 2, b"p2", True), ("one.pdf", 3, b"p3", True), ("two.PNG", 1, b"img", False)]
    got = read(spark, tmp_path).collect()
    assert pages(got) == want
    assert len({r["file_id"] for r in got if r["path"].endswith(".pdf")}) == 1 and len({r["layout_id"] for r in got}) == 4
    assert pages(read(spark, tmp_path, pattern=r"\.(png|jpe?g)$").collect()) == [want[0], want[4]]
    assert pages(read(spark, tmp_path, recursive="false").collect()) == [want[0]]
    assert read(spark, tmp_path / "none").count() == 0


def test_files_are_dealt_by_bytes(tmp_path):
    files = [P.Found(f"f{i}", 0, s) for i, s in enumerate([10, 90, 50, 200, 40, 0, 60])]
    parts = P.dealt(files, 100)
    assert sorted(f.path for p in parts for f in p.files) == sorted(f.path for f in files)
    assert all(len(p.files) == 1 or sum(f.length for f in p.files) <= 100 for p in parts) and len(parts) == 4
    assert len(P.dealt([P.Found(str(i), 0, 10) for i in range(1000)], 100)) == 100


def test_broken_files(spark, tmp_path):
    put(tmp_path, "bad.pdf", b"broken")
    put(tmp_path, "good.pdf", b"x|y")
    with pytest.raises(Exception, match="no PDF"):
        read(spark, tmp_path).collect()
    rows = read(spark, tmp_path, mode="permissive").collect()
    assert sorted((os.path.basename(r["path"]), r["page_num"], r["error"]) for r in rows) == [("bad.pdf", 1, "ValueError: no PDF"), ("good.pdf", 1, None), ("good.pdf", 2, None)]
    assert P.targets(read(spark, tmp_path, mode="permissive"), F.lit("r1")).count() == 2


def test_targets(spark, tmp_path):
    put(tmp_path, "doc.pdf", b"x|y")
    put(tmp_path, "img.png", b"z")
    rows = {r["target_id"]: r for r in P.targets(read(spark, tmp_path), F.lit("run")).collect()}
    assert len(rows) == 3 and {r["run_id"] for r in rows.values()} == {"run"}
    contents = sorted(r["content"] for r in rows.values())
    assert any('"_origin":"doc_page_2.png","_origindoc":"' in c for c in contents) and any("img.png" in c and "_origindoc" not in c for c in contents)


def stream(spark, folder, work, **options):
    """Everything that is there now, through a file sink."""
    spark.dataSource.register(P.PageSource)
    df = spark.readStream.format("pages").options(path=str(folder), render=RENDER, log=str(work / "log"), **options).load()
    q = df.writeStream.format("parquet").option("path", str(work / "out")).option("checkpointLocation", str(work / "checkpoint")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(str(work / "out"))


def test_stream_of_a_growing_folder(spark, tmp_path):
    folder, work = tmp_path / "in", tmp_path / "work"
    put(folder, "a.pdf", b"1|2")
    put(folder, "b.png", b"b")
    assert pages(stream(spark, folder, work).collect()) == pages(read(spark, folder).collect())
    put(folder, "deep/late.png", b"late", age=100_000)  # older than what was read
    put(folder, "c.pdf", b"3|4|5")
    got = stream(spark, folder, work)
    assert pages(got.collect()) == pages(read(spark, folder).collect()) and got.count() == 7
    assert stream(spark, folder, work).count() == 7  # nothing new, nothing again


def test_stream_plans_a_begun_batch_alike(tmp_path):
    folder, log = tmp_path / "in", tmp_path / "log"
    options = {"path": str(folder), "log": str(log), "partitionbytes": "10"}
    for i in range(5):
        put(folder, f"{i}.png", b"12345")
    one = P.PageStream(options)
    end = one.latestOffset()
    planned = [[f.path for f in p.files] for p in one.partitions(one.initialOffset(), end)]
    put(folder, "new.png", b"1")
    two = P.PageStream(options)  # restarted before the batch was done
    assert [[f.path for f in p.files] for p in two.partitions({"files": 0}, end)] == planned
    assert two.latestOffset() == {"files": 6}
    assert [f.path for p in two.partitions(end, {"files": 6}) for f in p.files] == [str(folder / "new.png")]


def test_stream_takes_so_many_files_at_once(tmp_path):
    for i in range(5):
        put(tmp_path / "in", f"{i}.png", b"1")
    s = P.PageStream({"path": str(tmp_path / "in"), "log": str(tmp_path / "log"), "maxfilespertrigger": "2"})
    assert [s.latestOffset()["files"] for _ in range(4)] == [2, 4, 5, 5]


def files(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file() and not p.name.startswith("."))


def test_commit_gives_dense_keys_in_order(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    for name, first in (("t1", 0), ("t2", 100)):
        with tables.transaction(name) as t:
            t.insert("head", spark.range(first, first + 40, 1, 4).select((F.lit(1000) - F.col("id")).alias("doc")), key="pk", order=["doc"])
            t.insert("line", spark.range(first, first + 10).selectExpr("id AS n", "'x' AS v"))
    got = tables.read("head").orderBy("pk").collect()
    assert [r.pk for r in got] == list(range(1, 81))
    for part in (got[:40], got[40:]):
        assert [r.doc for r in part] == sorted(r.doc for r in part)
    assert tables.read("line").count() == 20 and tables.read("line", "t2").agg(F.min("n")).first()[0] == 100
    assert tables.read("nothing") is None


def test_a_transaction_run_again_is_there_once(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    for _ in range(3):
        with tables.transaction("batch 5/a") as t:
            t.insert("rows", spark.range(10), key="pk", order=["id"])
    assert tables.read("rows").count() == 10 and len(tables.log()) == 1


def test_a_failing_task_leaves_nothing(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    with tables.transaction("good") as t:
        t.insert("a", spark.range(5))
    before = files(tmp_path)
    bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("task fails"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="task fails"), tables.transaction("bad") as t:
        t.insert("a", spark.range(5, 9))
        t.insert("b", bad)
    assert files(tmp_path) == before and tables.read("a").count() == 5 and tables.read("b") is None
    # an error of the caller between two tables
    with pytest.raises(KeyError), tables.transaction("bad") as t:
        t.insert("a", spark.range(5, 9))
        raise KeyError("x")
    assert files(tmp_path) == before
    with tables.transaction("bad") as t:  # now it goes through
        t.insert("a", spark.range(5, 9))
    assert sorted(r.id for r in tables.read("a").collect()) == list(range(9))


def test_what_a_crash_left_is_invisible_and_goes(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    t = tables.transaction("crashed")
    t.__enter__().insert("a", spark.range(7))  # the process ends here
    assert Tables(spark, str(tmp_path)).read("a") is None
    with Tables(spark, str(tmp_path)).transaction("crashed") as again:
        again.insert("a", spark.range(3))
    assert tables.read("a").count() == 3 and len([f for f in files(tmp_path) if f.endswith(".parquet")]) <= 4


def test_two_processes_cannot_take_one_number(spark, tmp_path):
    one, two = Tables(spark, str(tmp_path)), Tables(spark, str(tmp_path))
    with pytest.raises(RuntimeError, match="another process"), one.transaction("one") as t:
        t.insert("a", spark.range(3))
        log = two.log()
        with two.transaction("two") as u:
            u.insert("a", spark.range(5))
        one.log = lambda: log
    assert two.read("a").count() == 5


def test_documents_insert_all_their_tables_or_none(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    heads = spark.createDataFrame([(1, 1, 0, "h1"), (2, 1, 0, "h2"), (2, 2, 0, "h3"), (3, 1, 0, "h4")], "doc_id int, _id int, _par_id int, v string")
    lines = spark.createDataFrame([(1, 1, 1, "a"), (1, 2, 1, "b"), (2, 1, 1, "c"), (3, 1, 9, "d")], "doc_id int, _id int, _par_id int, v string")
    for _ in range(2):
        kept = insert_documents(tables, "run-1", {"head": (heads, None), "line": (lines, "head")})
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "head", 1), (1, "line", 1), (1, "line", 2), (3, "head", 2)]
    assert sorted((r.doc_id, r.v, r.pk, r.parent_pk) for r in tables.read("line").collect()) == [(1, "a", 1, 1), (1, "b", 2, 1)]
    assert sorted((r.doc_id, r.table_name, r.reason) for r in tables.read("_rejected").collect()) == [(2, "head", "several roots")] * 2 + [(2, "line", "parent missing"), (3, "line", "parent missing")]
    more = insert_documents(tables, "run-2", {"head": (heads.where("doc_id = 1"), None)})
    assert [tuple(r) for r in more.collect()] == [(1, "head", 3)]
