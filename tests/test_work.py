"""Words, queues and merges: odd values."""

import pytest
from pyspark.sql import functions as F

from quillgrid.operators import mapping, queues, recognised, relational
from quillgrid.sources import sinks


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_words_of_lists(spark):
    df = spark.createDataFrame([(1, ["a", None, " ", "d"], ["90.5", "-1", "x", None], ["1", "2.7", "z"])], "id int, text array<string>, conf array<string>, left array<string>")
    got = [tuple(r) for r in recognised.words(df, ["id"], ["left", "conf", "text"]).orderBy("place").collect()]
    assert got == [(1, 0, 1, 90.5, "a"), (1, 1, 2, -1.0, ""), (1, 2, 0, -1.0, " "), (1, 3, 0, -1.0, "d")]
    assert [r.text for r in recognised.real_words(recognised.words(df, ["id"], ["left", "conf", "text"])).collect()] == ["a"]
    assert recognised.words(df.select("id", F.lit(None).cast("array<string>").alias("text")), ["id"], ["text"]).count() == 0


def test_queue_rules(spark):
    q = lambda k, *s: [(k, i, i, c) for i, c in enumerate(s)]
    schema = "g string, created int, id int, status string"
    df = spark.createDataFrame(q("manual__", "U", "W", "H", "D") + q("scheduled__", "W", "W", "U") + q("manual--", "W", "U") + q("other", "W", "U") + q("idle", "U", "C"), schema)
    got = queues.finish(df, ["g"], "created", "id", F.concat("g", F.lit("1")))
    by = {g: sorted((r.id if r.id is not None else 99, r.status, r.kind) for r in got.collect() if r.g == g) for g in ("manual__", "scheduled__", "manual--", "other", "idle")}
    assert by["manual__"] == [(0, "W", "promoted"), (1, "W", "kept"), (2, "C", "closed"), (3, "D", "kept"), (99, "W", "new")]
    assert by["scheduled__"] == [(0, "C", "closed"), (1, "W", "next"), (2, "U", "kept"), (99, "U", "new")]
    assert by["manual--"] == [(0, "C", "closed"), (1, "W", "promoted"), (99, "W", "new")]
    assert by["other"] == [(0, "C", "closed"), (1, "U", "kept"), (99, "U", "new")] and by["idle"] == [(0, "U", "kept"), (1, "C", "kept")]
    assert rows(queues.targets(df, ["g"], "created", "id", F.lit("r")))[0] == ("manual--", 0, "r")


def test_zip_and_merge(spark):
    df = spark.createDataFrame([(1, [1, 2], ["a", "b"]), (2, [1], []), (3, [], [])], "id int, a array<int>, b array<string>")
    assert rows(df.select("id", F.inline(mapping.zip_checked(F.col("a"), F.col("b"), "m")))) == [(1, 1, "a", None), (1, 2, "b", None), (2, None, None, "m: 1 and 0")]
    m = spark.createDataFrame([([{"x": "1", "y": "2"}], [{"y": "3"}, {"z": "4"}])], "a array<map<string,string>>, b array<map<string,string>>")
    assert m.select(relational.update_by_position(F.col("a"), F.col("b")).alias("r")).first()["r"] == [{"x": "1", "y": "3"}, {"z": "4"}]


def test_updates(spark):
    old = spark.createDataFrame([(1, "a", 1), (None, "b", 2), (3, "c", 3)], "k int, v string, w int")
    new = spark.createDataFrame([(1, None), (None, "n"), (9, "z")], "k int, v string")
    assert rows(sinks.update_rows(old, new, ["k"], ["v"])) == rows(spark.createDataFrame([(1, None, 1), (None, "n", 2), (3, "c", 3)], "k int, v string, w int"))
    with pytest.raises(Exception, match="several changes"):
        sinks.update_rows(old, new.union(new), ["k"], ["v"]).collect()


def test_status(spark):
    df = spark.createDataFrame([(1, "success"), (2, "error"), (3, None)], "id int, status string")
    good, rest = relational.by_status(df, "status")
    assert rows(good) == [(1,)] and rows(rest) == [(2, "error"), (3, None)] and good.columns == ["id"]
