"""Streams that stop and go on: intake once, run states, ends of streams."""

import random

import pytest
from pyspark.sql import functions as F

from quillgrid.sources.transactions import Tables
from quillgrid.streaming import runs
from quillgrid.streaming.sinks import take_in, to_end

SCHEMA = "k string, ts timestamp, v int"


def arrive(spark, folder, n, rows):
    spark.createDataFrame(rows, "k string, t string, v int").selectExpr("k", "timestamp(t) AS ts", "v").coalesce(1).write.parquet(f"{folder}/in/{n}")


def intake(spark, folder):
    df = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
    tables = Tables(spark, f"{folder}/tables")
    take_in(df, ["k"], "ts", "1 hour", tables, "taken", f"{folder}/checkpoint", order=["k"]).awaitTermination()
    return tables


def test_intake_once(spark, tmp_path):
    arrive(spark, tmp_path, 0, [("a", "2024-01-01 00:00:00", 1), ("a", "2024-01-01 00:10:00", 1), ("b", "2024-01-01 00:20:00", 2)])
    assert sorted(r.k for r in intake(spark, tmp_path).read("taken").collect()) == ["a", "b"]
    # a repeat within the watermark, one long after it, and new keys
    arrive(spark, tmp_path, 1, [("b", "2024-01-01 00:25:00", 2), ("c", "2024-01-05 00:00:00", 3)])
    arrive(spark, tmp_path, 2, [("a", "2024-03-01 00:00:00", 1), ("d", "2024-03-01 00:00:00", 4)])
    tables = intake(spark, tmp_path)
    assert sorted((r.k, r.v) for r in tables.read("taken").collect()) == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]
    # a crash between the table's commit and the stream's: the last batch is run again
    commits = sorted((p for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    commits[-1].unlink()
    for crc in (tmp_path / "checkpoint" / "commits").glob(f".{commits[-1].name}.crc"):
        crc.unlink()
    before = len(tables.log())
    tables = intake(spark, tmp_path)
    assert sorted(r.k for r in tables.read("taken").collect()) == ["a", "b", "c", "d"] and len({c["name"] for c in tables.log()}) == len(tables.log()) >= before


def test_end_of_a_stream_goes_on(spark, tmp_path):
    for n in range(3):
        arrive(spark, tmp_path, n, [(f"k{n}", "2024-01-01 00:00:00", n), ("all", "2024-01-01 00:00:00", n)])
        df = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        plain = to_end(df, "append", f"{tmp_path}/plain")
        total = to_end(df.groupBy("k").agg(F.sum("v").alias("v")), "complete", f"{tmp_path}/total")
        assert plain.count() == 2 * (n + 1)
        assert {r.k: r.v for r in total.collect()} == {**{f"k{i}": i for i in range(n + 1)}, "all": sum(range(n + 1))}


def test_allowed_and_refused_moves():
    status, since, rows = runs.settle_reports("", 0, [(10, 1, "P"), (12, 2, "W"), (15, 3, "C"), (20, 4, "P"), (25, 5, "U"), (30, 6, "W"), (31, 7, "H"), (32, 8, "P")], None, 100)
    assert [(r[1], r[4]) for r in rows] == [(1, "move"), (2, "illegal"), (3, "move"), (4, "illegal"), (5, "move"), (6, "move"), (7, "move"), (8, "move")]
    assert (status, since) == ("P", 32)


def test_busy_for_too_long():
    assert runs.settle_reports("P", 0, [(101, 1, "C"), (102, 2, "U")], None, 100)[2] == [(100, None, "P", "E", "timeout"), (101, 1, "E", "C", "illegal"), (102, 2, "E", "U", "move")]
    assert runs.settle_reports("P", 0, [(100, 1, "C")], None, 100)[2] == [(100, 1, "P", "C", "move")]
    assert runs.settle_reports("P", 0, [], 100, 100)[2] == [] and runs.settle_reports("P", 0, [], 101, 100) == ("E", 100, [(100, None, "P", "E", "timeout")])


@pytest.mark.parametrize("cuts", [1, 3])
def test_states_do_not_depend_on_the_way_reports_arrive(spark, tmp_path, cuts):
    rng = random.Random(5)
    reports = [(run, 1_704_067_200_000_000 + rng.randrange(10**10), 100 * run + i, rng.choice(runs.STATES + "PPWW")) for run in range(6) for i in range(25)]
    reports.sort(key=lambda r: r[1])
    limit = 600_000_000
    want = []
    for run in range(6):
        mine = [r[1:] for r in reports if r[0] == run]
        want += [(run, *r) for r in runs.settle_reports("", 0, mine, 10**17, limit)[2]]
    size = -(-len(reports) // cuts)
    for n in range(cuts):
        part = reports[n * size : (n + 1) * size]
        rng.shuffle(part)  # out of order within a file
        spark.createDataFrame(part, "run_id bigint, at bigint, event_id bigint, status string").selectExpr("run_id", "timestamp_micros(at) AS ts", "at", "event_id", "status").coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        got = _moves(spark, tmp_path, limit)
    for _ in runs.marks(spark, f"{tmp_path}/in", ["2026-01-01", "2026-01-02"]):
        got = _moves(spark, tmp_path, limit)
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    assert {r[-1] for r in want} == {"move", "illegal", "timeout"}


def _moves(spark, folder, limit):
    df = spark.readStream.schema("run_id bigint, ts timestamp, at bigint, event_id bigint, status string").option("recursiveFileLookup", "true").parquet(f"{folder}/in")
    before = spark.conf.get(runs._STORE)
    with runs.state_store(spark):
        out = to_end(runs.run_states(df, limit, "0 seconds"), "append", f"{folder}/work")
    assert spark.conf.get(runs._STORE) == before
    return out
