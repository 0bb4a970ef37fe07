"""Rows that a query and its SQL had different results for."""

from datetime import datetime

import duckdb
import numpy as np
import pytest

from quillgrid.functions import containment
from quillgrid.functions.text import contain_score
from quillgrid.plans.catalogue import ORACLES, QUERIES


@pytest.fixture
def suppliers(spark, tmp_path):
    def save(rows):
        spark.createDataFrame(rows, "s_suppkey bigint, s_nationkey int").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
        return str(tmp_path)

    return save


def test_document_run_corrects_lines_only(spark, suppliers):
    """The common dictionary (77) is the lines'; a key that holds 77, or has more than 16 bits, stays as it is."""
    keys = [77, 100_077, 5_000_000_011]
    rows = QUERIES["document_run"](spark, suppliers([(k, 4) for k in keys])).collect()
    head = {r["id"]: r["text"] for r in rows if r["table_name"] == "t_head" and r["column_name"] == "supplier"}
    assert head == {i: str(k) for i, k in enumerate(keys, 1)}
    lines = sorted((r["id"], r["text"]) for r in rows if r["table_name"] == "t_line" and r["column_name"] == "amount")
    want = [str((k * 7 + n) % 1000).replace("77", "seven") for k in keys for n in range(1, k % 4 + 2)]
    assert lines == list(enumerate(want, 1)) and "seven" not in "".join(head.values())


def test_line_angles_to_a_degree(spark, suppliers):
    """Lines whose commonest voted angle lies half a degree beside theirs."""
    rows = QUERIES["line_angles"](spark, suppliers([(k, 0) for k in (66, 147, 0, 5)])).collect()
    assert {r["s_suppkey"]: r["turn"] for r in rows} == {66: -17.0, 147: -17.0, 0: 40.0, 5: 5.0}


@pytest.mark.parametrize("name", ["update_rows_by_position_total", "segment_merge_lengths_total"])
def test_ties_are_settled(spark, tmp_path, name):
    """Lines that the first queries' SQL leaves without an order: the total one has one result, and the query gives it."""
    days = [datetime(1990, 1, 1 + d) for d in range(28)]
    rows = [(k, 5, k % 3 + 1, 7.0, "RAN"[(i + k) % 3], "FFO"[i * k % 3], None if i == 4 else days[(i * 11 + k) % 28]) for k in range(40) for i in range(9)]
    df = spark.createDataFrame(rows, "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    df.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"SET TimeZone='UTC'; CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    got = QUERIES[name](spark, str(tmp_path))
    want = con.execute(ORACLES[name]).fetchdf()[got.columns]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.itertuples(index=False, name=None)))


def test_all_keys_share_their_passes(monkeypatch):
    """One running sum over a text serves all keys of a block, not one for each; the scores are those of the plain definition."""
    keys = [f"the {i * 7919 % 1000} key text number {i}" for i in range(60)] + ["", "a", None]
    held = containment.Keys(keys)
    calls, plain = [], np.cumsum
    monkeypatch.setattr(np, "cumsum", lambda *a, **k: calls.append(1) or plain(*a, **k))
    for t in ("a text with the key text number 7 and the 919 key text number 1 " * 3, "zz", None, keys[5]):
        calls.clear()
        got = held.scores(t)
        assert len(calls) < 20
        assert got == pytest.approx([contain_score(t, k) for k in keys], abs=1e-12)
