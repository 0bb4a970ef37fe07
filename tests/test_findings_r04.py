"""The findings of round 4."""

import random
from datetime import datetime
from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from quillgrid.functions import containment
from quillgrid.functions.text import contain_score
from quillgrid.plans.catalogue import ORACLES, QUERIES


def test_texts_share_their_passes(monkeypatch):
    """Short texts are scored together: one running sum serves several texts and several keys."""
    keys = [f"the {i * 7919 % 1000} key text number {i}" for i in range(20)]
    texts = [f"a text with the key text number {i % 30} and more" for i in range(200)] + [None, ""]
    calls, plain = [], np.cumsum
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    monkeypatch.setattr(np, "cumsum", lambda *a, **k: calls.append(1) or plain(*a, **k))
    out = pa.Table.from_batches(containment._score(SimpleNamespace(value=(list(range(20)), keys)))([batch])).to_pydict()
    assert len(calls) < len(texts)
    assert list(zip(out["doc_id"], out["item_id"])) == [(d, i) for d in range(len(texts)) for i in range(20)]
    assert out["score"] == pytest.approx([contain_score(t, k) for t in texts for k in keys], abs=1e-12)


@pytest.mark.parametrize("cells", [1, 400, 4_000_000])
@pytest.mark.parametrize("tile", [7, 100, 32_768])
@pytest.mark.parametrize("codes", [4, 1 << 22])
def test_many_texts_are_scored_as_each_alone(monkeypatch, cells, tile, codes):
    """Whatever is held as a table or list, wherever the texts are cut; copies that overlap, at any size, count once."""
    for name, value in (("CELLS", cells), ("TILE", tile), ("CODES", codes)):
        monkeypatch.setattr(containment, name, value)
    rng = random.Random(f"{cells} {tile} {codes}")
    for chars in ("a", "ab", "abc ", "abcdefgh é😀"):
        word = lambda n: "".join(rng.choice(chars) for _ in range(n))
        keys = [word(n) for n in (1, 2, 3, 4, 5, 8, 16, 31, 32, 33, 70)] + [None, "", "abababababab"]
        texts = [None, "", " ", "a" * 90, "ab" * 60, "aab" * 40, keys[8] + "zz" + keys[8] * 3, keys[10], *(word(rng.randrange(150)) for _ in range(12))]
        got = containment.Keys(keys).many(texts)
        assert got.ravel().tolist() == pytest.approx([contain_score(t, k) for t in texts for k in keys], abs=1e-12)


@pytest.mark.parametrize("name", ["segment_merge_lengths", "update_rows_by_position"])
def test_missing_values_come_last(spark, tmp_path, name):
    """Lines without a number, part or quantity, and none alike: their place is the one that the SQL gives them."""
    lines = [(1, 5, 7.0), (1, None, None), (3, 6, 2.0), (None, 2, 4.0), (3, 4, 8.0), (5, None, None), (5, 9, 1.0)]
    rows = [(k, p, n, q if k % 3 else None if i == 4 else q, "AN"[(i + k) % 2], "F", datetime(1995, 1, 1 + i + k)) for k in range(6) for i, (n, p, q) in enumerate(lines)]
    df = spark.createDataFrame(rows, "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    df.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"SET TimeZone='UTC'; CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    got = QUERIES[name](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
