import hashlib

import numpy as np
import pyarrow as pa
import pytest

from quillgrid.llm import repeats
from quillgrid.llm.suffixes import suffix_orders

SCHEMA = "doc_id bigint, text string, chunk bigint, ids string, data int"


def plain(rows, window=50):
    """Every window in a dictionary."""
    rows = [(2**63 if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in rows:
        for s in range(len(b) - window + 1):
            first[b[s : s + window]] = min(i, first.get(b[s : s + window], 2**64))
    for i, b in rows:
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - window + 1):
            if first[b[s : s + window]] < i:
                gone[s : s + window] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        yield (None if i == 2**63 else i, len(b), len(b) - len(kept), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest())


def order(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def check(df):
    got = [tuple(r) for r in repeats.repeats_digest(repeats.without_repeats(df)).collect()]
    assert sorted(got, key=order) == sorted(plain([(r["doc_id"], r["text"]) for r in df.collect()]), key=order)
    return got


@pytest.mark.parametrize("seed", range(30))
def test_suffix_orders(seed):
    rng = np.random.default_rng(seed)
    texts = [rng.integers(0, 1 + seed % 5, n).tolist() for n in rng.integers(0, 60, 25)]
    if seed % 3 == 0:
        texts = [(t[:3] * 30)[: len(t)] for t in texts]
    want, at = [], 0
    for t in texts:
        want += [at + i for i in sorted(range(len(t)), key=lambda i, t=t: t[i:])]
        at += len(t)
    assert suffix_orders(np.array(sum(texts, []), np.int64), np.array([len(t) for t in texts])).tolist() == want


def test_whole_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_odd_rows(spark, odd, empty):
    assert len(check(odd)) == odd.count()
    assert repeats.without_repeats(empty).count() == 0


def mixed(seed):
    """Copies, edited copies, passages in other surroundings, periods, and texts of other alphabets."""
    rng = np.random.default_rng(seed)
    letters = list("abcdeé 😀\n")
    word = lambda: "".join(rng.choice(letters, rng.integers(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    base, passage = text(120), text(25)
    rows = [(1, base), (7, base), (3, base[:200] + "X" + base[200:]), (4, base[50:300]), (9, "ab" * 300), (2, "ab" * 100 + "c" + "ab" * 40), (8, "a" * 700), (5, "b" + "a" * 300), (7, text(40) + passage)]
    rows += [(100 + i, text(int(rng.integers(0, 30))) + passage + text(int(rng.integers(0, 30)))) for i in range(40)]
    rows += [(None, passage), (None, base), (200, base[:30]), (201, base[:30]), (0, passage[: len(passage) // 2] * 3)]
    return [(i, t, 1, "x", 2) for i, t in rows]


def test_mixed_texts(spark):
    got = check(spark.createDataFrame(mixed(1), SCHEMA).repartition(6))
    assert sum(r[2] > 0 for r in got) > 40


def through(rows, buckets=3, per_chunk=5):
    """The three steps without Spark, so that the module's bounds can be set."""
    chunks = []
    for c in range(0, len(rows), per_chunk):
        part = rows[c : c + per_chunk]
        lens = np.array([len((r[1] or "").encode()) for r in part], np.int64)
        data = repeats.padded(b"".join((r[1] or "").encode() for r in part))
        runs, offs = repeats.anchor_runs(data, lens)
        ids = np.array([repeats._NO_ID if r[0] is None else r[0] for r in part], np.int64)
        chunks.append({"chunk": c, "ids": repeats._pack(ids), "lens": repeats._pack(lens), "runs": repeats._pack(runs), "offs": repeats._pack(offs), "data": repeats._pack(data[: int(lens.sum())])})

    def grouped(tables, by):
        table = pa.concat_tables(tables)
        return [(v, table.filter(pa.compute.equal(table[by], v))) for v in sorted(set(table[by].to_pylist()))]

    frames = [pa.Table.from_pylist([c]) for c in chunks]
    sent = [pa.Table.from_batches([b]) for f in frames for b in repeats._send_anchors(buckets)(iter(f.to_batches()))]
    shared = dict(grouped([repeats._answer_anchors(t) for _, t in grouped(sent, "bucket")], "chunk"))
    none = pa.table({"shared": pa.array([], pa.binary()), "hot": pa.array([], pa.binary()), "chunk": pa.array([], pa.int64())})
    pieces = [repeats._send_pieces(buckets)((c["chunk"],), f, shared.get(c["chunk"], none)) for c, f in zip(chunks, frames)]
    least = [r for _, t in grouped(pieces, "bucket") for r in repeats._answer_pieces(t).to_pylist()]
    hot = any(np.any(repeats._unpack(r["hot"], "<u8")) for t in shared.values() for r in t.to_pylist())
    out = []
    for c, f in zip(chunks, frames):
        answers = [{**a, "least": None, "bucket": None} for a in shared.get(c["chunk"], none).to_pylist()] + [{**a, "shared": None, "hot": None} for a in least if a["chunk"] == c["chunk"]]
        empty = pa.table({n: pa.array([], t) for n, t in (("bucket", pa.int64()), ("shared", pa.binary()), ("hot", pa.binary()), ("least", pa.binary()))})
        for r in repeats._cut_out(buckets)((c["chunk"],), f, pa.Table.from_pylist(answers) if answers else empty).to_pylist():
            out.append((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["starts"]), hashlib.sha256(r["kept"]).hexdigest()))
    return out, hot


@pytest.mark.parametrize(("most", "hot", "seed"), [(16, 4096, 2), (2, 4096, 3), (1, 4096, 4), (2, 3, 5), (16, 1, 6)])
def test_crowded_anchors_are_cut_up(monkeypatch, most, hot, seed):
    monkeypatch.setattr(repeats, "GROUP", most)
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = mixed(seed)
    got, was_hot = through(rows)
    assert sorted(got, key=order) == sorted(plain([r[:2] for r in rows]), key=order)
    assert was_hot == (hot < 4096)


def test_smallest_ids_of_windows():
    rng = np.random.default_rng(3)
    last = repeats.SPAN - 1
    base = rng.integers(0, 3, 50 + last).astype(np.uint8)
    for _ in range(20):
        # pieces around one anchor: equal near it, different further away
        rows = []
        for _ in range(60):
            b = base.copy()
            for at in rng.integers(0, base.size, rng.integers(0, 3)):
                if not last <= at < last + repeats.ANCHOR:
                    b[at] = rng.integers(0, 3)
            a = int(rng.integers(0, last + 1))
            z = int(rng.integers(a, last + 1))
            rows.append((b[a : z + 50].tobytes(), z - a + 1, last - a, int(rng.integers(0, 1000))))
        data = repeats.padded(b"".join(r[0] for r in rows))
        size = np.array([len(r[0]) for r in rows])
        n, off, ids = (np.array([r[k] for r in rows]) for k in (1, 2, 3))
        words = repeats.piece_words(data, np.cumsum(size) - size, n)
        one, least, _ = repeats.different(words, n, ids)
        got = repeats.smallest_ids(words[one], n[one], off[one], np.zeros(one.size, bool), least)
        found = {}
        for (raw, many, _, _), i in zip(rows, ids):
            for s in range(many):
                found[raw[s : s + 50]] = min(found.get(raw[s : s + 50], 9999), i)
        want = [found[rows[k][0][s : s + 50]] for k in one for s in range(rows[k][1])]
        assert got.tolist() == want


def test_single_pieces_are_not_ordered(monkeypatch):
    """Copies are one piece of their anchor, which no order can tell anything; only pieces that differ are ordered."""
    texts = []

    def counted(codes, lengths):
        texts.append(lengths.size)
        return suffix_orders(codes, lengths)

    monkeypatch.setattr(repeats, "suffix_orders", counted)
    rng = np.random.default_rng(5)
    some = ["".join(rng.choice(list("abcdefgh "), 300)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(some * 3)]
    assert sorted(through(rows)[0]) == sorted(plain(rows)) and not texts
    rows += [(100, some[0][:150] + "X" + some[0][151:]), (101, "ab" * 120), (102, "a" * 200)]
    assert sorted(through(rows)[0]) == sorted(plain(rows)) and texts
