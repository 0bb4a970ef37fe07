"""Queries without SQL against plain loops over their whole tables."""

import hashlib

import numpy as np

import __spark_entry__
from quillgrid.functions.text import contain_score

SF = "/root/testdata/sf0.001"


def query(spark, name):
    return __spark_entry__.queries()[name](spark, SF)


def test_contain_scores(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    rows = query(spark, "contain_check_score")
    columns = rows.columns
    got = rows.collect()
    assert len(got) == len(docs) * len(items)
    short = {i for i, t in docs.items() if len(t or "") < 600}
    assert len(short) > 20
    for r in got:
        d, i = r["doc_id"], r["item_id"]
        if d in short:
            value = next(r[c] for c in columns if c not in ("doc_id", "item_id"))
            assert abs(value - contain_score(docs[d], items[i])) < 1e-6


def plain_page(k):
    """The drawn page, scaled to fit 48 x 40 in the middle of white, cut at 127, trimmed to its ink with two pixels around: pixel by pixel."""
    page = [[0 if (y * 32 + x + k) % 7 == 0 else 255 for x in range(32)] for y in range(32)]
    ratio = min(48 / 32, 40 / 32)
    w = h = round(32 * ratio)
    out = [[255] * 48 for _ in range(40)]

    def place(i):
        v = min(max((i + 0.5) * 32 / w - 0.5, 0), 31)
        return int(v), min(int(v) + 1, 31), v - int(v)

    for y in range(h):
        y0, y1, fy = place(y)
        for x in range(w):
            x0, x1, fx = place(x)
            top, low = page[y0][x0] * (1 - fx) + page[y0][x1] * fx, page[y1][x0] * (1 - fx) + page[y1][x1] * fx
            out[(40 - h) // 2 + y][(48 - w) // 2 + x] = int(np.rint(top * (1 - fy) + low * fy))
    dark = [[0 if v <= 127 else 255 for v in row] for row in out]
    ys, xs = [y for y in range(40) if 0 in dark[y]], [x for x in range(48) if any(row[x] == 0 for row in dark)]
    if not ys:
        return dark
    return [row[max(xs[0] - 2, 0) : xs[-1] + 3] for row in dark[max(ys[0] - 2, 0) : ys[-1] + 3]]


def test_image_steps(spark):
    got = query(spark, "image_steps").collect()
    assert len(got) == spark.read.parquet(f"{SF}/embeddings.parquet").count()
    plain = {}
    for r in got:
        k = r["vec_id"] % 7
        if k not in plain:
            page = plain_page(r["vec_id"])
            plain[k] = (len(page), len(page[0]), hashlib.md5(bytes(v for row in page for v in row)).hexdigest())
        assert (r["height"], r["width"], r["digest"]) == plain[k]


def test_classified_vectors(spark):
    """Held-out vectors: each once, with the class that most of the tree's leaf has, better than guessing, and the same in a second run."""
    one, two = query(spark, "spark_ml_classify").collect(), query(spark, "spark_ml_classify").collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))
    y = {r["vec_id"]: r["label"] % 2 for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    assert len({r["vec_id"] for r in one}) == len(one) and all(r["y"] == y[r["vec_id"]] for r in one) and 0.2 < len(one) / len(y) < 0.4
    assert all(0.5 <= r["confidence"] <= 1 and r["pred"] in (0, 1) for r in one)
    assert sum(r["pred"] == r["y"] for r in one) > 0.5 * len(one)
