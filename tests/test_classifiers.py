"""Each classifier against a plain version on the same rows."""

import datetime
import json

import numpy as np
import pytest

from quillgrid.functions.text import contain_score
from quillgrid.operators import classifiers as C

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    y = rng.integers(0, 3, 300)
    x = rng.normal(size=(300, 3)) + np.stack([y * 1.5, -y, np.zeros(300)], 1)
    x[rng.random((300, 3)) < 0.1] = np.nan
    x[:, 2] = np.where(np.isnan(x[:, 2]), 0.5, x[:, 2])  # c is never missing
    rows = [(i, *(None if np.isnan(v) and i % 2 else float(v) for v in x[i]), int(y[i]) if i < 200 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, y int")
    return df.repartition(5), x, y


def ready(x):
    """Means for what is missing, and flags of the features that have missing values."""
    means = np.nanmean(x, 0)
    return np.hstack([np.where(np.isnan(x), means, x), np.isnan(x)[:, [0, 1]]])


def told(df, model):
    return {r["id"]: (r["pred"], r["confidence"]) for r in C.predict(df, {None: model}, keep=["id"]).collect()}


def check(df, model, want):
    got = told(df, model)
    for i, p in enumerate(want):
        assert got[i][0] == p.argmax() and np.isclose(got[i][1], p.max(), atol=1e-6), (i, got[i], p)


def test_filling(data):
    df, x, _ = data
    f = C.fit_filling(df, NAMES)
    assert np.allclose(f["means"], np.nanmean(x, 0)) and f["flags"] == [0, 1]


def test_discriminants(data):
    df, x, y = data
    z = ready(x)
    model = C.train(df, NAMES, "y", "lda")
    learn, t = z[:200], y[:200]
    means = np.stack([learn[t == k].mean(0) for k in range(3)])
    within = sum((learn[t == k] - means[k]).T @ (learn[t == k] - means[k]) for k in range(3)) / (200 - 3)
    inverse = np.linalg.inv(within)
    logits = z @ inverse @ means.T - 0.5 * np.einsum("ki,ij,kj->k", means, inverse, means) + np.log(np.bincount(t) / 200)
    e = np.exp(logits - logits.max(1, keepdims=True))
    check(df, model, e / e.sum(1, keepdims=True))


def test_bayes(data):
    df, x, y = data
    z = ready(x)
    learn, t = z[:200], y[:200]
    p = np.zeros((300, 3))
    for k in range(3):
        m, v = learn[t == k].mean(0), learn[t == k].var(0) + 1e-9 * learn.var(0).max()
        p[:, k] = np.log((t == k).mean()) - 0.5 * np.sum(np.log(2 * np.pi * v) + (z - m) ** 2 / v, 1)
    e = np.exp(p - p.max(1, keepdims=True))
    check(df, C.train(df, NAMES, "y", "bayes"), e / e.sum(1, keepdims=True))


@pytest.mark.parametrize("cells", [1 << 22, 64])
def test_neighbours(data, monkeypatch, cells):
    df, x, y = data
    model = C.train(df, NAMES, "y", "neighbours", k=5)
    z = ready(x)
    have, t = np.array(model["x"]), np.array(model["y"])
    assert sorted(map(tuple, have.round(9))) == sorted(map(tuple, z[:200].round(9)))
    monkeypatch.setattr(C, "CELLS", cells)
    got = C.shares(z, model)
    for i in range(300):
        near = np.argsort(((have - z[i]) ** 2).sum(1), kind="stable")[:5]
        assert np.allclose(got[i], np.bincount(t[near], minlength=3) / 5)


def plain_tree(x, y, classes, rng, tries, rows=None):
    """The same tree by recursion."""
    rows = np.arange(len(y)) if rows is None else rows
    count = np.bincount(y[rows], minlength=classes)
    vary = [f for f in range(x.shape[1]) if x[rows, f].max() > x[rows, f].min()]
    best = None
    if (count > 0).sum() > 1 and vary:
        for f in rng.permutation(np.array(vary))[:tries]:
            at = rng.uniform(x[rows, f].min(), x[rows, f].max())
            parts = [rows[x[rows, f] <= at], rows[x[rows, f] > at]]
            if all(len(p) for p in parts):
                gini = sum(len(p) - (np.bincount(y[p], minlength=classes) ** 2).sum() / len(p) for p in parts)
                if best is None or gini < best[0] - 1e-9:
                    best = gini, f, at, parts
    if best is None:
        return count / count.sum()
    return best[1], best[2], plain_tree(x, y, classes, rng, tries, best[3][0]), plain_tree(x, y, classes, rng, tries, best[3][1])


def walk(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def test_trees(data):
    df, x, y = data
    model = C.train(df, NAMES, "y", "trees", trees=7, seed=5)
    z = ready(x)
    learn = z[:200]
    order = np.lexsort((*learn.T[::-1], y[:200]))
    forest = [plain_tree(learn[order], y[:200][order], 3, np.random.default_rng([5, k]), 2) for k in range(7)]
    want = np.array([np.mean([walk(t, row) for t in forest], axis=0) for row in z])
    assert np.allclose(C.shares(z, model), want)
    assert (C.shares(learn, model).argmax(1) == y[:200]).all()  # leaves are pure
    again = C.train(df.coalesce(1), NAMES, "y", "trees", trees=7, seed=5)
    for one, two in zip(again["trees"], model["trees"]):
        assert one["feature"] == two["feature"] and one["share"] == two["share"] and np.allclose(one["cut"], two["cut"])


def test_one_value_one_class_and_none(spark):
    df = spark.createDataFrame([(1, 2.0, 0), (2, 2.0, 0), (3, None, 0)], "id int, a double, y int")
    for kind in ("lda", "bayes", "trees", "neighbours"):
        got = told(df, C.train(df, ["a"], "y", kind))
        assert {p for p, _ in got.values()} == {0} and all(np.isclose(s, 1) for _, s in got.values())
        with pytest.raises(ValueError, match="no labelled rows"):
            C.train(df.where("false"), ["a"], "y", kind)


def test_too_many_rows_are_an_error(data, monkeypatch):
    monkeypatch.setattr(C, "MOST_ROWS", 50)
    with pytest.raises(ValueError, match="more than 50"):
        C.train(data[0], NAMES, "y", "neighbours")


def test_models_are_kept_by_day(tmp_path):
    day = datetime.date(2024, 5, 6)
    for n in range(4):
        C.save({"n": n}, str(tmp_path), "model", day)
    assert C.load(str(tmp_path), "model") == {"n": 3}
    assert [json.loads((tmp_path / d / "model.json").read_text())["n"] for d in ("20240506", "20240506_1", "20240506_2")] == [0, 1, 2]


def test_layouts(spark, data):
    df, x, y = data
    z = df.selectExpr("id", "a", "b", "c", "CASE WHEN y = 2 THEN 1 WHEN y IS NOT NULL THEN 0 END AS y")
    models = {"l1": C.train(z, NAMES, "y", "lda"), "l2": C.train(z.selectExpr("*", "1 - y AS n"), NAMES, "n", "bayes")}
    pages = df.selectExpr("id AS page_id", "a", "b", "c", "explode(array('l1', 'l2', 'l3')) AS layout_id", "IF(id % 2 = 0, 'build ing ledger', 'other') AS text")
    texts = {"l1": "building ledger", "l2": "other"}
    got = C.classify_layouts(pages, models, texts).collect()
    assert len(got) == 900
    for r in got:
        if r["layout_id"] == "l3":
            assert r["pred"] is None and r["confidence"] is None
        elif r["pred"] == 1:
            s = contain_score("build ing ledger" if r["page_id"] % 2 == 0 else "other", texts[r["layout_id"]])
            assert np.isclose(r["confidence"], 0.9 * r["ai_confidence"] + 0.1 * s)
        else:
            assert r["confidence"] == r["ai_confidence"] and r["str_confidence"] is None
