"""Layout classifiers that Spark's library doesn't have: extremely randomised trees, exact nearest neighbours, linear discriminants, Gaussian Bayes; each with means for
missing values and a flag for what was missing.

Discriminants and Bayes are fitted by sums over all rows. Trees and neighbours learn from at most MOST_ROWS rows, which every task gets; more are an error, not a cut.
A model is a small dictionary of lists: it is saved as JSON, and an older file of its name is moved into a folder of the day.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.sources.page_source import place

#: Rows that trees and neighbours learn from: training sets have hundreds of images per class.
MOST_ROWS = 100_000
#: Cells (query, example) of distances at once.
CELLS = 1 << 22
#: Share of the largest variance that is added to every variance in Bayes.
SMOOTH = 1e-9


def _value(c: str):
    x = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(x), x)  # null and NaN are missing


def fit_filling(rows: DataFrame, features: Sequence[str]) -> dict:
    """The mean of each feature, and the features that have missing values (each becomes a flag). A feature without any value is 0."""
    r = rows.agg(*(F.avg(_value(c)).alias(f"m{i}") for i, c in enumerate(features)), *(F.count_if(_value(c).isNull()).alias(f"n{i}") for i, c in enumerate(features))).first()
    return {"features": list(features), "means": [r[f"m{i}"] or 0.0 for i in range(len(features))], "flags": [i for i in range(len(features)) if r[f"n{i}"]]}


def filled(rows: DataFrame, filling: dict, name: str = "_x") -> DataFrame:
    """Adds the feature vector: values with means for missing ones, then the flags."""
    values = [F.coalesce(_value(c), F.lit(float(m))) for c, m in zip(filling["features"], filling["means"])]
    flags = [_value(filling["features"][i]).isNull().cast("double") for i in filling["flags"]]
    return rows.withColumn(name, F.array(*values, *flags))


def _matrix(rows: DataFrame, label: str) -> tuple[np.ndarray, np.ndarray]:
    """All feature vectors and labels, in the order of the vectors, so that a model doesn't depend on the order of rows."""
    some = rows.select("_x", F.col(label).cast("int").alias("y")).where("y IS NOT NULL").limit(MOST_ROWS + 1).toArrow()
    if some.num_rows > MOST_ROWS:
        raise ValueError(f"more than {MOST_ROWS} rows to learn from")
    y = some["y"].to_numpy().astype(np.int64)
    width = len(some["_x"][0]) if y.size else 0
    x = np.array(some["_x"].combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(y.size, width)
    order = np.lexsort((*x.T[::-1], y)) if y.size else np.arange(0)
    return x[order], y[order]


# linear discriminants and Bayes: sums over all rows


def fit_sums(rows: DataFrame, label: str, width: int) -> dict:
    """Rows, sums and products of the features per class: classes times width squared numbers, however many rows there are."""
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    y = F.col(label).cast("int")
    out = rows.where(y.isNotNull()).groupBy(y.alias("y")).agg(
        F.count("*").alias("n"), F.array(*(F.sum(F.col("_x")[i]) for i in range(width))).alias("s"), F.array(*(F.sum(F.col("_x")[i] * F.col("_x")[j]) for i, j in pairs)).alias("p")
    )
    found = {}
    for r in sorted(out.collect(), key=lambda r: r["y"]):
        products = np.zeros((width, width))
        for (i, j), v in zip(pairs, r["p"]):
            products[i, j] = products[j, i] = v
        found[r["y"]] = (r["n"], np.array(r["s"]), products)
    return found


def fit_discriminants(sums: dict) -> dict:
    """Weights and offset of each class from the common covariance within classes. Directions without variance count for nothing."""
    n = sum(s[0] for s in sums.values())
    means = {y: s / c for y, (c, s, _) in sums.items()}
    within = sum(p - c * np.outer(means[y], means[y]) for y, (c, _, p) in sums.items()) / max(n - len(sums), 1)
    scale = np.sqrt(np.maximum(np.diag(within), 0))
    scale = np.where(scale > 1e-9 * max(scale.max(), 1e-300), scale, 1.0)
    inverse = np.linalg.pinv(within / np.outer(scale, scale), rcond=1e-9, hermitian=True) / np.outer(scale, scale)
    weights = {y: inverse @ m for y, m in means.items()}
    return {"kind": "lda", "classes": list(sums), "weights": [weights[y].tolist() for y in sums], "offsets": [float(-0.5 * means[y] @ weights[y] + np.log(sums[y][0] / n)) for y in sums]}


def fit_bayes(sums: dict) -> dict:
    """Mean and variance of each feature per class, variances raised by a share of the greatest one over all rows."""
    n = sum(s[0] for s in sums.values())
    total, squares = sum(s[1] for s in sums.values()), sum(np.diag(s[2]) for s in sums.values())
    extra = SMOOTH * float(np.maximum(squares / n - (total / n) ** 2, 0).max())
    means = [s / c for c, s, _ in sums.values()]
    variances = [np.maximum(np.diag(p) / c - m**2, 0) + max(extra, 1e-300) for (c, _, p), m in zip(sums.values(), means)]
    return {"kind": "bayes", "classes": list(sums), "means": [m.tolist() for m in means], "variances": [v.tolist() for v in variances], "priors": [float(np.log(s[0] / n)) for s in sums.values()]}


# extremely randomised trees


def grow(x: np.ndarray, y: np.ndarray, classes: int, rng: np.random.Generator, tries: int) -> dict:
    """One tree down to pure leaves: at each node, of `tries` features that vary, each cut at a random place between its least and greatest value, the best by Gini impurity."""
    feature, cut, left, right, share = [], [], [], [], []
    todo = [(np.arange(y.size), -1, False)]
    while todo:
        rows, parent, is_right = todo.pop()
        node = len(feature)
        if parent >= 0:
            (right if is_right else left)[parent] = node
        count = np.bincount(y[rows], minlength=classes)
        feature.append(-1), cut.append(0.0), left.append(-1), right.append(-1), share.append((count / max(count.sum(), 1)).tolist())
        if (count > 0).sum() < 2:
            continue
        low, high = x[rows].min(0), x[rows].max(0)
        vary = np.nonzero(high > low)[0]
        if not vary.size:
            continue
        best = None
        for f in rng.permutation(vary)[:tries]:
            at = rng.uniform(low[f], high[f])
            goes = x[rows, f] <= at
            a = np.bincount(y[rows[goes]], minlength=classes)
            b = count - a
            if not a.sum() or not b.sum():
                continue
            gini = a.sum() - (a**2).sum() / a.sum() + b.sum() - (b**2).sum() / b.sum()
            if best is None or gini < best[0] - 1e-9:  # of equal ones the first
                best = gini, f, at, goes
        if best is None:
            continue
        feature[node], cut[node] = int(best[1]), float(best[2])
        todo += [(rows[~best[3]], node, True), (rows[best[3]], node, False)]
    return {"feature": feature, "cut": cut, "left": left, "right": right, "share": share}


def fit_trees(rows: DataFrame, label: str, trees: int = 100, seed: int = 123) -> dict:
    """A forest of extremely randomised trees on all rows, one tree per task row; a tree's random numbers come from the seed and its number."""
    spark = rows.sparkSession
    x, y = _matrix(rows, label)
    classes, codes = np.unique(y, return_inverse=True)
    given = spark.sparkContext.broadcast((x, codes))
    tries, kinds = max(1, int(np.sqrt(x.shape[1]))) if y.size else 1, max(int(classes.size), 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, codes = given.value
        for b in batches:
            made = [json.dumps(grow(x, codes, kinds, np.random.default_rng([seed, int(t)]), tries)) for t in b["id"]]
            yield pd.DataFrame({"id": b["id"], "tree": made})

    grown = spark.range(0, trees, 1, min(trees, spark.sparkContext.defaultParallelism)).mapInPandas(run, "id bigint, tree string")
    return {"kind": "trees", "classes": classes.tolist(), "trees": [json.loads(r["tree"]) for r in sorted(grown.collect(), key=lambda r: r["id"])]}


def tree_shares(x: np.ndarray, tree: dict) -> np.ndarray:
    feature, cut, left, right = (np.array(tree[k]) for k in ("feature", "cut", "left", "right"))
    at = np.zeros(len(x), np.int64)
    while True:
        inner = np.nonzero(feature[at] >= 0)[0]
        if not inner.size:
            return np.array(tree["share"])[at]
        f = feature[at[inner]]
        at[inner] = np.where(x[inner, f] <= cut[at[inner]], left[at[inner]], right[at[inner]])


def fit_neighbours(rows: DataFrame, label: str, k: int = 5) -> dict:
    x, y = _matrix(rows, label)
    return {"kind": "neighbours", "classes": np.unique(y).tolist(), "x": x.tolist(), "y": y.tolist(), "k": k}


def neighbour_shares(x: np.ndarray, model: dict) -> np.ndarray:
    """Shares of the classes among each row's k nearest examples; examples in blocks, the nearest so far kept; ties go to the earlier example."""
    have, labels = np.array(model["x"]), np.searchsorted(model["classes"], model["y"])
    k = min(model["k"], len(have))
    out = np.zeros((len(x), len(model["classes"])))
    step = max(1, CELLS // max(len(have), 1))
    for a in range(0, len(x), step):
        part = x[a : a + step]
        best, which = np.full((len(part), k), np.inf), np.full((len(part), k), -1)
        block = max(k, CELLS // len(part))
        for b in range(0, len(have), block):
            some = have[b : b + block]
            d = np.zeros((len(part), len(some)))
            for f in range(x.shape[1]):  # no product of rows by rows by features
                d += (part[:, f, None] - some[None, :, f]) ** 2
            d, n = np.concatenate([best, d], 1), np.concatenate([which, np.broadcast_to(np.arange(b, b + len(some)), (len(part), len(some)))], 1)
            order = np.argsort(d, axis=1, kind="stable")[:, :k]
            best, which = np.take_along_axis(d, order, 1), np.take_along_axis(n, order, 1)
        for j in range(k):
            np.add.at(out[a : a + step], (np.arange(len(part)), labels[which[:, j]]), 1 / k)
    return out


def shares(x: np.ndarray, model: dict) -> np.ndarray:
    """The probability of every class for each row."""
    kind = model["kind"]
    if kind == "trees":
        return np.mean([tree_shares(x, t) for t in model["trees"]], axis=0)
    if kind == "neighbours":
        return neighbour_shares(x, model)
    if kind == "lda":
        logits = x @ np.array(model["weights"]).T + np.array(model["offsets"])
    else:
        m, v = np.array(model["means"]), np.array(model["variances"])
        logits = np.array(model["priors"]) - 0.5 * (np.log(2 * np.pi * v).sum(1) + (((x[:, None] - m) ** 2) / v).sum(2))
    logits -= logits.max(1, keepdims=True)
    e = np.exp(logits)
    return e / e.sum(1, keepdims=True)


def train(rows: DataFrame, features: Sequence[str], label: str, kind: str, **options) -> dict:
    """A model of one of the kinds lda, bayes, trees, neighbours. Rows without a label aren't learned from; without any labelled row it is an error."""
    filling = fit_filling(rows, features)
    ready = filled(rows, filling)
    width = len(features) + len(filling["flags"])
    if kind in ("lda", "bayes"):
        sums = fit_sums(ready, label, width)
        if not sums:
            raise ValueError("no labelled rows")
        model = (fit_discriminants if kind == "lda" else fit_bayes)(sums)
    else:
        model = {"trees": fit_trees, "neighbours": fit_neighbours}[kind](ready, label, **options)
        if not model["classes"]:
            raise ValueError("no labelled rows")
    return {**model, "filling": filling}


def predict(rows: DataFrame, models: dict[object, dict], by: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """keep, pred (the class with the greatest probability, ties: the least class) and confidence (that probability).

    models: by the value of column `by`, or one under None. Rows whose model isn't there have null. One pass over the rows, whatever the number of models.
    """
    spark = rows.sparkSession
    given = spark.sparkContext.broadcast(models)
    names = sorted({c for m in models.values() for c in m["filling"]["features"]})
    schema = ", ".join([*(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keep), "pred int, confidence double"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            pred, sure = pd.Series(pd.NA, b.index, dtype="Int32"), pd.Series(np.nan, b.index)
            for value, some in [(None, b)] if by is None else list(b.groupby("_by", dropna=True)):
                model = given.value.get(value)
                if model is None or some.empty:
                    continue
                f = model["filling"]
                raw = some[[f"_f{names.index(c)}" for c in f["features"]]].to_numpy(dtype=float)
                missing = np.isnan(raw)
                p = shares(np.hstack([np.where(missing, f["means"], raw), missing[:, f["flags"]].astype(float)]), model)
                pred[some.index] = np.array(model["classes"])[p.argmax(1)]
                sure[some.index] = p.max(1)
            yield b[list(keep)].assign(pred=pred, confidence=sure.where(sure.notna(), None))

    asked = rows.select(*keep, *([F.col(by).alias("_by")] if by is not None else []), *(F.col(f"`{c}`").cast("double").alias(f"_f{i}") for i, c in enumerate(names)))
    return asked.mapInPandas(run, schema)


def save(model: dict, folder: str, name: str, day: datetime.date | None = None) -> str:
    """Writes folder/name.json. What was there moves to folder/YYYYMMDD/name.json, or YYYYMMDD_1, _2 ... where that is taken."""
    system, root = place(folder)
    system.create_dir(root, recursive=True)
    path, first = f"{root}/{name}.json", (day or datetime.date.today()).strftime("%Y%m%d")
    if system.get_file_info(path).type != fs.FileType.NotFound:
        kept, n = first, 0
        while system.get_file_info(f"{root}/{kept}/{name}.json").type != fs.FileType.NotFound:
            n += 1
            kept = f"{first}_{n}"
        system.create_dir(f"{root}/{kept}", recursive=True)
        system.move(path, f"{root}/{kept}/{name}.json")
    with system.open_output_stream(f"{root}/.{name}.json") as stream:
        stream.write(json.dumps(model).encode())
    system.move(f"{root}/.{name}.json", path)
    return path


def load(folder: str, name: str) -> dict:
    system, root = place(folder)
    with system.open_input_file(f"{root}/{name}.json") as stream:
        return json.loads(stream.read())


def classify_layouts(pages: DataFrame, models: dict[str, dict], texts: dict[str, str], key: str = "page_id", text: str = "text", weight: float = 0.9) -> DataFrame:
    """key, layout_id, pred, ai_confidence, str_confidence, confidence of every page under every layout's model.

    pages: one row per page and layout (key, layout_id, the features, `text`: what stands in the layout's fixed block). Where the model says 1, the text is held against
    the layout's own, and the confidence is the blend of both; else it is the model's. Pages times layouts rows, as many as pages has.
    """
    from quillgrid.functions.boxes import blend
    from quillgrid.functions.text import contain_check

    told = predict(pages, models, "layout_id", [key, "layout_id", text])
    fixed = F.create_map(*(F.lit(x) for kv in texts.items() for x in kv)) if texts else F.lit(None).cast("map<string,string>")
    told = told.withColumn("_fixed", F.when(F.col("pred") == 1, F.coalesce(F.try_element_at(fixed, F.col("layout_id")), F.lit(""))))
    scored = told.withColumn("_s", F.when(F.col("pred") == 1, contain_check(F.col(text), F.col("_fixed"))))
    return scored.select(key, "layout_id", "pred", F.col("confidence").alias("ai_confidence"), F.col("_s").alias("str_confidence"), blend(F.col("confidence"), F.col("_s"), weight).alias("confidence"))
