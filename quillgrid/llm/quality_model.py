"""Quality by attention-based multiple-instance learning.

A text is a bag of passages of 64 words. Every passage is encoded: its byte classes, byte pairs (hashed) and word statistics go
through one tanh layer. Gated attention weighs the passages, and the weighted sum is the document's representation, of which a logistic
output makes the score. Only documents are labelled; the attention is learned from those labels by gradient descent on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.llm.common import fold, small_batches
from quillgrid.llm.scan import parts, scan
from quillgrid.llm.toxicity import sample_labelled

PASSAGE, PAIRS, HIDDEN, GATE = 64, 64, 24, 12
#: Documents per class, passages that are learned from of each (evenly from the whole text where it has more), passes over them, documents per step.
EXAMPLES, PASSAGES, EPOCHS, STEP = 1500, 128, 25, 64
THRESHOLD = 0.7
SCHEMA = "doc_id bigint, score double, predicted int, passages int, attention_at int"

_CLASS = np.full(256, 9, np.int64)
for _k, _set in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", bytes(range(128, 256)), b" ", b"\n", b".,", b"#*$%&|<>", b"!?;:'\"()-/@_")):
    _CLASS[[*_set]] = _k
CLASSES = 10
STATS = 8
WIDTH = CLASSES + PAIRS + STATS


def encode_passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the first passage of each text (and their number). A text without words is one passage of zeros."""
    w = scan(texts, lower=False)
    n_words = np.diff(w.first)
    n_passages = np.maximum(-(-n_words // PASSAGE), 1)
    first = np.concatenate([[0], np.cumsum(n_passages)])
    total = int(first[-1])
    x = np.zeros((total, WIDTH), np.float32)
    if not w.starts.size:
        return x, first
    rank = np.arange(w.starts.size) - np.repeat(w.first[:-1], n_words)
    passage = first[w.doc] + rank // PASSAGE
    # bytes belong to the passage of the word at or before them
    head = np.nonzero(np.diff(passage, prepend=-1))[0]
    spans = np.diff(np.append(w.starts[head], w.data.size))
    of_byte = np.repeat(passage[head], spans)
    data = w.data[w.starts[0] :]
    # but not those of the next text, before its first word: a score must not depend on what else is in the batch
    text = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])[w.starts[0] :]
    own = text == np.repeat(np.arange(len(texts)), n_passages)[of_byte]
    classes = np.bincount(of_byte[own] * CLASSES + _CLASS[data[own]], minlength=total * CLASSES).reshape(total, CLASSES)
    both = own[:-1] & (text[1:] == text[:-1])
    code = (data[:-1].astype(np.uint32) * 263 + data[1:].astype(np.uint32) * 5) * np.uint32(2654435761) >> np.uint32(26)
    pairs = np.bincount(of_byte[:-1][both] * PAIRS + code[both], minlength=total * PAIRS).reshape(total, PAIRS)
    x[:, :CLASSES] = np.sqrt(classes / np.maximum(classes.sum(axis=1, keepdims=True), 1))
    x[:, CLASSES : CLASSES + PAIRS] = np.sqrt(pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1))
    count = np.bincount(passage, minlength=total).astype(np.float64)
    each = np.maximum(count, 1)
    lens = (w.ends - w.starts).astype(np.float64)
    mean = np.bincount(passage, weights=lens, minlength=total) / each
    spread = np.sqrt(np.maximum(np.bincount(passage, weights=lens**2, minlength=total) / each - mean**2, 0))
    h = w.hashes()
    again = np.zeros(h.size, bool)
    order = np.lexsort((h, passage))
    again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (passage[order[1:]] == passage[order[:-1]])
    next_same = np.concatenate([[False], (h[1:] == h[:-1]) & (passage[1:] == passage[:-1])])
    share = lambda flag: np.bincount(passage, weights=flag, minlength=total) / each
    upper = (w.data[w.starts] >= 65) & (w.data[w.starts] <= 90)
    symbol = _CLASS[w.data[w.ends - 1]] == 7
    x[:, CLASSES + PAIRS :] = np.stack([np.log1p(mean), np.log1p(spread), share(again), share(next_same), share(upper), share(symbol), share(lens == 1), np.log1p(count)], axis=1)
    return x, first


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in parts(batches):
        x, first = encode_passages(texts)
        rows = [x[np.unique(np.linspace(a, b - 1, min(b - a, PASSAGES)).astype(np.int64))].tobytes() for a, b in zip(first[:-1], first[1:])]
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(rows, pa.binary())], names=["doc_id", "label", "x"])


class AttentionModel:
    """Gated attention pooling: e = tanh(xW + b), a = softmax((tanh(eV) * sigmoid(eU)) w), score = sigmoid((sum a e) c + d)."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 7):
        rng = np.random.Generator(np.random.PCG64(seed))
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float64)
        self.mean, self.scale = mean, scale
        self.p = {"W": draw(WIDTH, HIDDEN), "b": np.zeros(HIDDEN), "V": draw(HIDDEN, GATE), "U": draw(HIDDEN, GATE), "w": draw(GATE, 1)[:, 0], "c": draw(HIDDEN, 1)[:, 0], "d": np.zeros(1)}

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, np.diff(first)
        x = (x - self.mean) / self.scale
        e = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(e @ p["V"]), 1 / (1 + np.exp(-(e @ p["U"])))
        s = (t * g) @ p["w"]
        doc = np.repeat(np.arange(n.size), n)
        a = np.exp(s - np.maximum.reduceat(s, first[:-1])[doc])
        a /= np.add.reduceat(a, first[:-1])[doc]
        z = np.add.reduceat(a[:, None] * e, first[:-1], axis=0)
        return {"x": x, "e": e, "t": t, "g": g, "a": a, "z": z, "doc": doc, "score": 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))}

    def gradients(self, f: dict[str, np.ndarray], first: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p, e, t, g, a, doc = self.p, f["e"], f["t"], f["g"], f["a"], f["doc"]
        out = (f["score"] - y) * weight / max(weight.sum(), 1e-9)
        dz = out[:, None] * p["c"]
        da = (dz[doc] * e).sum(axis=1)
        ds = a * (da - np.add.reduceat(a * da, first[:-1])[doc])
        dh = ds[:, None] * p["w"]
        dt, dg = dh * g * (1 - t**2), dh * t * g * (1 - g)
        de = (a[:, None] * dz[doc] + dt @ p["V"].T + dg @ p["U"].T) * (1 - e**2)
        return {"W": f["x"].T @ de, "b": de.sum(axis=0), "V": e.T @ dt, "U": e.T @ dg, "w": (t * g).T @ ds, "c": f["z"].T @ out, "d": np.array([out.sum()])}

    def train(self, bags: list[np.ndarray], y: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, decay: float = 1e-4) -> None:
        rng = np.random.Generator(np.random.PCG64(11))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step, total = 0, max(1, epochs * -(-len(bags) // STEP))
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(bags), STEP):
                pick = order[at : at + STEP]
                first = np.concatenate([[0], np.cumsum([len(bags[i]) for i in pick])])
                f = self.forward(np.concatenate([bags[i] for i in pick]), first)
                step += 1
                lr = rate * (1 - step / (total + 1)) + 1e-5
                for k, grad in self.gradients(f, first, y[pick], weight[pick]).items():
                    grad = grad + decay * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v[k] = 0.999 * v[k] + 0.001 * grad**2
                    self.p[k] = self.p[k] - lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", examples: int = EXAMPLES) -> AttentionModel:
    """Learns from at most `examples` documents of each class and PASSAGES passages of each, which bounds what the driver gets; classes weigh as often as
    they occur among all labels."""
    small_batches(docs.sparkSession)
    rows = sample_labelled(docs, labels, label, learn, examples).mapInArrow(_features, "doc_id bigint, label int, x binary").toArrow().sort_by([("doc_id", "ascending")])
    y = rows["label"].to_numpy().astype(np.float64)
    bags = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in rows["x"].to_pylist()]
    share = labels.where(F.coalesce(learn, F.lit(False))).agg(F.avg(F.when(F.col(label).isin(0, 1), F.col(label))).alias("p")).first()["p"]
    base = min(max(float(share if share is not None else 1.0), 0.01), 0.99)
    if not bags:
        model = AttentionModel(np.zeros(WIDTH), np.ones(WIDTH))
        model.p["c"][:] = 0
        model.p["d"][:] = np.log(base / (1 - base))
        return model
    every = np.concatenate(bags).astype(np.float64)
    model = AttentionModel(every.mean(axis=0), np.maximum(every.std(axis=0), 0.02))
    n1 = max(y.sum(), 1)
    n0 = max(len(y) - y.sum(), 1)
    model.p["d"][:] = np.log(base / (1 - base))
    model.train(bags, y, np.where(y == 1, base / n1, (1 - base) / n0) * len(y))
    return model


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in parts(batches):
            x, first = encode_passages(texts)
            f = model.value.forward(x, first)
            score = f["score"]
            top = np.array([int(f["a"][a:b].argmax()) for a, b in zip(first[:-1], first[1:])], np.int32)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32)), pa.array(np.diff(first).astype(np.int32)), pa.array(top)], names=["doc_id", "score", "predicted", "passages", "attention_at"])

    return run


def _pass(model, names: list[str], text: str):
    """Rows whose score reaches the threshold, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text)
        for part, texts in parts(batches, at):
            keep = model.value.forward(*encode_passages(texts))["score"] >= THRESHOLD
            yield part.filter(pa.array(keep))

    return run


def quality(docs: DataFrame, labels: DataFrame, learn: Column | None = None, examples: int = EXAMPLES) -> DataFrame:
    """doc_id, score (0 to 1), predicted (score >= 0.7), passages and attention_at (the passage with the most attention).

    learn: which rows of `labels` may be learned from (null counts as false). Null and empty texts are one empty passage. Without labels
    every score is the same. Texts of any length are judged whole; of passages with equal attention the first is named. Repeated rows and null ids are kept, an empty table gives an empty result, other columns are ignored.
    """
    learn = F.lit(True) if learn is None else learn
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, learn, examples=examples))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_score(model), SCHEMA)


def quality_filter(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> DataFrame:
    """The rows of docs that quality() predicts as 1, with all their columns, whatever their names.

    Null and empty texts are one empty passage, very long texts are judged whole, equal texts stay or go alike; repeated rows and null ids are rows like others,
    an empty table gives an empty result. Without labels every score is the same, and all rows stay or all go.
    """
    learn = F.lit(True) if learn is None else learn
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, learn))
    return docs.mapInArrow(_pass(model, docs.columns, "text"), docs.schema)


def learnable() -> Column:
    """One id in four is held out of learning."""
    return fold(F.col("doc_id"), 4) != 2


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered query's columns, one row per row of docs. Odd rows as in quality()."""
    scored = quality(docs, labels, learnable())
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted", "passages")
