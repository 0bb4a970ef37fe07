"""Language identification by nearest centroid.

A text is its hashed byte trigrams (letters lower-cased, everything between letters one space) as a normalised TF-IDF vector. Each language
has several centroids, found by spherical k-means on a bounded sample; a text takes the language of the centroid with the highest cosine. A text that is
farther from its centroid than nearly all the texts the centroid was made of is marked as rejected, and its score is lowered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.llm.common import cut, fold, small_batches
from quillgrid.llm.scan import NOT_WORD, parts

DIMS, CLUSTERS, ROUNDS = 4096, 3, 12
#: Expected number of sampled documents per language, and of all languages together (where there are many, each gets fewer, but all are learned);
#: the share of a centroid's own sample that rejection may cost.
SAMPLE, SAMPLES, REJECT = 500, 20_000, 0.01
#: More languages than this are an error: a bound for the model's size.
LANGUAGES = 4000
SHARPNESS = 25.0
UNKNOWN = "und"
SCHEMA = "doc_id bigint, lang_pred string, score double, rejected boolean"
#: A superset of the letters, to find candidates fast: superscripts, fractions and number forms are among them.
_MAYBE_LETTER = re.compile(r"[^\W\d_]")
_DIGITS_TOO = NOT_WORD.copy()
_DIGITS_TOO[ord("0") : ord("9") + 1] = True
_LETTERS = np.where(_DIGITS_TOO, 32, np.arange(256)).astype(np.uint8)
_LETTERS[ord("A") : ord("Z") + 1] += 32


def has_letter(text: str | None) -> bool:
    """Whether any character is a letter (a Unicode category L)."""
    return text is not None and any(m.group().isalpha() for m in _MAYBE_LETTER.finditer(text))


def counts(texts: list[bytes]) -> np.ndarray:
    """texts x DIMS counts of hashed byte trigrams; runs of spaces count once."""
    data = _LETTERS[np.frombuffer(b"  ".join([b"", *texts, b""]), np.uint8)]
    doc = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts]) if texts else np.zeros(0, np.int64)
    doc = np.concatenate([np.zeros(2, np.int64), doc])[: data.size]
    keep = (data != 32) | (np.concatenate([[0], data[:-1]]) != 32)
    data, doc = data[keep].astype(np.uint32), doc[keep]
    code = ((data[:-2] * 65599 + data[1:-1] * 257 + data[2:]) * np.uint32(2654435761)) >> np.uint32(20)
    inner = doc[2:] == doc[:-2]
    inner |= (doc[1:-1] == doc[2:]) & (data[:-2] == 32)  # a text's first letters follow a space
    return np.bincount(doc[2:][inner] * DIMS + code[inner], minlength=len(texts) * DIMS).reshape(len(texts), DIMS)


def unit(n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(n).astype(np.float32) * idf.astype(np.float32)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in parts(batches, rows=64):
        n = counts(texts)
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([r.astype(np.uint32).tobytes() for r in n], pa.binary())], names=["doc_id", "lang", "n"])


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(DIMS, np.int64)
    for _, texts in parts(batches, 0, rows=64):
        df += (counts(texts) > 0).sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array([df], pa.list_(pa.int64()))], names=["df"])


def cluster(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from a farthest-first start; fewer centroids where clusters run empty."""
    centre = x.mean(axis=0)
    chosen = [int((x @ centre).argmax())]
    while len(chosen) < min(k, len(x)):
        chosen.append(int((x @ x[chosen].T).max(axis=1).argmin()))
    c = x[chosen]
    for _ in range(ROUNDS):
        near = (x @ c.T).argmax(axis=1)
        c = np.stack([x[near == j].sum(axis=0) for j in range(len(c)) if (near == j).any()])
        c = c / np.maximum(np.sqrt((c * c).sum(axis=1, keepdims=True)), 1e-9)
    return c


class Centroids:
    def __init__(self, idf: np.ndarray, langs: list[str], centres: list[np.ndarray], least: list[np.ndarray]):
        self.idf, self.langs = idf, langs
        self.centre = np.concatenate(centres) if centres else np.zeros((0, DIMS), np.float32)
        self.least = np.concatenate(least) if least else np.zeros(0)
        self.lang = np.repeat(np.arange(len(langs)), [len(c) for c in centres])

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score and whether the text was rejected."""
        sims = unit(counts(texts), self.idf) @ self.centre.T
        best = sims.argmax(axis=1)
        rows = np.arange(len(texts))
        top = np.stack([sims[:, self.lang == k].max(axis=1) for k in range(len(self.langs))], axis=1).astype(np.float64)
        p = np.exp(SHARPNESS * (top - top.max(axis=1, keepdims=True)))
        score = p[rows, self.lang[best]] / p.sum(axis=1)
        rejected = sims[rows, best] < self.least[best]
        return self.lang[best], np.where(rejected, score / 2, score), rejected


def fit(docs: DataFrame, learn: Column, sample: int = SAMPLE) -> Centroids:
    """docs: doc_id, text, lang. Inverse document frequencies come from all documents; an id that repeats is sampled once, with its greatest text."""
    spark = docs.sparkSession
    small_batches(spark)
    known = docs.where(F.coalesce(learn, F.lit(False)) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = cut(known.groupBy("lang").agg(F.count_distinct("doc_id").alias("count")))
    n_langs = sizes.count()
    if n_langs > LANGUAGES:
        raise ValueError(f"{n_langs} languages; at most {LANGUAGES} can be learned")
    each = min(sample, max(SAMPLES // max(n_langs, 1), 5))
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(1e6) * each / F.col("count")
    # at most LANGUAGES rows
    chosen = known.join(F.broadcast(sizes), "lang").where(share).select("doc_id", "text", "lang")
    ids = chosen.select("doc_id", "lang").agg(F.count("*").alias("n"), F.count_distinct("doc_id", "lang").alias("d")).first()
    if ids["n"] > ids["d"]:  # texts move only where ids repeat
        chosen = chosen.groupBy("doc_id", "lang").agg(F.max("text").alias("text")).select("doc_id", "text", "lang")
    rows = chosen.mapInArrow(_sampled, "doc_id bigint, lang string, n binary").toArrow().sort_by([("doc_id", "ascending")])
    df = np.zeros(DIMS)
    sums = docs.select("text").mapInArrow(_document_frequency, "df array<bigint>").select(F.posexplode("df").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n"))
    for r in sums.collect():
        df[r["i"]] = r["n"]
    total = docs.count()
    idf = np.log((total + 1) / (df + 1)) + 0.1
    langs, centres, least = [], [], []
    names = np.array(rows["lang"].to_pylist(), object)
    n = np.frombuffer(b"".join(rows["n"].to_pylist()), np.uint32).reshape(-1, DIMS)
    for lang in sorted(set(names.tolist())):
        x = unit(n[names == lang], idf)
        x = x[(x * x).sum(axis=1) > 0.5]
        if not len(x):
            continue
        c = cluster(x, CLUSTERS)
        sims = x @ c.T
        near = sims.argmax(axis=1)
        langs.append(lang)
        centres.append(c)
        least.append(np.array([np.quantile(sims[near == j, j], REJECT) if (near == j).any() else 0.0 for j in range(len(c))]))
    return Centroids(idf, langs, centres, least)


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for part, texts in parts(batches, rows=64):
            letters = np.array([has_letter(t) for t in part.column(1).to_pylist()])
            if m.langs:
                lang, score, rejected = m.predict(texts)
                names = [m.langs[k] if ok else UNKNOWN for k, ok in zip(lang.tolist(), letters.tolist())]
            else:
                names, score, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            score = np.clip(np.where(letters, score, 0.0), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(rejected | ~letters)], names=["doc_id", "lang_pred", "score", "rejected"])

    return run


def languages(docs: DataFrame, learn: Column | None = None, sample: int = SAMPLE) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and rejected of every whole text.

    learn: which rows may be learned from (a condition on their columns; null counts as false). Null texts and texts without a letter are `und`, with score
    0; so is everything where nothing could be learned. Texts of any length are judged whole; of languages that tie the first in order wins. Repeated rows and null ids are kept, an empty table gives an empty result,
    other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, F.lit(True) if learn is None else learn, sample))
    return rows.select("doc_id", "text").mapInArrow(_predict(model), SCHEMA)


def language_predictions(docs: DataFrame) -> DataFrame:
    """The registered query's columns, one row per row of docs: one id in three is held out of learning. Odd rows as in languages()."""
    held = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    return languages(docs, fold(F.col("doc_id"), 3) != 1).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")
