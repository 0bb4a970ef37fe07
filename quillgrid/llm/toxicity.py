"""Toxicity from the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

What makes a text toxic is often one word in hundreds, so texts are cut into passages of PASSAGE words, and passages are the vectors: of words and
their beginnings of 4 and 6 bytes (which let inflected forms meet), weighed by term frequency and by the document frequency over all documents. Labels take no
part in the choice of terms: all that several examples have count, but those of one document only, which no other text can share, and those of very many documents.
The index holds all passages of a bounded sample of the labelled documents. A toxic document's
passage is an example of toxicity only where its own nearest neighbours in other documents say so (edited nearest neighbours); the others are left out.

Postings are cut into blocks of examples with the highest weight of each term in each. A query visits its best blocks, and then those whose bound
reaches its k-th best cosine: no other block can change the result. Votes weigh by squared similarity, the highest vote of a text's passages is its
raw score, and isotonic regression on the raw scores of the sampled documents (each without its own passages), weighted back to the classes' shares, turns it
into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.llm.common import cut, fold, small_batches
from quillgrid.llm.pieces import ranges
from quillgrid.llm.scan import NOT_WORD, parts, scan

#: Documents per class that are learned from; of them, by a hash of their ids, as many go into the index as have so many passages of label 0 and of label 1 (one document at least).
EXAMPLES, PASSAGES = 3000, (4000, 5000)
#: Words of a passage, neighbours, examples per block, blocks that a query visits before it has a bound, and cells (query, example) at once.
PASSAGE, NEAREST, BLOCK, FIRST, CELLS = 12, 16, 16, 12, 600_000
#: A term of the index is in so many of its passages and of all documents at least, and in at most this share of all documents.
MIN_PASSAGES, MIN_DOCS, MAX_SHARE = 3, 2, 0.2
#: Rounds of editing, the vote that a passage needs in the last one, and the similarity that counts against label 1 in every vote.
ROUNDS, KEEP, DOUBT = 3, 0.6, 0.05
BEGINNINGS = (4, 6)
SCHEMA = "doc_id bigint, score double, predicted int, evidence array<bigint>, similarity array<float>"


def _terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first passage of each text (and their number); passage and hash of every term occurrence. A text without words is one empty passage."""
    w = scan(texts, NOT_WORD)
    n = np.diff(w.first)
    first = np.concatenate([[0], np.cumsum(np.maximum(-(-n // PASSAGE), 1))])
    of = first[w.doc] + (np.arange(w.starts.size) - np.repeat(w.first[:-1], n)) // PASSAGE
    passage, hashes, lens = [of], [w.hashes()], w.ends - w.starts
    for k in BEGINNINGS:
        long = np.nonzero(lens > k)[0]
        starts = w.starts[long]
        sub = type(w)(w.data, starts, starts + k, w.doc[long], w.first, w.prefix)
        passage.append(of[long])
        hashes.append(sub.hashes() ^ np.uint64(k))
    return first, np.concatenate(passage), np.concatenate(hashes)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct terms of each labelled passage with their counts."""
    for part, texts in parts(batches):
        first, of, hashes = _terms(texts)
        order = np.lexsort((hashes, of))
        of, hashes = of[order], hashes[order]
        new = np.ones(of.size, bool)
        new[1:] = (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])
        at = np.nonzero(new)[0]
        counts = np.diff(np.append(at, of.size)).astype(np.int32)
        offsets = np.searchsorted(of[at], np.arange(int(first[-1]) + 1)).astype(np.int32)
        doc = np.repeat(np.arange(len(texts)), np.diff(first))
        lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(v)) for v in (hashes[at].view(np.int64), counts)]
        number = pa.array((np.arange(doc.size) - first[doc]).astype(np.int32))
        yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(doc)), part.column(2).take(pa.array(doc)), number, *lists], names=["doc_id", "label", "number", "terms", "counts"])


class Lookup:
    """Positions of hashes in a sorted vocabulary."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(terms & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are in the vocabulary, and where."""
        at = np.nonzero(self.maybe[(hashes & np.uint64(0xFFFFF)).astype(np.int64)])[0]
        found = np.minimum(np.searchsorted(self.terms, hashes[at]), max(self.terms.size - 1, 0))
        good = self.terms[found] == hashes[at] if self.terms.size else np.zeros(at.size, bool)
        return at[good], found[good]


def _frequencies(terms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(terms.value)
        df = np.zeros(terms.value.size, np.int64)
        for _, texts in parts(batches, 0):
            first, of, hashes = _terms(texts)
            at, term = look(hashes)
            doc = np.repeat(np.arange(len(texts)), np.diff(first))[of[at]]
            pairs = np.unique(doc * max(df.size, 1) + term)
            df += np.bincount(pairs % max(df.size, 1), minlength=df.size)
        there = np.nonzero(df)[0]
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(df[there])], names=["term", "n"])

    return run


def spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """ranges() in 32 bits."""
    ends = np.cumsum(lens)
    out = np.arange(int(ends[-1]) if ends.size else 0, dtype=np.int32)
    out += np.repeat((starts - (ends - lens)).astype(np.int32), lens)
    return out


class Index:
    """Block-max inverted index over the unit vectors of n examples, given as (example, term, weight) entries."""

    def __init__(self, n: int, n_terms: int, ex: np.ndarray, term: np.ndarray, weight: np.ndarray):
        self.n, self.blocks = n, -(-max(n, 1) // BLOCK)
        order = np.lexsort((ex, term))
        self.ex, self.weight, term = ex[order].astype(np.int32), weight[order], term[order]
        self.inside = self.ex % BLOCK
        self.lens = np.diff(np.searchsorted(term, np.arange(n_terms + 1)))
        # a term's postings by block, with the highest weight in each
        block = self.ex // BLOCK
        new = np.ones(term.size, bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        self.first = np.nonzero(new)[0].astype(np.int32)
        self.size = np.diff(np.append(self.first, term.size)).astype(np.int32)
        self.block = block[self.first]
        self.top = np.maximum.reduceat(self.weight, self.first) if term.size else np.zeros(0)
        at = np.searchsorted(term[self.first], np.arange(n_terms + 1))
        self.at, self.blocks_of = at[:-1].astype(np.int32), np.diff(at)
        self.read, self.all = 0, 0  # postings read, and postings of the terms asked for

    def nearest(self, first: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int, leave: np.ndarray | None = None, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, example, cosine) of every query's k examples with the highest cosine above 0, best first (ties: the earlier example).

        Query i has the terms and weights first[i] to first[i + 1]. Examples whose `group` is a query's `leave` don't count for it. Exact: blocks are skipped
        by bound only.
        """
        if not self.n or first.size < 2:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        step = max(1, CELLS // self.n)
        group = None if leave is None else np.append(group, np.full(self.blocks * BLOCK - self.n, -1))
        out = []
        for at in range(0, first.size - 1, step):
            part = first[at : at + step + 1]
            q, ex, sims = self._some(part - part[0], terms[part[0] : part[-1]], weights[part[0] : part[-1]], k, None if leave is None else leave[at : at + step], group)
            out.append((q + at, ex, sims))
        return tuple(np.concatenate(x) for x in zip(*out))

    def _some(self, begin, t, w, k, leave, group):
        n, blocks = begin.size - 1, self.blocks
        lens = self.blocks_of[t]
        entry = spread(self.at[t], lens)
        place = np.repeat(np.repeat(np.arange(n) * blocks, np.diff(begin)), lens)
        place += self.block[entry]
        factor = np.repeat(w, lens)
        # no rounding may hide a block
        bound = np.bincount(place, weights=self.top[entry] * factor, minlength=n * blocks).reshape(n, blocks) * 1.000001
        self.all += int(self.lens[t].sum())
        # the best blocks first, for a k-th best cosine to compare bounds with
        some = min(FIRST, blocks)
        best = np.argpartition(-bound, some - 1, axis=1)[:, :some] + np.arange(n)[:, None] * blocks
        visit = np.zeros(n * blocks, bool)
        visit[best.reshape(-1)] = True
        q, b, score = self._scores(visit, place, entry, factor, leave, group)
        per_query = score.reshape(n, -1)
        least = -np.partition(-per_query, k - 1, axis=1)[:, k - 1] if per_query.shape[1] >= k else np.zeros(n)
        least = np.maximum(least, 1e-12)
        found = [self._from(q, b, score, least)]
        rest = (bound >= least[:, None] * 0.999999).reshape(-1) & ~visit
        found.append(self._from(*self._scores(rest, place, entry, factor, leave, group), least))
        qs, es, ss = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((es, -ss, qs))
        qs, es, ss = qs[order], es[order], ss[order]
        keep = np.arange(qs.size) - np.searchsorted(qs, np.arange(n))[qs] < k
        return qs[keep], es[keep], ss[keep]

    def _scores(self, visit, place, entry, factor, leave, group):
        """Query, block and exact cosines of all visits (visit: query times blocks + block); 0 for what a query leaves out. Only postings in visited blocks are read."""
        go = np.nonzero(visit[place])[0]
        lens = self.size[entry[go]]
        post = spread(self.first[entry[go]], lens)
        self.read += post.size
        slot = np.cumsum(visit, dtype=np.int32)
        cell = np.repeat((slot[place[go]] - 1) * BLOCK, lens)
        cell += self.inside[post]
        q, b = np.divmod(np.nonzero(visit)[0], self.blocks)
        score = np.bincount(cell, weights=self.weight[post] * np.repeat(factor[go], lens), minlength=q.size * BLOCK).reshape(-1, BLOCK)
        if leave is not None and q.size:
            score[group.reshape(-1, BLOCK)[b] == leave[q][:, None]] = 0
        return q, b, score

    def _from(self, q, b, score, least):
        """(query, example, cosine) of cosines that aren't below `least` of the query."""
        at, j = np.nonzero(score >= least[q][:, None])
        return q[at], b[at] * BLOCK + j, score[at, j]


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: x and fitted y to interpolate between."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b, c in zip(x[order].tolist(), y[order].tolist(), w[order].tolist()):
        pools.append([b * c, c, a, a])
        while len(pools) > 1 and (pools[-2][3] == pools[-1][2] or pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]):
            s, c2, _, hi = pools.pop()
            pools[-1] = [pools[-1][0] + s, pools[-1][1] + c2, pools[-1][2], hi]
    xs = np.array([v for p in pools for v in (p[2], p[3])])
    return xs, np.repeat([p[0] / p[1] for p in pools], 2) if pools else np.zeros(0)


class Model:
    """Everything a worker needs; its size is bounded by PASSAGES and PASSAGE."""

    def __init__(self, terms: np.ndarray, idf: np.ndarray):
        self.look, self.idf = Lookup(terms), idf
        self.index = Index(0, max(terms.size, 1), *(np.zeros(0, np.int64),) * 2, np.zeros(0))
        self.labels, self.ids = np.zeros(0), np.zeros(0, np.int64)
        self.curve = np.array([0.0]), np.array([0.0])

    def entries(self, of: np.ndarray, term: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
        """Weights of the entries (passage, term, count), each of the n passages a unit vector."""
        weights = (1 + np.log(counts)) * self.idf[term]
        return weights / np.sqrt(np.bincount(of, weights=weights**2, minlength=n))[of]

    def learn(self, of: np.ndarray, term: np.ndarray, counts: np.ndarray, labels: np.ndarray, ids: np.ndarray) -> None:
        """Edits the passages and indexes what is left. of: passage of each entry, ascending; labels and ids: of each passage's document."""
        weights = self.entries(of, term, counts, labels.size)
        keep = np.bincount(of, minlength=labels.size) > 0
        # passages with the same terms and counts are one example of their class
        with np.errstate(over="ignore"):
            mark = np.zeros(labels.size, np.uint64)
            np.add.at(mark, of, (self.look.terms[term] + np.uint64(1)) * (counts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)))
        once = np.unique(np.stack([mark, labels.astype(np.uint64)]), axis=1, return_index=True)[1]
        alone = np.zeros(labels.size, bool)
        alone[once] = True
        keep &= alone
        # similar passages side by side, so that blocks have low bounds: by the heaviest term that several have
        common = np.bincount(term, minlength=self.idf.size)[term] >= 8
        lead = np.full(labels.size, self.idf.size)
        order = np.lexsort((-weights * common, of))
        heads = np.nonzero(np.diff(of[order], prepend=-1))[0] if of.size else np.zeros(0, np.int64)
        lead[of[order[heads]]] = term[order[heads]]
        candidates = np.nonzero(keep & (labels == 1))[0]
        for round_ in range(ROUNDS + 1):
            chosen = np.nonzero(keep)[0]
            chosen = chosen[np.lexsort((ids[chosen], lead[chosen], labels[chosen]))]
            place = np.full(labels.size, -1)
            place[chosen] = np.arange(chosen.size)
            mine = keep[of]
            self.index = Index(chosen.size, max(self.idf.size, 1), place[of[mine]], term[mine], weights[mine])
            self.labels, self.ids = labels[chosen].astype(float), ids[chosen]
            if round_ < ROUNDS and candidates.size:
                at, n = np.searchsorted(of, [candidates, candidates + 1])[0], np.bincount(of, minlength=labels.size)[candidates]
                pick = ranges(at, n)
                first = np.concatenate([[0], np.cumsum(n)])
                votes = self.votes(first, term[pick], weights[pick], ids[candidates])[0]
                keep[candidates] = votes >= KEEP * (round_ + 1) / ROUNDS

    def votes(self, first, terms, weights, leave=None):
        """The vote for every query, and its neighbours as nearest() gives them."""
        q, ex, sims = self.index.nearest(first, terms, weights, NEAREST, leave, self.ids)
        n = first.size - 1
        share = sims**2
        toxic = np.bincount(q, weights=share * self.labels[ex], minlength=n)
        return toxic / (np.bincount(q, weights=share, minlength=n) + DOUBT), (q, ex, sims)

    def raw(self, texts: list[bytes], leave: np.ndarray | None = None) -> tuple[np.ndarray, list[list[int]], list[np.ndarray]]:
        """The highest vote of every text's passages, and the documents and cosines of that passage's neighbours (0 and none without a known term)."""
        size = max(self.idf.size, 1)
        starts, of, hashes = _terms(texts)
        at, term = self.look(hashes)
        pairs, counts = np.unique(of[at] * size + term, return_counts=True)
        of, term = pairs // size, pairs % size
        n = int(starts[-1])
        first = np.searchsorted(of, np.arange(n + 1))
        doc = np.repeat(np.arange(len(texts)), np.diff(starts))
        votes, (q, ex, sims) = self.votes(first, term, self.entries(of, term, counts, n), None if leave is None else leave[doc])
        # of a text's passages the one with the highest vote, then with the highest similarity, then the first
        top = np.zeros(n)
        heads = np.nonzero(np.diff(q, prepend=-1))[0]
        top[q[heads]] = sims[heads]
        order = np.lexsort((np.arange(n), -top, -votes, doc))
        best = order[starts[:-1]]
        lo, hi = np.searchsorted(q, [best, best + 1])
        return votes[best], [self.ids[ex[a:b]].tolist() for a, b in zip(lo, hi)], [sims[a:b].astype(np.float32) for a, b in zip(lo, hi)]

    def score(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(raw, *self.curve), 0.0, 1.0)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for part, texts in parts(batches):
            raw, evidence, sims = m.raw(texts)
            score = m.score(raw)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(score), pa.array((score >= 0.7).astype(np.int32)), pa.array(evidence, pa.list_(pa.int64())), pa.array(sims, pa.list_(pa.float32()))],
                names=["doc_id", "score", "predicted", "evidence", "similarity"],
            )

    return run


def _left_out(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in parts(batches):
            raw = model.value.raw(texts, part.column(0).to_numpy(zero_copy_only=False))[0]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(raw)], names=["doc_id", "label", "raw"])

    return run


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int) -> DataFrame:
    """doc_id, text, label of at most per_class labelled documents of either class, by a hash of their ids.

    Only non-null 0/1 labels of ids for which `learn` holds count; an id with both labels counts as 1, an id with several texts counts once, with the greatest.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & F.coalesce(learn, F.lit(False)))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("h", F.xxhash64("doc_id"))
    chosen = known.where("label = 1").orderBy("h", "doc_id").limit(per_class).unionByName(known.where("label = 0").orderBy("h", "doc_id").limit(per_class))
    # at most 2 * per_class ids: a proven bound for the broadcast
    chosen = F.broadcast(chosen.select("doc_id", "label"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(chosen, "doc_id")
    ids = docs.select("doc_id").join(chosen, "doc_id").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("d")).first()
    if ids["n"] == ids["d"]:
        return rows  # no id repeats, so no text has to move
    return rows.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("label").alias("label"))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", examples: int = EXAMPLES) -> Model:
    """The model. To the driver come about sum(PASSAGES) passages of at most PASSAGE words each, their terms' frequencies, and sizes and raw scores of 2 * examples documents."""
    spark = docs.sparkSession
    small_batches(spark)
    sample = cut(sample_labelled(docs, labels, label, learn, examples))
    profile = sample.mapInArrow(_profile, "doc_id bigint, label int, number int, terms array<bigint>, counts array<int>").where("size(terms) > 0")
    profile = cut(profile.withColumn("h", F.xxhash64("doc_id", "number")))
    # whole documents: one row for each of the sample
    sizes = profile.groupBy("doc_id", "label").agg(F.count("*").alias("n")).withColumn("h", F.xxhash64("doc_id")).collect()
    chosen = []
    for k, most in enumerate(PASSAGES):
        mine = sorted((r for r in sizes if r["label"] == k), key=lambda r: (r["h"], r["doc_id"]))
        so_far = np.cumsum([r["n"] for r in mine])
        chosen += [r["doc_id"] for i, r in enumerate(mine) if i == 0 or so_far[i] <= most]
    some = F.broadcast(spark.createDataFrame([(int(i),) for i in chosen], "doc_id bigint"))  # at most 2 * examples ids
    rows = profile.join(some, "doc_id").drop("h").toArrow().sort_by([("doc_id", "ascending"), ("number", "ascending")])
    ids, y = rows["doc_id"].to_numpy().astype(np.int64), rows["label"].to_numpy().astype(np.int64)
    flat = lambda c: np.concatenate([np.zeros(0, np.int64), *(x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in rows[c].chunks)])
    lens = np.concatenate([np.zeros(0, np.int64), *(x.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) for x in rows["terms"].chunks)])
    of = np.repeat(np.arange(y.size), lens)
    every, at, seen = np.unique(flat("terms").view(np.uint64), return_inverse=True, return_counts=True)
    counts = flat("counts")
    candidate = seen >= MIN_PASSAGES
    terms = every[candidate]
    # statistics over all documents: at most one row per term and task, summed before they reach the driver
    df = np.zeros(terms.size, np.float64)
    if terms.size:
        sums = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_frequencies(spark.sparkContext.broadcast(terms)), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
        for r in sums.collect():
            df[r["term"]] = r["n"]
    total = docs.count()
    good = (df >= MIN_DOCS) & (df <= max(MAX_SHARE * total, MIN_DOCS))
    model = Model(terms[good], np.log((total + 1) / (df[good] + 1)) + 1e-3)
    place = np.full(every.size, -1, np.int64)
    place[np.nonzero(candidate)[0][good]] = np.arange(int(good.sum()))
    term = place[at] if every.size else np.zeros(0, np.int64)
    use = term >= 0
    of, term, counts = of[use], term[use], counts[use]
    order = np.lexsort((term, of))
    model.learn(of[order], term[order], counts[order], y, ids)
    share = labels.where(F.coalesce(learn, F.lit(False))).agg(F.avg(F.when(F.col(label).isin(0, 1), F.col(label))).alias("p")).first()["p"]
    base = float(share or 0.0)
    raw = sample.mapInArrow(_left_out(spark.sparkContext.broadcast(model)), "doc_id bigint, label int, raw double").toArrow().sort_by([("doc_id", "ascending")])
    x, z = raw["raw"].to_numpy(), raw["label"].to_numpy().astype(float)
    model.curve = isotonic(x, z, np.maximum(np.where(z == 1, base / max(z.mean(), 1e-9), (1 - base) / max(1 - z.mean(), 1e-9)), 1e-9)) if z.size else (np.array([0.0]), np.array([base]))
    return model


def toxicity(docs: DataFrame, labels: DataFrame, learn: Column | None = None, examples: int = EXAMPLES) -> DataFrame:
    """doc_id, score (0 to 1), predicted (score >= 0.7), evidence (ids of the documents of the nearest labelled passages) and similarity (their cosines).

    learn: which rows of `labels` may be learned from (a condition on its columns; null counts as false). Null and empty texts, and texts without a
    known term, get the score of no evidence. Texts of any length are judged whole, passage by passage. Without labels every score is the share of label 1, or 0.
    Equal texts get equal scores; neighbours that tie come in the order of the index. Repeated rows and null ids are kept, an empty table gives an empty
    result, other columns are ignored, whatever their names.
    """
    learn = F.lit(True) if learn is None else learn
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, learn, examples=examples))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_score(model), SCHEMA)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered query's columns, one row per row of docs: one id in three is held out of learning. Odd rows as in toxicity()."""
    scored = toxicity(docs, labels, fold(F.col("doc_id"), 3) != 1)
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted", "evidence")
