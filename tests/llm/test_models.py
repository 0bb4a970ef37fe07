import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from quillgrid.llm import language, quality_model, toxicity
from quillgrid.llm.common import fold
from pyspark.sql import functions as F

ENGLISH, GERMAN = "the of and to in that is was for with".split(), "der die und das nicht mit ein von auf ist".split()


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(900):
        words = [rng.choice(ENGLISH if i % 2 else GERMAN) + rng.choice(["", "", "a", "e"]) for _ in range(rng.choice([4, 30, 200]))]
        toxic, good = int(rng.random() < 0.2), int(rng.random() < 0.8)
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(["badword", "worseword", "vileword"]))
        if not good:
            words = [w + "###" for w in words]
        docs.append((i, " ".join(words), "en" if i % 2 else "de", f"s{i % 3}", i))
        if i % 3:
            labels.append((i, good, toxic))
    return spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, score int"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), {r[0]: r for r in labels}


def test_toxicity_held_out_and_evidence(labelled):
    docs, labels, known = labelled
    rows = toxicity.toxicity_scores(docs, labels).collect()
    held = [r for r in rows if r.held_out and r.doc_id in known]
    assert {r.held_out for r in rows} == {True, False} and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.predicted == known[r.doc_id][2] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    for r in rows:
        assert all(zlib.crc32(str(e).encode()) % 3 != 1 for e in r.evidence)


def test_index_is_exact():
    """Skipping blocks by bound changes nothing."""
    rng = np.random.Generator(np.random.PCG64(3))
    rows = []
    for _ in range(500):
        t = np.unique(rng.integers(0, 80, rng.integers(1, 12)))
        w = rng.random(t.size)
        rows.append((t, w / np.sqrt((w**2).sum())))
    index = toxicity.Index(500, 80, np.repeat(np.arange(500), [t.size for t, _ in rows]), np.concatenate([t for t, _ in rows]), np.concatenate([w for _, w in rows]))
    dense = np.zeros((500, 80))
    for i, (t, w) in enumerate(rows):
        dense[i, t] = w
    for _ in range(50):
        t = np.unique(rng.integers(0, 80, 6))
        w = rng.random(t.size)
        q = np.zeros(80)
        q[t] = w
        sims = dense @ q
        q, ids, got = index.nearest(np.array([0, t.size]), t, w, 10)
        best = np.sort(sims[sims > 0])[::-1][:10]
        assert (q == 0).all() and np.allclose(got, best) and np.allclose(sims[ids], got)
    # many queries at once, some without terms, and examples that a query leaves out
    queries = [np.unique(rng.integers(0, 80, rng.integers(0, 6))) for _ in range(200)]
    first = np.concatenate([[0], np.cumsum([t.size for t in queries])])
    weights, group, leave = rng.random(int(first[-1])), rng.integers(0, 40, 500), rng.integers(0, 40, 200)
    q, ids, got = index.nearest(first, np.concatenate(queries), weights, 12, leave, group)
    for i, t in enumerate(queries):
        sims = dense[:, t] @ weights[first[i] : first[i + 1]]
        sims[group == leave[i]] = 0
        assert np.allclose(got[q == i], np.sort(sims[sims > 0])[::-1][:12]) and np.allclose(sims[ids[q == i]], got[q == i])


def test_toxicity_scores_against_brute_force(labelled):
    """The query's votes, evidence and scores from plain passages, Counter and a full sort; the frequencies from plain sets."""
    docs, labels, known = labelled
    learn = fold(F.col("doc_id"), 3) != 1
    model, rows = toxicity.fit(docs, labels, learn), {r.doc_id: r for r in toxicity.toxicity_scores(docs, labels).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}

    def terms(text):
        words = re.findall("[a-z0-9\x80-\U0010ffff]+", text.lower())
        cut = [words[i : i + toxicity.PASSAGE] for i in range(0, len(words), toxicity.PASSAGE)] or [[]]
        return [Counter(x for w in p for x in [w, *(w[:k] + "*" * k for k in toxicity.BEGINNINGS if len(w) > k)]) for p in cut]

    seen = Counter(x for t in texts.values() for x in {x for p in terms(t) for x in p})
    size, names = len(texts), {}
    index = model.index
    entry = np.repeat(np.arange(model.idf.size), index.lens)
    dense = np.zeros((index.n, model.idf.size))
    dense[index.ex, entry] = index.weight
    assert np.allclose((dense**2).sum(axis=1), 1)
    for x in seen:
        _, _, h = toxicity._terms([x.rstrip("*").encode() + (b"zzzzzz" if "*" in x else b"")])
        at = np.nonzero(np.isin(model.look.terms, h))[0] if "*" not in x else np.nonzero(model.look.terms == h[1 + toxicity.BEGINNINGS.index(x.count("*"))])[0]
        if "*" not in x:
            at = np.nonzero(model.look.terms == h[0])[0]
        if at.size:
            names[x] = int(at[0])
            assert toxicity.MIN_DOCS <= seen[x] <= max(toxicity.MAX_SHARE * size, toxicity.MIN_DOCS) and np.isclose(model.idf[at[0]], math.log((size + 1) / (seen[x] + 1)) + 1e-3)
    assert len(names) == model.idf.size
    for doc_id in list(texts)[::9]:
        best = (-1.0,)
        for p in terms(texts[doc_id]):
            v = np.zeros(model.idf.size)
            for x, n in p.items():
                if x in names:
                    v[names[x]] = (1 + math.log(n)) * model.idf[names[x]]
            sims = np.round(dense @ (v / max(np.linalg.norm(v), 1e-12)), 9)
            near = sorted(np.nonzero(sims > 0)[0], key=lambda e: (-sims[e], e))[: toxicity.NEAREST]
            share = sims[near] ** 2
            # examples as near as the last neighbour may stand in for it
            tie = len({model.labels[e] for e in np.nonzero(np.isclose(sims, sims[near[-1]]))[0]}) > 1 if near else False
            vote = (share @ model.labels[near]) / (share.sum() + toxicity.DOUBT)
            best = max(best, (vote, float(sims[near[0]]) if near else 0.0, tie))
        raw, evidence, found = model.raw([texts[doc_id].encode()])
        if not best[2]:
            assert np.isclose(raw[0], best[0], atol=1e-6)
        assert np.isclose(rows[doc_id].score, model.score(raw)[0]) and sorted(rows[doc_id].evidence) == sorted(evidence[0])
        assert (np.diff(found[0]) <= 1e-7).all()
        assert bool(evidence[0]) == any(x in names for p in terms(texts[doc_id]) for x in p)


def test_toxicity_finds_neighbours_for_nearly_all(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity_scores(docs, labels).join(docs.select("doc_id", "text"), "doc_id").where("rlike(text, '[A-Za-z0-9]')").collect()
    assert len(rows) > 900 and sum(bool(r.evidence) for r in rows) >= 0.99 * len(rows) and len({r.score for r in rows}) > 5


def test_repeated_ids_are_sampled_once(spark):
    docs = spark.createDataFrame([(i % 5, f"text {i} " + "bad " * (i % 2)) for i in range(500)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(5)], "doc_id bigint, quality int, toxic int")
    assert toxicity.sample_labelled(docs, labels, "toxic", F.lit(True), 100).count() == 5


def test_isotonic_rises():
    x, y = toxicity.isotonic(np.array([0.0, 0.2, 0.4, 0.6, 0.8]), np.array([0.0, 1.0, 0.0, 1.0, 1.0]), np.ones(5))
    assert (np.diff(y) >= 0).all() and np.isclose(np.interp(0.3, x, y), 0.5)


def test_quality_held_out_and_gradients(labelled):
    docs, labels, known = labelled
    rows = quality_model.quality_scores(docs, labels).collect()
    held = [r for r in rows if r.held_out and r.doc_id in known]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.predicted == known[r.doc_id][1] for r in held) >= 0.97 * len(held)
    # the gradient agrees with differences
    rng = np.random.Generator(np.random.PCG64(4))
    m = quality_model.AttentionModel(np.zeros(quality_model.WIDTH), np.ones(quality_model.WIDTH))
    x, first = rng.standard_normal((9, quality_model.WIDTH)), np.array([0, 4, 5, 9])
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        p = m.forward(x, first)["score"]
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum()

    grads = m.gradients(m.forward(x, first), first, y, weight)
    for k, g in grads.items():
        at = tuple(0 for _ in g.shape)
        old = m.p[k][at]
        m.p[k][at] = old + 1e-5
        up = loss()
        m.p[k][at] = old - 1e-5
        down = loss()
        m.p[k][at] = old
        assert np.isclose((up - down) / 2e-5, g[at], atol=1e-6)


def test_language_held_out(labelled):
    docs, _, _ = labelled
    want = {r.doc_id: r.lang for r in docs.collect()}
    rows = language.language_predictions(docs).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == want[r.doc_id] for r in held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in rows)


def test_lang_is_no_input_of_predictions(labelled):
    """Changing held-out rows' lang, source and ids' order changes no prediction."""
    docs, _, _ = labelled
    learn = F.coalesce(fold(F.col("doc_id"), 3) != 1, F.lit(False))
    changed = docs.withColumn("lang", F.when(learn, F.col("lang")).otherwise("xx")).withColumn("source", F.lit(None).cast("string"))
    assert sorted(language.language_predictions(docs).collect()) == sorted(language.language_predictions(changed).collect())


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 1), (5, None, None), (None, 1, 1), (7, 0, 1)], "doc_id bigint, quality int, toxic int")
    none = labels.limit(0)
    for lab in (labels, none):
        for f in (toxicity.toxicity_scores, quality_model.quality_scores):
            rows = f(odd, lab).collect()
            assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
            assert f(empty, lab).count() == 0
        kept = quality_model.quality_filter(odd, lab)
        assert kept.columns == odd.columns
        kept.count()
    rows = language.language_predictions(odd).collect()
    assert len(rows) == odd.count()
    assert all((r.lang_pred == "und") == (r.doc_id in (3, 4, 8)) for r in rows)
    assert language.language_predictions(empty).count() == 0
    # a text gets one prediction, whatever the row
    assert len({(r.lang_pred, r.score) for r in rows if r.doc_id in (1, 2, None)}) == 1


def test_letters():
    assert not any(map(language.has_letter, [None, "", "12 ², ½ ① Ⅷ ٣ _ -", "\u20dd"]))
    assert all(map(language.has_letter, ["a", "½ é", "日", "ª", "Ⅷ x"]))


def test_languages_against_brute_force(labelled, monkeypatch):
    """The query's predictions and scores from trigrams in a Counter and cosines term by term."""
    docs, _, _ = labelled
    learn = fold(F.col("doc_id"), 3) != 1
    model = language.fit(docs, learn)
    rows = {r.doc_id: r for r in language.language_predictions(docs).collect()}
    for r in docs.where("doc_id % 40 = 0").collect():
        text = re.sub("[^a-z\x80-\xff]+", " ", " " + r.text.encode().decode("latin-1").lower() + " ")
        grams = Counter(text[i : i + 3] for i in range(len(text) - 2))
        v = Counter()
        for g, n in grams.items():
            a, b, c = (ord(x) for x in g)
            v[(((a * 65599 + b * 257 + c) * 2654435761) % 2**32) >> 20] += n
        x = {k: math.log1p(n) * model.idf[k] for k, n in v.items()}
        norm = math.sqrt(sum(y * y for y in x.values()))
        sims = [sum(y / norm * float(c[k]) for k, y in x.items()) for c in model.centre]
        top = [max(s for s, j in zip(sims, model.lang) if j == k) for k in range(len(model.langs))]
        best = max(range(len(sims)), key=lambda j: sims[j])
        p = [math.exp(language.SHARPNESS * (t - max(top))) for t in top]
        score = p[model.lang[best]] / sum(p) / (2 if sims[best] < model.least[best] else 1)
        assert rows[r.doc_id].lang_pred == model.langs[model.lang[best]] and math.isclose(rows[r.doc_id].score, score, rel_tol=1e-3)


def test_many_languages_are_all_learned(spark, monkeypatch):
    names = [f"l{i}" for i in range(300)]
    rows = [(i, " ".join(f"{names[i % 300]}x{j % 7}" for j in range(12)).translate(str.maketrans("0123456789", "abcdefghij")), names[i % 300]) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert set(language.fit(df, F.lit(True)).langs) == set(names)
    monkeypatch.setattr(language, "LANGUAGES", 10)
    with pytest.raises(ValueError, match="300 languages"):
        language.fit(df, F.lit(True))


def test_quality_against_brute_force(labelled):
    """The query's scores from the trained weights, passage by passage with plain loops."""
    docs, labels, _ = labelled
    model = quality_model.fit(docs, labels, quality_model.learnable())
    rows = {r.doc_id: r for r in quality_model.quality_scores(docs, labels).collect()}
    p, tanh, sigmoid = model.p, math.tanh, lambda x: 1 / (1 + math.exp(-x))
    for r in docs.where("doc_id % 60 = 0").collect():
        words = r.text.split()
        encoded, weights = [], []
        for at in range(0, len(words), quality_model.PASSAGE):
            # a passage's bytes reach up to the next passage's first word
            x = quality_model.encode_passages([r.text.encode()])[0][at // quality_model.PASSAGE]
            part = " ".join(words[at : at + quality_model.PASSAGE]) + ("" if at + quality_model.PASSAGE >= len(words) else " ")
            count = Counter(quality_model._CLASS[b] for b in (part + (" " if not part.endswith(" ") else "")).encode())
            assert np.allclose(x[: quality_model.CLASSES], [math.sqrt(count[k] / sum(count.values())) for k in range(quality_model.CLASSES)], atol=1e-5)
            lens = [len(w.encode()) for w in words[at : at + quality_model.PASSAGE]]
            assert math.isclose(x[quality_model.CLASSES + quality_model.PAIRS], math.log1p(sum(lens) / len(lens)), rel_tol=1e-5)
            z = [(float(a) - float(b)) / float(c) for a, b, c in zip(x, model.mean, model.scale)]
            e = [tanh(sum(z[i] * p["W"][i, j] for i in range(len(z))) + p["b"][j]) for j in range(quality_model.HIDDEN)]
            g = [tanh(sum(e[i] * p["V"][i, j] for i in range(len(e)))) * sigmoid(sum(e[i] * p["U"][i, j] for i in range(len(e)))) for j in range(quality_model.GATE)]
            encoded.append(e)
            weights.append(math.exp(sum(a * b for a, b in zip(g, p["w"]))))
        pooled = [sum(w * e[j] for w, e in zip(weights, encoded)) / sum(weights) for j in range(quality_model.HIDDEN)]
        score = sigmoid(sum(a * b for a, b in zip(pooled, p["c"])) + p["d"][0])
        assert math.isclose(rows[r.doc_id].score, score, rel_tol=1e-4, abs_tol=1e-6)


def test_quality_of_a_text_is_the_same_in_any_batch():
    rng = random.Random(9)
    texts = ["".join(rng.choices("ab \n#é", k=rng.randint(0, 900))).encode() for _ in range(60)] + [b"", b"   ", b"\n\n a", b"\xc3\xa9"]
    alone = [quality_model.encode_passages([t])[0] for t in texts]
    x, first = quality_model.encode_passages(texts)
    assert all(np.array_equal(a, x[lo:hi]) for a, lo, hi in zip(alone, first[:-1], first[1:]))


def test_toxicity_and_language_of_a_text_are_the_same_in_any_batch():
    rng = random.Random(10)
    texts = ["".join(rng.choices("ab \n#é", k=rng.randint(0, 400))).encode() for _ in range(60)] + [b"", b"   ", b"\n\n a", b"\xc3\xa9"]
    assert np.array_equal(language.counts(texts), np.concatenate([language.counts([t]) for t in texts]))
    first, of, hashes = toxicity._terms(texts)
    for i, t in enumerate(texts):
        f, o, h = toxicity._terms([t])
        mine = (of >= first[i]) & (of < first[i + 1])
        assert f[-1] == first[i + 1] - first[i] and sorted(zip(o.tolist(), h.tolist())) == sorted(zip((of[mine] - first[i]).tolist(), hashes[mine].tolist()))
