import re
import sys
import unicodedata
from collections import Counter
from pathlib import Path

import public_tokenizers
import sentencepiece

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline
from quillgrid.llm import jaccard, quality_model, quality_rules
from quillgrid.llm.common import read


def test_stages_do_what_their_operators_decide(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = read(spark, sf, "documents")
    columns, seen = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen[name] = [r.doc_id for r in before.collect()], [r.doc_id for r in docs.collect()], before
        if i < 4:
            assert docs.columns == columns
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    first, second, third, fourth, fifth = seen.values()
    scored = quality_model.quality(first[2], read(spark, sf, "labels"), quality_model.learnable())
    assert sorted(first[1]) == ids(scored.where("predicted = 1"))
    assert sorted(second[1]) == ids(quality_rules.quality_verdicts(second[2]).where("kept"))
    assert sorted(third[1]) == ids(jaccard.ngram_components(third[2]).where("doc_id = component_id"))
    assert set(fourth[1]) <= set(fourth[0]) and max(map(fourth[1].count, fourth[1])) <= 2
    assert sorted(fifth[1]) == sorted(fifth[0])


def test_stages_take_odd_and_empty_tables(spark, odd, empty, tmp_path):
    for n, docs in enumerate((odd.withColumn("gone_id", odd["doc_id"]).withColumn("row", odd["text"]), empty)):
        sf = f"{tmp_path}/{n}"
        labels = [(i, 1, 0) for i in range(9)] if n == 0 else []
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns
            assert n == 0 or out.count() == 0
            out.write.format("noop").mode("overwrite").save()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()


GAP = "[\x20\x09-\x0d]+"


def passes(text):
    """The rules in plain Python."""
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n, chars = len(words), sum(map(len, words))
    grams = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    symbols, letters = len(re.findall(r"[#*$%&|<>]", text or "")), sum(any(unicodedata.category(c)[0] == "L" for c in w) for w in words)
    ends, begins = sum(bool(re.search("(\\.\\.\\.|…)[\x20\x09-\x0d]*\\Z", x)) for x in lines), sum(bool(re.match("[\x20\x09-\x0d]*[-*•]", x)) for x in lines)
    base = n >= 50 and 100 * len(repeated) <= 50 * n
    rest = 10 * symbols <= n and 2 * n <= chars <= 20 * n and 2 * (len(lines) - len(set(lines))) <= len(lines) and 10 * letters >= 3 * n
    return base and rest and 10 * ends <= 6 * len(lines) and 10 * begins <= 9 * len(lines)


def firsts(rows):
    """Ids that stay when of each group of linked texts the smallest id does."""
    sets = {}
    for i, text in rows:
        w = [x for x in re.split(GAP, re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if x]
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()
    group = {i: i for i in sets}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    meet = {}
    for i, s in sets.items():
        for x in s:
            meet.setdefault(x, []).append(i)
    for i, s in sets.items():
        for j in {j for x in s for j in meet[x] if j > i}:
            both = len(s & sets[j])
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                group[b] = a
    return sorted(i for i in sets if find(i) == i)


def shares(sizes):
    """Targets of sources in order, weights 3, 1, 2, none above twice its size."""
    target, fixed = [0.0] * len(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left = 1.5 * sum(sizes) - sum(2 * sizes[i] for i in fixed)
        for i in free:
            target[i] = left * (3, 1, 2)[i % 3] / sum((3, 1, 2)[j % 3] for j in free)
        over = [i for i in free if target[i] > 2 * sizes[i] + 1e-9]
        if not over:
            return target
        for i in over:
            target[i] = 2 * sizes[i]
            fixed.add(i)


def test_pipeline_against_plain_versions(spark):
    """All stages after the classifier, whose model has a test of its own, without the operators' code."""
    sf = "/root/testdata/sf0.001"
    docs = read(spark, sf, "documents")
    good = {r.doc_id for r in quality_model.quality(docs, read(spark, sf, "labels"), quality_model.learnable()).where("predicted = 1").collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    left = [i for i in sorted(rows) if i in good and passes(rows[i].text)]
    left = firsts([(i, rows[i].text) for i in left])
    got = corpus_pipeline.run(spark, sf).collect()
    copies = Counter(r.doc_id for r in got)
    assert set(copies) <= set(left) and max(copies.values()) <= 2
    # what the mix takes of each source lies within the longest text that it holds of the target
    size = {i: len(re.findall("[^\x20\x09-\x0d]+", rows[i].text)) for i in left}
    sources = sorted({rows[i].source for i in left}, key=lambda s: (s is None, s or ""))
    totals = [sum(size[i] for i in left if rows[i].source == s) for s in sources]
    for s, want in zip(sources, shares(totals)):
        mine = [i for i in left if rows[i].source == s]
        assert abs(sum(size[i] * copies[i] for i in mine) - want) <= 2 * max(size[i] for i in mine)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in got:
        ids = library.encode(rows[r.doc_id].text)
        assert list(r.ids) == ids and r.decoded == library.decode(ids)
