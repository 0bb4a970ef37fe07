import random
from collections import Counter
from itertools import combinations, product

import pytest
from pyspark.sql import functions as F
from quillgrid.llm import mixing as M


def fill(sizes, weights=(3, 1, 2)):
    """Water level by rounds, written differently: fix the one that is most above its cap until none is."""
    target, fixed = [0.0] * len(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left = 1.5 * sum(sizes) - sum(2 * sizes[i] for i in fixed)
        for i in free:
            target[i] = left * weights[i % 3] / sum(weights[j % 3] for j in free)
        over = [i for i in free if target[i] > 2 * sizes[i] + 1e-9]
        if not over:
            return target
        for i in over:
            target[i] = 2 * sizes[i]
            fixed.add(i)


def test_targets():
    rng = random.Random(4)
    for _ in range(300):
        sizes = [rng.choice([0, 1, 5, 50, 900]) for _ in range(rng.randint(1, 9))]
        assert all(abs(a - b) < 1e-6 for a, b in zip(M.targets(sizes), fill(sizes)))


def test_flow_is_full_and_cheapest():
    """Against the cut bound: for every set of sources, what it takes can't exceed its patterns' copies; and repeats are only what singles can't give."""
    rng = random.Random(6)
    for _ in range(60):
        names = "abcd"[: rng.randint(1, 4)]
        patterns = [p for k in range(1, len(names) + 1) for p in combinations(names, k) if rng.random() < 0.7]
        cap = {p: rng.randint(0, 30) for p in patterns}
        quota = {s: rng.randint(0, 60) for s in names}
        routed = M.flow(cap, quota)
        took = {s: sum(r.get(s, 0) for r in routed.values()) for s in names}
        assert all(v >= 0 for r in routed.values() for v in r.values())
        assert all(sum(routed[p].values()) <= 2 * cap[p] for p in cap) and all(took[s] <= quota[s] for s in names)
        most = lambda k: min(sum(quota[s] for s in names if s not in x) + k * sum(c for p, c in cap.items() if set(p) & set(x)) for n in range(len(names) + 1) for x in combinations(names, n))
        assert sum(took.values()) == most(2)
        assert sum(min(sum(routed[p].values()), cap[p]) for p in cap) >= most(1)


def test_mixture_near_targets_and_stable(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(3000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, source string, size int")
    out = M.mixture(df).collect()
    assert sorted(out) == sorted(M.mixture(df.repartition(7)).collect())
    order = ["a", "b", "c", None]
    sizes = [sum(len(t.split()) for _, t, s in rows if s == x) for x in order]
    want = dict(zip(order, zip(sizes, fill(sizes))))
    source = {i: s for i, _, s in rows}
    took = {}
    for r in out:
        assert r.source_size == want[source[r.doc_id]][0] and abs(r.target - want[source[r.doc_id]][1]) < 1e-6
        assert r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        took[source[r.doc_id]] = took.get(source[r.doc_id], 0) + r.taken
    assert all(abs(took[s] - want[s][1]) <= 40 for s in order)


def test_odd_rows(odd, empty):
    out = M.mixture(odd).collect()
    assert len(out) == odd.count() and all(r.taken <= 2 * r.size for r in out)
    assert M.mixture(empty).count() == 0
    mixed = M.mixed_documents(odd)
    assert mixed.columns == odd.columns and mixed.count() > 0
    assert M.mixed_documents(empty).count() == 0


def test_overlapping_sources(spark):
    df = spark.createDataFrame([(i, ["a"] if i % 2 else ["b", "a"]) for i in range(400)], "doc_id bigint, sources array<string>")
    rows, quotas = M.mix(df, F.lit(10), F.array_sort("sources"), F.col("doc_id"), share=0.5)
    assert rows.where("copies > 0").count() > 0 and {r.source for r in quotas.collect()} == {"a", "b"}


def test_flow_with_edges_is_full_and_cheapest():
    """Against every way to send the words of small cases, by brute force."""
    rng = random.Random(3)

    def best(patterns, cap, edges, need):
        """(most words, least repeats for them), over all integer amounts on all edges."""
        places = [(p, s) for p in patterns for s in p]
        found = (0, 0)
        for x in product(*(range(min(edges[p].get(s, 0), need[s]) + 1) for p, s in places)):
            by_s, by_p = Counter(), Counter()
            for (p, s), n in zip(places, x):
                by_s[s] += n
                by_p[p] += n
            if all(by_s[s] <= need[s] for s in need):
                cost = sum(max(n - cap[p], 0) + max(n - 2 * cap[p], 0) for p, n in by_p.items())
                found = max(found, (sum(x), -cost))
        return found

    for _ in range(60):
        patterns = [("a",), ("b",), ("a", "b")]
        cap = {p: rng.randint(0, 3) for p in patterns}
        edges = {p: {s: 2 * rng.randint(0, 2) for s in p} for p in patterns}
        need = {s: rng.randint(0, 5) for s in "ab"}
        routed = M.flow(cap, need, edges=edges)
        took = {p: sum(r.values()) for p, r in routed.items()}
        assert all(0 <= n <= edges[p].get(s, 0) for p, r in routed.items() for s, n in r.items())
        cost = sum(max(n - cap[p], 0) + max(n - 2 * cap[p], 0) for p, n in took.items())
        assert (sum(took.values()), -cost) == best(patterns, cap, edges, need)


def test_texts_that_several_sources_hold_go_where_they_are_needed(spark, monkeypatch):
    """The flow has to send words along augmenting paths, every source comes near its target, and texts are repeated less than if each source drew for itself."""
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.randint(5, 30))) for _ in range(900)]
    rows = [(t, s) for i, t in enumerate(texts) for s in (["x", "y"] if i < 500 else ["x"] if i < 650 else ["y"])]
    rows = [(i, t, s) for i, (t, s) in enumerate(rows)] + [(5000 + i, texts[0], "x") for i in range(40)] + [(None, texts[3], None), (None, None, "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    seen = []
    plain = M.flow
    monkeypatch.setattr(M, "flow", lambda cap, quota, *a, **k: seen.append((cap, plain(cap, quota, *a, **k))) or seen[-1][1])
    want = sorted(M.mixture(df).collect(), key=str)
    assert want == sorted(M.mixture(df.repartition(5)).collect(), key=str)
    cap, routed = seen[0]
    both = routed[("x", "y")]
    assert cap[("x", "y")] == sum(len(t.split()) for t in set(texts[:500]) - {texts[3]}) and both["x"] > 0 and both["y"] > 0 and both["x"] != both["y"]
    took, goal = Counter(), {}
    by_id = {r[0]: r for r in rows if r[0] is not None}
    for r in want:
        if r.doc_id is not None:
            took[by_id[r.doc_id][2]] += r.taken
            goal[by_id[r.doc_id][2]] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    assert all(abs(took[s] - goal[s]) <= 60 for s in ("x", "y"))
    with monkeypatch.context() as m:
        m.setattr(M, "MAX_PATTERNS", 0)  # more patterns than the driver may hold are an error, not another mix
        with pytest.raises(ValueError, match="more than 0 patterns"):
            M.mixture(df)
    monkeypatch.setattr(M, "BROADCAST_TEXTS", 0)
    assert sorted(M.mixture(df).collect(), key=str) == want
    copies = Counter(r.doc_id for r in M.mixed_documents(df).collect())
    assert copies == Counter({r.doc_id: r.taken // r.size for r in M.mixture(df).collect() if r.taken and r.doc_id is not None}) + Counter({None: copies[None]})


def test_many_equal_rows(spark):
    """One row that makes up most of the table is taken as often as the target asks, although it lies in one hash range."""
    rows = [(1, "a b c d", "x")] * 3000 + [(i, "e f g", "x") for i in range(2, 400)] + [(i, "h i", "y") for i in range(400, 900)]
    out = M.mixture(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    assert len(out) == len(rows)
    x = [r for r in out if r.doc_id < 400]
    assert abs(sum(r.taken for r in x) - x[0].target) <= 8
