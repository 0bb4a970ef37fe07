import random
import re

import numpy as np
import pytest
from quillgrid.llm import jaccard as J

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = SPACES.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """(id, size, component) by comparing every pair."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if i is not None and j is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return sorted(((str(i), len(s), str(least.get(find(a)) if i is not None else None)) for a, (i, s) in enumerate(sets)))


def corpus(seed, n=120):
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(60)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.45:
            w = (rng.choice(rows)[1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                if w:
                    w[rng.randrange(len(w))] = f"e{rng.randrange(9)}"
        elif kind < 0.6:
            w = common + [f"w{rng.randrange(999)}" for _ in range(rng.randrange(40))]
        else:
            w = [f"w{rng.randrange(300)}" for _ in range(rng.choice([1, 3, 5, 6, 30, 90, 200]))]
        rows.append((i * 3 % n, " ".join(w)))
    return rows


@pytest.mark.parametrize("piece", [512, 3])
def test_same_as_comparing_all_pairs(spark, monkeypatch, piece):
    """With tiny pieces every block is cut; with a bound of 0 ids nothing is broadcast."""
    monkeypatch.setattr(J, "PIECE", piece)
    if piece == 3:
        monkeypatch.setattr(J, "BROADCAST_IDS", 0)
    rows = corpus(piece)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(tuple(map(str, r)) for r in J.ngram_components(df).collect()) == sorted((i, str(n), c) for i, n, c in brute(rows))


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(tuple(map(str, r)) for r in J.ngram_components(odd).collect()) == sorted((i, str(n), c) for i, n, c in brute(rows))
    assert J.ngram_components(empty).count() == 0
    kept = J.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "3", "4", "5", "7", "8", "9", "None"])
    assert J.keep_one(empty).count() == 0


@pytest.mark.parametrize("words", [1, 2, 3, 5])
def test_slices_of_few_words(words):
    """A slice may hold fewer words in all than a shingle has."""
    for n in range(7):
        (got,) = J.shingle_sets([b" ".join(b"w%d" % i for i in range(n))], words)
        assert got.size == (max(n - words + 1, 1) if n else 0)
    assert J.shingle_sets([b"a b c"])[0].tolist() == J.shingle_sets([b"x y z t u v", b"a b c"])[1].tolist()


def test_tables_of_one_short_document(spark):
    for n in range(1, 7):
        df = spark.createDataFrame([(5, " ".join("abcdef"[:n]))], "doc_id bigint, text string")
        assert [tuple(r) for r in J.ngram_components(df).collect()] == [(5, max(n - 4, 1), 5)]


def test_chain_of_near_copies_is_one_component(spark):
    """Neighbours link, ends don't: links must not be lost between members of one large group."""
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(f"x{j}" if j < 4 * i else w for j, w in enumerate(base))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.component_id for r in J.ngram_components(df).collect()} == {0}


def test_overlaps_and_forest():
    rng = np.random.Generator(np.random.PCG64(1))
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64)) for _ in range(60)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    assert J.overlaps(sets).tolist() == want
    assert J.forest([np.array([1, 2], np.uint64), np.array([3], np.uint64), np.array([1, 2], np.uint64)], 80).tolist() == [0, 1, 0]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, i) for i in range(101, 120)] + [(7, 7)]
    got = {r.node: r.root for r in J.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, **{i: 100 for i in range(101, 120)}}


def test_one_of_each_group_stays_where_ids_repeat(spark):
    """A text stays unless its group has a smaller id, whatever other texts have the same id."""
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(1, base, "a"), (1, base, "a"), (1, "another text that stands alone here", "b"), (2, base + " end", "c"), (2, "also alone and under a taken id", "d"),
            (3, "x y", "e"), (3, "x y", "e"), (4, None, "f"), (4, None, "g"), (None, base, "h"), (5, "X  Y", "i")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, root string")
    kept = J.keep_one(df)
    assert kept.columns == df.columns
    want = [rows[0], rows[2], rows[4], rows[5], rows[7], rows[8], rows[9]]
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("remembered", [1, 500_000])
def test_many_copies(spark, monkeypatch, remembered):
    monkeypatch.setattr(J, "REMEMBERED", remembered)
    base = [f"w{i}" for i in range(50)]
    texts = [" ".join(base), " ".join([*base[:25], "x", *base[26:]]), " ".join(base[:45]), "other words altogether in this one"]
    rows = [(i, texts[i % 3] if i % 7 else texts[3]) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert sorted(tuple(map(str, r)) for r in J.ngram_components(df).collect()) == sorted((i, str(n), c) for i, n, c in brute(rows))
