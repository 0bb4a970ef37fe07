import hashlib
import math

import numpy as np
import pytest

from quillgrid.llm import clusters

SCHEMA = "vec_id bigint, embedding array<float>, label int, cluster int, vec string, n int"


def plain(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    x, c = np.array([v for _, v in kept], np.int64), np.array([v for _, v in first], np.int64)
    for turn in range(rounds + 1):
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        own = d.argmin(1)
        if turn < rounds:
            c = np.array([x[own == j].sum(0) // (own == j).sum() if (own == j).any() else c[j] for j in range(len(c))])
    near = d.min(1)
    names = [hashlib.sha256(",".join(map(str, j.tolist())).encode()).hexdigest() for j in c]
    return [(kept[i][0], int(own[i]), int(near[i]), int(near[own == own[i]].sum()), int(near.sum()), names[own[i]]) for i in range(len(kept))]


def check(df):
    got = [tuple(r) for r in clusters.cluster_distances(df).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()]
    want = plain([(r["vec_id"], r["embedding"]) for r in df.collect()])
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(want, key=key)
    return got


def frame(spark, vectors, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], v, 0, 7, "v", 1) for i, v in enumerate(vectors)], SCHEMA)


def test_whole_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"))


def test_ties_copies_and_empty_clusters(spark):
    flat = [[float(i % 3)] * 64 for i in range(60)]  # three different vectors, so that several centroids are equal and stay empty
    check(frame(spark, flat))
    grid = [[float(i % 2), float(i // 2 % 2)] + [0.0] * 62 for i in range(40)]
    check(frame(spark, grid, [i // 4 for i in range(40)]).repartition(3))


def test_odd_vectors_are_left_out(spark):
    good = np.random.default_rng(1).normal(size=(30, 64)).astype(np.float32).tolist()
    bad = [None, [], [1.0] * 63, [1.0] * 65, [None] + [1.0] * 63, [math.nan] + [1.0] * 63, [math.inf] + [1.0] * 63, [-math.inf] * 64]
    df = frame(spark, good + bad).union(frame(spark, good[:2], [None, None]))
    assert len(check(df)) == 32
    assert len(check(frame(spark, good[:3]))) == 3  # fewer vectors than clusters
    assert clusters.cluster_distances(frame(spark, bad)).count() == 0
    assert clusters.cluster_distances(df.where("false")).count() == 0


def test_components_too_large_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        clusters.cluster_distances(frame(spark, [[1e9] * 64])).collect()


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_and_spare_distances(seed):
    """Bounds never pass the true distances, and assignments equal a full search, while centroids wander."""
    rng = np.random.default_rng(seed)
    k, centres = 20, rng.integers(-800, 800, (6, 64))
    x = (centres[rng.integers(0, 6, 600)] + rng.integers(-60, 60, (600, 64))).astype(np.int64)
    c = x[rng.choice(600, k, False)]
    group = clusters.group_centroids(c, 5)
    own, near, others = clusters.assign_first(x, c, group)
    for _ in range(12):
        moved = c + rng.integers(-25, 25, c.shape)
        drift = np.sqrt(((moved - c) ** 2).sum(1).astype(float)) * (1 + clusters.SLACK)
        own, near, others, measured = clusters.assign_again(x, own, near, others, moved, drift, group)
        c = moved
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        assert (own == d.argmin(1)).all()
        root = np.sqrt(d)
        assert (near >= root[np.arange(600), own] * (1 - 1e-9)).all()
        root[np.arange(600), own] = np.inf
        for g in range(group.max() + 1):
            assert (others[:, g] <= root[:, group == g].min(1) * (1 + 1e-9)).all()
        assert measured < 0.9 * 600 * k
