"""Centroid clustering of integer vectors, exact, with Yinyang bounds.

The centroids are put into groups once. Every vector keeps an upper bound of the distance to its own centroid and, per group, a lower bound of the distance to the
group's other centroids. After the centroids have moved, the bounds are moved by as much. A vector whose upper bound is below all its lower bounds keeps its centroid
(the global filter); of the others, only groups whose bound is not above are looked at (the group filter), and in these only centroids that may be nearer (the local
filter) are measured, in whole numbers. Bounds are floating, with a slack far above their rounding, so a filter never drops a centroid that could be as near.

A round is one pass: rows come with their vector and bounds and are written with the new ones, and each task adds its sums per centroid. What the driver
holds is centroids times components.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.llm.common import table

COMPONENTS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
#: Components beyond this would give distances beyond 64 bits.
LIMIT = 1 << 27
#: Rounding of a bound over all rounds is below this share of the distances that went into it.
SLACK = 1e-9
ROWS = 8192
STATE = "kind int, vec_id bigint, vec binary, cluster int, near double, others binary, n bigint, sums array<bigint>"


def whole_vectors(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """key and vec: floor(scale * x) of each component x of vectors with exactly so many components, none of them null or not finite."""
    x = F.col("v")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = vectors.select(vectors[f"`{key}`"].cast("bigint").alias("vec_id"), vectors[f"`{column}`"].cast("array<double>").alias("v"))
    scaled = rows.where((F.size(x) == components) & F.coalesce(fine, F.lit(False))).select("vec_id", F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("vec"))
    large = F.exists("vec", lambda c: F.abs(c) > F.lit(LIMIT))
    return scaled.select("vec_id", F.when(large, F.raise_error(F.lit("a component is too large for distances of 64 bits"))).otherwise(F.col("vec").cast("array<int>")).alias("vec"))


def first_centroids(rows: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The k vectors with the smallest digests of `seed:id`; rows with one id come in the order of their components."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return np.array([r[0] for r in rows.select("vec", order.alias("o")).orderBy("o", "vec").limit(k).select("vec").collect()], np.int64)


def group_centroids(centroids: np.ndarray, groups: int) -> np.ndarray:
    """A group number per centroid: a few rounds of nearest means among the centroids themselves, from spread starts."""
    points = centroids.astype(np.float64)
    means = [points[0]]
    while len(means) < groups:
        means.append(points[np.argmax(np.min([((points - m) ** 2).sum(1) for m in means], 0))])
    means, group = np.array(means), np.zeros(len(points), int)
    for _ in range(5):
        group = ((points[:, None] - means[None]) ** 2).sum(2).argmin(1)
        means = np.array([points[group == g].mean(0) if (group == g).any() else means[g] for g in range(groups)])
    return np.unique(group, return_inverse=True)[1]


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows, whole."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def assign_first(x: np.ndarray, centroids: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, upper bound, lower bounds by group) of vectors that have no bounds yet: all distances are measured."""
    d = np.stack([squares(x, c) for c in centroids], 1)
    cluster = d.argmin(1)
    root = np.sqrt(d.astype(np.float64))
    rows = np.arange(len(x))
    near = root[rows, cluster]
    root[rows, cluster] = np.inf
    return cluster, near, np.stack([root[:, group == g].min(1) for g in range(group.max() + 1)], 1)


def assign_again(x, cluster, near, others, centroids: np.ndarray, drift: np.ndarray, group: np.ndarray):
    """(cluster, upper bound, lower bounds, distances measured) after the centroids moved by `drift` to where they are."""
    groups = group.max() + 1
    before = others
    near = near + drift[cluster]
    others = others - np.array([drift[group == g].max() for g in range(groups)])
    cluster, measured = cluster.copy(), 0
    over = lambda low, up: low * (1 - SLACK) - SLACK <= up * (1 + SLACK) + SLACK
    left = np.nonzero(over(others.min(1), near))[0]
    if not left.size:
        return cluster, near, others, measured
    own = squares(x[left], centroids[cluster[left]])
    measured += left.size
    near[left] = np.sqrt(own.astype(np.float64))
    still = over(others[left].min(1), near[left])
    left, own = left[still], own[still]
    if not left.size:
        return cluster, near, others, measured
    best, which, old = own.copy(), cluster[left].copy(), cluster[left]
    looked = over(others[left], near[left][:, None])
    low = np.full((left.size, groups), np.inf)  # the two nearest of each group that were measured or bounded
    second = np.full((left.size, groups), np.inf)
    nearest = np.full((left.size, groups), -1)

    def note(rows, g, value, c):
        closer = value < low[rows, g]
        second[rows, g] = np.where(closer, low[rows, g], np.minimum(second[rows, g], value))
        nearest[rows, g] = np.where(closer, c, nearest[rows, g])
        low[rows, g] = np.where(closer, value, low[rows, g])

    rows = np.arange(left.size)
    for c in range(len(centroids)):
        g = group[c]
        ask = rows[looked[:, g] & (old != c)]
        if not ask.size:
            continue
        bound = before[left[ask], g] - drift[c]
        maybe = over(bound, np.sqrt(best[ask].astype(np.float64)))
        note(ask[~maybe], g, bound[~maybe], -1)
        ask = ask[maybe]
        d = squares(x[left[ask]], centroids[c])
        measured += ask.size
        better = (d < best[ask]) | ((d == best[ask]) & (c < which[ask]))
        best[ask[better]], which[ask[better]] = d[better], c
        note(ask, g, np.sqrt(d.astype(np.float64)), c)
    # a centroid that lost the vector counts for its group, the one that won it doesn't
    moved = which != old
    note(rows[moved], group[old[moved]], np.sqrt(own[moved].astype(np.float64)), old[moved])
    for g in range(groups):
        won = moved & (nearest[:, g] == which)
        value = np.where(won, second[:, g], low[:, g])
        kept = others[left, g]
        lost = moved & (group[old] == g)
        others[left, g] = np.where(looked[:, g], value, np.where(lost, np.minimum(kept, value), kept))
    cluster[left], near[left] = which, np.sqrt(best.astype(np.float64))
    return cluster, near, others, measured


def _vectors(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, width).astype(np.int64)


def _binary(a: np.ndarray) -> pa.Array:
    """One binary value per row of a."""
    a = np.ascontiguousarray(a)
    size = a.itemsize * a.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer((np.arange(len(a) + 1) * size).astype(np.int32)), pa.py_buffer(a)])


def _round(centroids: np.ndarray, drift: np.ndarray | None, group: np.ndarray):
    width, groups = centroids.shape[1], int(group.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, measured = np.zeros_like(centroids), np.zeros(len(centroids), np.int64), 0
        schema = pa.schema([("kind", pa.int32()), ("vec_id", pa.int64()), ("vec", pa.binary()), ("cluster", pa.int32()), ("near", pa.float64()), ("others", pa.binary()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                b = batch.slice(at, ROWS)
                x = _vectors(b["vec"], width)
                if drift is None:
                    cluster, near, others = assign_first(x, centroids, group)
                    measured += len(x) * len(centroids)
                else:
                    near, old = b["near"].to_numpy(zero_copy_only=False), np.frombuffer(b"".join(b["others"].to_pylist()), "<f8").reshape(-1, groups)
                    cluster, near, others, more = assign_again(x, b["cluster"].to_numpy(zero_copy_only=False), near, old, centroids, drift, group)
                    measured += more
                np.add.at(sums, cluster, x)
                counts += np.bincount(cluster, minlength=len(centroids))
                none = lambda t: pa.nulls(len(x), t)  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(x), np.int32)), b["vec_id"], b["vec"], pa.array(cluster.astype(np.int32)), pa.array(near), _binary(others), none(pa.int64()), none(pa.list_(pa.int64()))], schema=schema)
        # the task's share of each centroid's sum; kind 2: distances measured
        kind = np.append(np.ones(len(counts), np.int32), np.int32(2))
        none = lambda t: pa.nulls(len(kind), t)
        total = pa.array([*sums.tolist(), None], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(kind), none(pa.int64()), none(pa.binary()), pa.array(np.arange(len(kind), dtype=np.int32)), none(pa.float64()), none(pa.binary()), pa.array(np.append(counts, measured)), total], schema=schema)

    return run


def _delete(spark: SparkSession, df: DataFrame) -> None:
    """Removes the table that df was read from."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cluster(rows: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, groups: int | None = None, seed: int = SEED) -> tuple[DataFrame, np.ndarray, list[int]]:
    """(vec_id, vec, cluster of every row of whole_vectors(), the final centroids, the distances that each pass measured).

    Ties go to the smaller number; an empty centroid stays where it is. Sums are whole and fail rather than overflow; new components are floor(sum / count).
    With fewer than k rows there are fewer centroids. The rows are written once a round into the shared folder; the table before goes when the next is whole.
    """
    spark = rows.sparkSession
    packed = table(rows)
    centroids = first_centroids(packed, k, seed)
    if not len(centroids):
        return packed.withColumn("cluster", F.lit(0)), centroids, []
    group = group_centroids(centroids, groups or math.ceil(math.sqrt(len(centroids))))
    to_bytes = lambda b: _binary(np.array(b.column("vec").flatten(), np.int32).reshape(-1, centroids.shape[1]))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b["vec_id"], to_bytes(b)], names=["vec_id", "vec"])

    state, drift, work = packed.mapInArrow(pack, "vec_id bigint, vec binary"), None, []
    last = packed
    for turn in range(rounds + 1):
        written = table(state.mapInArrow(_round(centroids, drift, group), STATE))
        _delete(spark, last)
        sums = written.where("kind = 1").select("cluster", "n", F.posexplode("sums").alias("at", "x")).groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
        work.append(written.where("kind = 2").agg(F.sum("n")).first()[0])
        last = written
        state = written.where("kind = 0").select("vec_id", "vec", "cluster", "near", "others")
        if turn == rounds:
            break
        moved = centroids.copy()
        for r in sums.collect():  # centroids times components
            if r["n"]:
                moved[r["cluster"], r["at"]] = r["x"] // r["n"]
        drift = np.sqrt(((moved - centroids).astype(np.float64) ** 2).sum(1)) * (1 + SLACK)
        centroids = moved
    return state.select("vec_id", "vec", "cluster"), centroids, work


def _distances(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = batch["cluster"].to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["cluster"], pa.array(squares(_vectors(batch["vec"], centroids.shape[1]), centroids[own]))], names=["vec_id", "cluster", "distance"])

    return run


def cluster_distances(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector.

    Vectors of another length, null ones, and those with a null or non-finite component are left out. Null ids are kept; their digest is that of no id. Ids may
    repeat: every row is a vector of its own. Equal vectors and ties give the smaller cluster. An empty table gives an empty result; other columns are ignored.
    """
    rows, centroids, _ = cluster(whole_vectors(vectors), k, rounds)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    measured = rows.mapInArrow(_distances(centroids), "vec_id bigint, cluster int, distance bigint")
    inertia = {r[0]: r[1] for r in measured.groupBy("cluster").agg(F.sum("distance")).collect()}  # one row per centroid
    lookup = lambda values, kind: F.element_at(F.array(*(F.lit(v).cast(kind) for v in values)), F.col("cluster") + 1)
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return measured.select(
        "vec_id", "cluster", "distance", lookup([inertia.get(c, 0) for c in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"), lookup(names, "string").alias("centroid_sha256"),
    )
