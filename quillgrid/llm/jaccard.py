"""Exact Jaccard join of documents on word shingles, and its connected components.

1. Documents with the same shingle set are one node from the start (a set's id is a 64-bit hash, checked against a second one).
2. Under one global order of shingles (frequent ones last, then by hash) two sets can only reach the threshold if they share a
   shingle among the first n - ceil(t n) + 1 of each: the size-derived bound for candidates. The least set id of the sets that share such a shingle is its
   leader; a leader's block holds the sets that share one of its shingles. Any pair that can link shares a shingle, hence a block.
3. Each block is a sparse document by shingle matrix. It is multiplied with its transpose in tiles, overlaps are accumulated per tile,
   pairs below the bounds of their sizes are discarded, and what links is reduced to a spanning forest before anything leaves the task.
4. Forests are joined into components by rounds of neighbour minima with pointer jumping, each kept in the shared folder.

In a large block every set is first compared with one of them, which settles a group of copies in linear time; what doesn't link to it is
cut into pieces, and each pair of pieces is a task of its own, so no task holds an unbounded group. No pair is emitted that does not link, and at
most one row per set and task that does.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quillgrid.llm.common import cut, small_batches, table
from quillgrid.llm.scan import SPACES, mix, parts, scan

WORDS, PERCENT = 5, 80
#: Shingles that occur in so many of one slice's documents are reported as frequent; at most MAX_FREQUENT are kept (8 bytes each).
SLICE_MIN, MAX_FREQUENT = 3, 200_000
#: Sets per piece of a block, and their shingles on the mean at most; shingles of a tile's columns.
PIECE, MEAN, COLUMNS = 512, 2048, 4096
#: Heads are longer by one shingle in so many, and linked sets then share so many more of them.
SHARE = 16
#: Sets that a task remembers, so that their copies don't send the same shingles again.
REMEMBERED = 500_000
#: Copies of what a large block's sets are compared with, so that its sets go to so many tasks.
STAR_SALTS = 16
#: Up to so many ids (8 bytes each) are broadcast; beyond, texts and ids meet in a shuffle.
BROADCAST_IDS = 500_000
_STEPS = np.array([pow(0xD1342543DE82EF95, k + 1, 1 << 64) for k in range(64)], np.uint64)


def shared(n: int) -> int:
    """How many shingles two linked sets have in common within their heads, if the smaller has n."""
    return 1 + n // SHARE


def shingle_sets(texts: list[bytes], words: int = WORDS, seed: int = 0) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of every text's shingles; a text with fewer words is one shingle, without words none."""
    w = scan(texts, SPACES)
    h = w.hashes()
    n = np.diff(w.first)
    rolled = np.zeros(max(h.size - words + 1, 0), np.uint64)
    for k in range(words):
        rolled += h[k : k + rolled.size] * _STEPS[k]
    rolled = mix(rolled + np.uint64(words + 1000 * seed))
    out = []
    for first, count in zip(w.first[:-1].tolist(), n.tolist()):
        if count >= words:
            out.append(np.unique(rolled[first : first + count - words + 1]))
        elif count:
            out.append(mix((h[first : first + count] * _STEPS[:count]).sum(keepdims=True) + np.uint64(count + 1000 * seed)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_ids(sets: list[np.ndarray], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set."""
    with np.errstate(over="ignore"):
        sums = [np.array([mix(s ^ np.uint64(0xA5A5A5A5 + seed + k)).sum() + np.uint64(s.size) for s in sets], np.uint64) for k in (0, 7)]
    return mix(sums[0]).view(np.int64), mix(sums[1] ^ np.uint64(99)).view(np.int64)


def _frequent(words: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for _, texts in parts(batches, 0, rows=4096):
            value, n = np.unique(np.concatenate(shingle_sets(texts, words, seed) or [np.zeros(0, np.uint64)]), return_counts=True)
            often = n >= SLICE_MIN
            both, at = np.unique(np.concatenate([hashes, value[often]]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([counts, n[often]]), minlength=both.size).astype(np.int64)
            hashes = both
        yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], names=["h", "n"])

    return run


def _prefixes(words: int, percent: int, seed: int, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = frequent.value
        seen: set[int] = set()
        for part, texts in parts(batches):
            sets = shingle_sets(texts, words, seed)
            sid, check = set_ids(sets, seed)
            heads = []
            for s, name, doc_id in zip(sets, sid.tolist(), part.column(0).to_pylist()):
                # copies have one set: a task gives its head once, as long as it remembers
                if doc_id is None or name in seen:
                    heads.append(s[:0])
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(name)
                size = s.size - -(-percent * s.size // 100) + shared(s.size) if s.size else 0
                if hot.size and s.size:
                    at = np.minimum(np.searchsorted(hot, s), hot.size - 1)
                    often = hot[at] == s
                    heads.append(np.concatenate([s[~often], s[often]])[:size] if often.any() else s[:size])
                else:
                    heads.append(s[:size])
            offsets = np.cumsum([0, *(len(x) for x in heads)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.uint64), *heads]).view(np.int64)
            size = np.array([s.size for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size), pa.array(sid), pa.array(check), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "n", "sid", "check", "head"])

    return run


def _sets(words: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in parts(batches, 0):
            sets = shingle_sets(texts, words, seed)
            yield pa.RecordBatch.from_arrays([pa.array(set_ids(sets, seed)[0]), pa.array([s.tobytes() for s in sets], pa.binary())], names=["sid", "shingles"])

    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs: the shingle columns that few sets share are counted pair by pair, the others in dense tiles."""
    m = len(sets)
    row = np.repeat(np.arange(m), [s.size for s in sets])
    value, column, degree = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = degree[column] > 1
    row, column = row[common], column[common]
    few = degree[column] <= 24
    out = np.zeros(m * m, np.int64)
    r, c = row[few], column[few]
    for k in range(1, 24):
        same = c[k:] == c[:-k]
        if not same.any():
            break
        out += np.bincount(r[:-k][same] * m + r[k:][same], minlength=m * m)
    out = out.reshape(m, m)
    out = out + out.T
    r, c = row[~few], column[~few]
    if r.size:
        names, c = np.unique(c, return_inverse=True)
        for at in range(0, names.size, COLUMNS):
            lo, hi = np.searchsorted(c, [at, at + COLUMNS])
            tile = np.zeros((m, min(COLUMNS, names.size - at)), np.float32)
            tile[r[lo:hi], c[lo:hi] - at] = 1
            out += (tile @ tile.T).astype(np.int64)
    out[np.arange(m), np.arange(m)] = [s.size for s in sets]
    return out


def forest(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set, the first set of its component among these."""
    n = np.array([s.size for s in sets], np.int64)
    both = overlaps(sets)
    linked = 100 * both >= percent * (n[:, None] + n[None, :] - both)
    label = np.arange(len(sets))
    while True:
        new = np.where(linked, label[None, :], len(sets)).min(axis=1)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _task(percent: int):
    def run(group: pa.Table) -> pa.Table:
        sid = group["sid"].to_numpy()
        at = np.argsort(sid, kind="stable")
        raw = group["shingles"].to_pylist()
        label = forest([np.frombuffer(raw[i], np.uint64) for i in at], percent)
        sid = sid[at]
        linked = label != np.arange(label.size)
        return pa.table({"u": sid[linked], "v": sid[label[linked]]})

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of every component, for each node of an edge (u, v) but the roots. Large-star and small-star rounds."""

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        both = both if large else both.where("v < u")
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        back = both.join(least, "u")
        if large:
            return back.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        return back.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()

    e = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    sign = lambda d: d.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    before = sign(e)
    while before["n"]:
        e = cut(star(cut(star(e, True)), False))
        after = sign(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def ngram_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Words are split at white space after lower-casing A-Z. A document's set has its distinct shingles of `words` words; with fewer words the whole sequence is one,
    without words the set is empty and linked with nothing. Two documents link if 100 * intersection >= percent * union. component_id is the smallest id that links
    reach. Null text: no words. A row with a null id links with nothing and has a null component. Repeated rows are kept; two rows with the same id and different
    texts count as two documents. Texts of any length are taken whole. An empty table gives an empty result; other columns are ignored, whatever their names.
    """
    return _components(docs, key, text, words, percent)[0].select("doc_id", "n_shingles", "component_id")


def _components(docs: DataFrame, key: str, text: str, words: int, percent: int) -> tuple[DataFrame, int]:
    """doc_id, n_shingles, sid (the id of the row's set, null for none), root (of its component) and component_id of every row; and the seed of the hashes."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    for seed in range(8):
        counted = docs.select("text").mapInArrow(_frequent(words, seed), "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
        often = counted.orderBy(F.desc("n"), "h").limit(MAX_FREQUENT).select("h").toArrow()["h"].to_numpy().astype(np.int64)
        hot = spark.sparkContext.broadcast(np.sort(often.view(np.uint64)))
        rows = table(docs.mapInArrow(_prefixes(words, percent, seed, hot), "doc_id bigint, n bigint, sid bigint, check bigint, head array<bigint>"))
        # the whole job is right unless two different sets have one id; then another seed is taken
        clash = rows.groupBy("sid").agg((F.min("check") != F.max("check")).alias("x"), (F.min("n") != F.max("n")).alias("y")).where("x or y")
        if clash.isEmpty():
            break
    return _label(rows, components(_links(rows, docs, words, percent, seed))), seed


def _links(rows: DataFrame, docs: DataFrame, words: int, percent: int, seed: int) -> DataFrame:
    """Edges (u, v) between set ids that span the components of the linked sets."""
    heads = rows.where("n > 0 and size(head) > 0").select("sid", "n", F.explode("head").alias("h"))
    common = heads.groupBy("h").agg(F.min("sid").alias("lead"), F.max("sid").alias("top")).where("lead <> top").select("h", "lead")
    # sets that link have at least shared(n) of their heads' shingles in common, under at most k leaders; under one of them, then, at least shared(n) / k
    met = heads.join(common, "h").groupBy("lead", "sid", "n").agg(F.countDistinct("h").alias("c"))
    met = met.withColumn("k", F.count("*").over(Window.partitionBy("sid")))
    met = met.where(F.expr(f"c * k >= 1 + (({percent} * n + 99) div 100) div {SHARE}"))
    # size classes so wide that sets which can link are in the same class or in neighbouring ones
    width = math.log(100 / percent) * 1.0001 if percent < 100 else 1e-4
    met = cut(met.select("lead", "sid", "n", F.floor(F.log("n") / width).cast("int").alias("b")))
    classes = met.groupBy("lead", "b").agg(F.count("*").alias("c"), F.sum("n").alias("m"))
    around = classes.select("lead", F.explode(F.array(F.col("b") - 1, F.col("b"), F.col("b") + 1)).alias("b"), "c").groupBy("lead", "b").agg(F.sum("c").alias("near"))
    classes = cut(classes.join(around.where("near > 1"), ["lead", "b"]).select("lead", "b", "c", "m"))
    blocks = classes.groupBy("lead").agg((F.when((F.sum("c") > PIECE) | (F.sum("m") > PIECE * MEAN), True).otherwise(False)).alias("large"))
    met = cut(met.join(classes.select("lead", "b", F.col("c").alias("peers")), ["lead", "b"]).join(blocks, "lead"))
    tasks = met.where("not large").select("lead", F.lit("").alias("x"), F.lit("").alias("y"), "sid")
    load = lambda sids: _load(sids, rows, docs, words, seed)
    run = lambda members, sets: members.join(sets, "sid").groupBy("lead", "x", "y").applyInArrow(_task(percent), "u bigint, v bigint")
    large = met.where("large")
    found = run(tasks, load(tasks))
    if large.isEmpty():
        return found
    sets = table(load(large))
    linked, rest = _star(large, sets, percent)
    return found.unionByName(linked).unionByName(run(rest, sets))


def _star(large: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links of each large block's members to one of them, and the tasks that remain: pairs of pieces of which at least one holds sets without such a link.

    In a large group of copies nearly all sets link to the chosen one, so its cost grows with its size and not with the square of it.
    """
    centre = large.groupBy("lead").agg(F.min(F.struct(-F.col("peers"), F.col("sid")))["sid"].alias("centre"))
    theirs = centre.join(sets.select(F.col("sid").alias("centre"), F.col("shingles").alias("other")), "centre")
    theirs = theirs.withColumn("salt", F.explode(F.array(*map(F.lit, range(STAR_SALTS)))))
    both = large.select("lead", "sid").join(sets, "sid").withColumn("salt", F.pmod(F.xxhash64("sid"), F.lit(STAR_SALTS)).cast("int")).join(theirs, ["lead", "salt"])
    linked = cut(both.select("lead", "sid", "centre", "shingles", "other").mapInArrow(_compare(percent), "lead bigint, sid bigint, centre bigint"))
    flagged = large.join(linked.select("lead", "sid", F.lit(0).alias("open")), ["lead", "sid"], "left")
    flagged = cut(flagged.select("lead", "sid", "n", "b", F.coalesce("open", F.lit(1)).alias("open")))
    sizes = flagged.groupBy("lead", "b", "open").agg(F.greatest(F.ceil(F.count("*") / PIECE), F.ceil(F.sum("n") / (PIECE * MEAN))).cast("int").alias("pieces"))
    piece = sizes.select("lead", "b", "open", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("p"))
    name = F.concat_ws(":", "b", "open", "p")
    a, z = (piece.select("lead", F.col("b").alias(f"b{s}"), F.col("open").alias(f"open{s}"), name.alias(s)) for s in "xy")
    pairs = a.where("openx = 1").join(z, "lead").where("abs(bx - by) <= 1 and (openy = 0 or x <= y)").select("lead", "x", "y")
    ends = pairs.select("lead", "x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("end"))
    members = flagged.join(sizes, ["lead", "b", "open"]).select("lead", "sid", F.concat_ws(":", "b", "open", F.pmod(F.xxhash64("sid"), "pieces")).alias("end"))
    return linked.select(F.col("sid").alias("u"), F.col("centre").alias("v")), members.join(ends, ["lead", "end"]).select("lead", "x", "y", "sid")


def _compare(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = np.intersect1d(a, b, assume_unique=True).size
                keep.append(100 * both >= percent * (a.size + b.size - both))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(3)], names=["lead", "sid", "centre"]).filter(pa.array(keep, pa.bool_()))

    return run


def _load(wanted: DataFrame, rows: DataFrame, docs: DataFrame, words: int, seed: int) -> DataFrame:
    """sid and shingles of the sets that `wanted` names, from one document of each."""
    wanted = cut(wanted.select("sid").distinct())
    few = wanted.count() <= BROADCAST_IDS
    hint = F.broadcast if few else (lambda df: df)
    # one document for each set, so no more than there are sets
    chosen = rows.where("doc_id is not null").select("sid", "doc_id").join(hint(wanted), "sid").groupBy("sid").agg(F.min("doc_id").alias("doc_id"))
    chosen = hint(chosen.select("doc_id").distinct())
    # an id may have several texts: of those too, each set counts once
    return docs.join(chosen, "doc_id").select("text").mapInArrow(_sets(words, seed), "sid bigint, shingles binary").dropDuplicates(["sid"])


def _maybe_broadcast(ids: DataFrame) -> DataFrame:
    """Broadcast only up to BROADCAST_IDS rows, counted."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _label(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Adds to each row its component's smallest id. Large components are salted, singletons take no part in the join."""
    salts = 32
    flat = rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("sid")).alias("sid"))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt")
    roots = cut(roots)
    spread = roots.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    flat = cut(
        flat.withColumn("salt", salt).join(spread.withColumnRenamed("node", "sid"), ["sid", "salt"], "left")
        .select("doc_id", "n_shingles", "sid", "salt", F.coalesce("root", "sid").alias("root"))
    )
    least = flat.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("size")).where("size > 1").drop("size")
    least = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    done = flat.join(least, ["root", "salt"], "left")
    return done.select("doc_id", "n_shingles", "sid", "root", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def _named(seed: int, words: int, columns: list[str], text: str):
    """Adds the id of each row's set, null for an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index(text)
        for part, texts in parts(batches, at):
            sets = shingle_sets(texts, words, seed)
            sid = pa.array(set_ids(sets, seed)[0], mask=np.array([s.size == 0 for s in sets], bool))
            yield pa.RecordBatch.from_arrays([*part.columns, sid], names=[*part.schema.names, "__quillgrid_sid"])

    return run


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of docs that stay when each component keeps its smallest id; all columns.

    Texts without words (null ones among them) and rows with a null id are in no component and stay. Rows that repeat an id with the same shingle set stay
    once, that with the smallest hash of its columns (maps left out); an id with several texts counts as several documents, of
    which each stays unless it is in a component with a smaller one. Very long texts are compared whole. An empty table gives an empty result.
    """
    labelled, seed = _components(docs, "doc_id", "text", words, percent)
    labelled = cut(labelled)
    ids = labelled.where("doc_id is not null").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("d")).first()
    if ids["n"] == ids["d"]:
        gone = _maybe_broadcast(cut(labelled.where("doc_id <> component_id").select(F.col("doc_id").alias("__quillgrid_gone")).distinct()))
        return docs.join(gone, docs["doc_id"] == F.col("__quillgrid_gone"), "left_anti")
    # ids repeat: of each component the row with the smallest id, and of its sets the one with the smallest set id, stays
    pairs = cut(labelled.where("sid is not null and doc_id is not null").select("root", "doc_id", "sid").distinct())
    first = pairs.groupBy("root").agg(F.min(F.struct("doc_id", "sid")).alias("f")).select("f.*")
    gone = pairs.select("doc_id", "sid").join(first, ["doc_id", "sid"], "left_anti").select(F.col("doc_id").alias("__quillgrid_gone"), F.col("sid").alias("__quillgrid_set"))
    named = docs.mapInArrow(_named(seed, words, docs.columns, "text"), StructType([*docs.schema.fields, StructField("__quillgrid_sid", LongType())]))
    kept = named.join(_maybe_broadcast(cut(gone)), (F.col("doc_id") == F.col("__quillgrid_gone")) & (F.col("__quillgrid_sid") == F.col("__quillgrid_set")), "left_anti")
    alone = F.col("__quillgrid_sid").isNull() | F.col("doc_id").isNull()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    mark = F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()))
    once = kept.where(~alone).groupBy("doc_id", "__quillgrid_sid").agg(F.min_by(F.struct(*columns), mark).alias("__quillgrid_row")).select("__quillgrid_row.*")
    return once.unionByName(kept.where(alone).select(*columns))
