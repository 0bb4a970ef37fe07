"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern: the set of sources that hold their text. Token capacity flows from patterns to source quotas: the first
use of a pattern's distinct texts costs nothing and each further use one unit more (convex), so nothing is repeated while unused text of a fitting pattern
is left; a text that several sources hold goes to the source that needs it. What flows from a pattern to a source is then turned into documents of that
source in a seeded order: a hash of id and text deals them into ranges, whole ranges are taken up to the flow, and only the range where the flow ends is
ranked row by row.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgrid.llm.common import cut, words

WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2
BUCKET_BITS, SEED = 14, 20240501
#: Patterns of several sources that one mix may have: their totals (not their documents) go to the driver. More are an error.
MAX_PATTERNS = 100_000
#: Sources that one mix may have.
MAX_SOURCES = 100_000
#: Up to so many texts of several sources (12 bytes and their sources each) are broadcast; beyond, rows meet them in a salted shuffle.
BROADCAST_TEXTS, SALTS = 200_000, 16


def targets(sizes: Sequence[int], weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Targets of sources given in order: `share` times all sizes by weight; none above `most` times its own size, the excess goes to the others by weight."""
    out = [0.0] * len(sizes)
    left, free = share * sum(sizes), list(range(len(sizes)))
    while free:
        total = sum(weights[i % len(weights)] for i in free)
        over = [i for i in free if left * weights[i % len(weights)] / total > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i % len(weights)] / total
            break
        for i in over:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return out


def flow(capacity: dict[tuple, int], quota: dict, copies: int = MOST, edges: dict[tuple, dict] | None = None) -> dict[tuple, dict]:
    """Words routed from each pattern to each of its sources: a maximum flow of least repetition cost.

    A pattern gives `capacity` words per copy. edges: the most that each of its sources may take of it; beyond `copies` copies it then gives what its edges
    leave, at the cost of one copy more. Costs rise by one per copy and are the same for all patterns, so adding capacity copy by copy and augmenting
    along shortest residual paths (successive shortest paths) is optimal. Patterns with one source have no choice and are filled first within each copy.
    """
    routed: dict[tuple, dict] = {p: {} for p in capacity}
    need = {s: int(round(q)) for s, q in quota.items()}
    free = lambda p, s: float("inf") if edges is None else edges[p].get(s, 0) - routed[p].get(s, 0)
    by_source: dict = {}
    for p in capacity:
        for s in p:
            by_source.setdefault(s, []).append(p)
    spare = dict.fromkeys(capacity, 0)
    for level in range(copies + (edges is not None)):
        for p, c in capacity.items():
            spare[p] += c if level < copies else max(sum(edges[p].values()) - copies * c, 0)
        for p in sorted(capacity, key=lambda p: (len(p), str(p))):
            for s in p:
                x = min(spare[p], need[s], free(p, s))
                if x > 0:
                    routed[p][s] = routed[p].get(s, 0) + x
                    spare[p] -= x
                    need[s] -= x
        shared = [p for p in capacity if len(p) > 1]
        while shared and any(need.values()):
            # breadth first from patterns with spare words; a source may hand back what another pattern gave it
            came: dict = {p: None for p in capacity if spare[p] > 0}
            todo, end = deque(came), None
            while todo and end is None:
                p = todo.popleft()
                for s in p:
                    if ("s", s) in came or free(p, s) <= 0:
                        continue
                    came[("s", s)] = p
                    if need[s] > 0:
                        end = s
                        break
                    for q in by_source[s]:
                        if q not in came and routed[q].get(s, 0) > 0:
                            came[q] = s
                            todo.append(q)
            if end is None:
                break
            path, s = [], end
            while s is not None:
                p = came[("s", s)]
                back = came[p]
                path.append((p, s, back))
                s = back
            x = min([need[end], spare[path[-1][0]], *(free(p, s) for p, s, _ in path), *(routed[p][b] for p, _, b in path if b is not None)])
            for p, s, back in path:
                routed[p][s] = routed[p].get(s, 0) + x
                if back is not None:
                    routed[p][back] -= x
            spare[path[-1][0]] -= x
            need[end] -= x
    return routed


def _hash(rows: DataFrame, seed: int) -> Column:
    """A hash of whole rows (but for maps, which have no hash)."""
    return F.xxhash64(F.lit(seed), *(rows[f"`{f.name}`"] for f in rows.schema.fields if "map<" not in f.dataType.simpleString()))


def _patterns(known: DataFrame) -> tuple[DataFrame, dict[tuple, int]]:
    """known with `sources`, the sources that hold the row's text; and the words of each pattern's distinct texts."""
    texts = known.where("size > 0").groupBy("content", "size").agg(F.array_sort(F.collect_set(F.struct("own"))).alias("in"))
    texts = cut(texts.select("content", "size", F.transform("in", lambda x: x["own"]).alias("sources")))
    several = texts.where("size(sources) > 1")
    top = several.groupBy("sources").agg(F.sum("size").alias("words")).limit(MAX_PATTERNS + 1).collect()
    if len(top) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns of sources hold texts; join sources before they are mixed")
    alone = texts.where("size(sources) = 1")
    words = {tuple(r["sources"]): int(r["words"]) for r in top}
    words |= {tuple(r["sources"]): int(r["words"]) for r in alone.groupBy("sources").agg(F.sum("size").alias("words")).collect()}
    mine = F.array("own").alias("sources")
    if not top:
        return known.select("*", mine), words
    several = several.withColumnsRenamed({"content": "c", "size": "n", "sources": "several"})
    if several.count() <= BROADCAST_TEXTS:
        joined = known.join(F.broadcast(several), (F.col("content") == F.col("c")) & (F.col("size") == F.col("n")), "left")
    else:
        salted = known.withColumn("salt", F.pmod("h", F.lit(SALTS)).cast("int"))
        copies = several.withColumn("z", F.explode(F.array(*map(F.lit, range(SALTS)))))
        joined = salted.join(copies, (F.col("content") == F.col("c")) & (F.col("size") == F.col("n")) & (F.col("salt") == F.col("z")), "left")
    return joined.select(*known.columns, F.coalesce("several", F.array("own")).alias("sources")), words


def mix(
    rows: DataFrame, size: Column, sources: Column, key: Column, seed: int = SEED, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
    own: Column | None = None, content: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows as struct column `row`, size, sources, copies), (source, source_size, target).

    size: words of the row; sources: array of the sources it belongs to (null is a source, the last one); key: what the seeded order hashes, with the content.
    own and content: instead, a row belongs to one source, and rows with equal content (a 64-bit hash) of several sources are one text that all of them hold;
    what a source takes of it is taken from its own rows. Sources come in code point order. Each row is taken 0, 1 or 2 times. Sizes that sum to nothing, or no
    rows, give no copies. Equal rows are interchangeable, so the rows taken are the same in any partitioning.
    """
    spark = rows.sparkSession
    shift = 64 - BUCKET_BITS
    known = rows.select(
        F.struct(*(rows[f"`{c}`"] for c in rows.columns)).alias("row"), size.cast("bigint").alias("size"),
        F.xxhash64(F.lit(seed), key, *([] if content is None else [content])).alias("h"), _hash(rows, seed + 1).alias("h2"),
        *([F.array_distinct(sources).alias("sources"), F.lit(None).cast("string").alias("own")] if own is None else [own.cast("string").alias("own"), content.alias("content")]),
    )
    words: dict[tuple, int] | None = None
    if own is not None:
        known, words = _patterns(known)
    known = known.withColumn("bucket", F.shiftrightunsigned("h", shift).cast("int"))
    sums = cut(known.groupBy("sources", "own", "bucket").agg(F.sum("size").alias("size")))
    most = 16 * (MAX_PATTERNS + MAX_SOURCES)
    totals = sums.groupBy("sources", "own").agg(F.sum("size").alias("size")).limit(most + 1).collect()
    if len(totals) > most:
        raise ValueError(f"more than {most} totals of patterns and sources")
    parts = {(tuple(r["sources"] or ()), r["own"]): int(r["size"] or 0) for r in totals}
    source_size: dict = {}
    for (p, o), c in parts.items():
        for s in p if own is None else (o,):
            source_size[s] = source_size.get(s, 0) + c
    if len(source_size) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    order = sorted(source_size, key=lambda s: (s is None, s or ""))
    goal = targets([source_size[s] for s in order], weights, share)
    if own is None:
        routed = flow({p: c for (p, _), c in parts.items()}, dict(zip(order, goal)))
        taken = {(p, o): sum(routed[p].values()) for p, o in parts}
    else:
        edges: dict[tuple, dict] = {p: {} for p in words}
        for (p, o), c in parts.items():
            edges.setdefault(p, {})[o] = MOST * c
        routed = flow({p: words.get(p, 0) for p in edges}, dict(zip(order, goal)), edges=edges)
        taken = {(p, o): routed[p].get(o, 0) for p, o in parts}
    plan = []
    for (p, o), c in parts.items():
        whole = taken[p, o] // c if c else 0
        plan.append((list(p), o, int(whole), int(taken[p, o] - whole * c)))
    quotas = spark.createDataFrame([(s, source_size[s], float(t)) for s, t in zip(order, goal)], "source string, source_size bigint, target double")
    plans = F.broadcast(spark.createDataFrame(plan, "p array<string>, o string, whole int, rest bigint"))  # one row per pattern and source
    same = (F.col("sources") == F.col("p")) & F.col("own").eqNullSafe(F.col("o"))
    upto = Window.partitionBy("sources", "own").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = sums.withColumn("before", F.coalesce(F.sum("size").over(upto), F.lit(0))).join(plans, same)
    ends = ends.where("before < rest and before + size >= rest").groupBy("p", "o").agg(F.min("bucket").alias("end"), F.min_by(F.col("rest") - F.col("before"), "bucket").alias("left"))
    ends = ends.withColumnsRenamed({"p": "e", "o": "eo"})
    ends = plans.join(ends, (F.col("p") == F.col("e")) & F.col("o").eqNullSafe(F.col("eo")), "left").select("p", "o", "whole", "end", "left")
    known = known.join(F.broadcast(ends), same, "left")
    inside = F.when(F.col("bucket") < F.col("end"), 1).otherwise(0)
    clear = known.where("end is null or bucket <> end").select("row", "size", "sources", (F.coalesce("whole", F.lit(0)) + inside).alias("copies"))
    # one range in 2^14 of each pattern and source; rows that are equal are ranked as one
    edge = known.where("bucket = end").groupBy("sources", "own", "h", "h2", "size").agg(F.count("*").alias("n"), F.first("row").alias("row"), F.first("whole").alias("whole"), F.first("left").alias("left"))
    ranked = Window.partitionBy("sources", "own").orderBy("h", "h2", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.withColumn("before", F.coalesce(F.sum(F.col("size") * F.col("n")).over(ranked), F.lit(0)))
    once = F.when(F.col("size") > 0, F.greatest(F.lit(0), F.least(F.col("n"), F.floor((F.col("left") - F.col("before")) / F.col("size") + 0.5)))).otherwise(0).cast("int")
    taken_rows = F.concat(F.array_repeat(F.col("whole") + 1, once), F.array_repeat(F.col("whole"), (F.col("n") - once).cast("int")))
    return clear.unionByName(edge.select("row", "size", "sources", F.explode(taken_rows).alias("copies"))), quotas


def _content(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def mixture(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document; a document belongs to the one source that `source` names (null is a source).

    Size: words of the whole text, of any length (null: 0). taken: size times the copies the mix takes. A text that several sources hold is one text to the flow.
    Repeated rows and null ids are kept, an empty table gives an empty result, other columns are ignored, whatever their names. The same rows give the same
    result in any partitioning.
    """
    text = docs["text"].cast("string")
    sized = cut(docs.select("doc_id", F.col("source").cast("string").alias("source"), F.size(words(text)).cast("bigint").alias("size"), _content(text).alias("content")))
    rows, quotas = mix(sized, F.col("size"), F.array("source"), F.col("doc_id"), seed, own=F.col("source"), content=F.col("content"))
    source = rows.select("row.doc_id", "row.source", "size", (F.col("size") * F.col("copies")).cast("bigint").alias("taken"))
    quotas = F.broadcast(quotas.withColumnRenamed("source", "s"))  # one row per source, at most MAX_SOURCES
    return source.join(quotas, F.col("source").eqNullSafe(F.col("s"))).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows of docs that the mix takes, each as often as it takes it, with all their columns, whatever their names.

    Null and empty texts have no words and are not taken; texts of any length are rows like others. Null sources are one source, null ids and repeated rows
    are dealt with row by row, ties are equal rows and interchangeable, an empty table gives an empty result. The same rows give the same result in any partitioning.
    """
    text = docs["text"].cast("string")
    rows, _ = mix(docs, F.size(words(text)), F.array(docs["source"].cast("string")), docs["doc_id"], seed, own=docs["source"], content=_content(text))
    return rows.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
