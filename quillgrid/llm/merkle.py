"""A Merkle manifest of a dataset: one tree per source over its rows, one tree over the sources, and a proof for every row.

Every parent keeps its preimage: the concatenated digests of its children, DIGITS characters each. A row's path is the list of its ancestors' preimages with
the row's slot in each. The siblings at a level are the preimage without the slot; a changed leaf is folded upwards by putting the digest so far into the slot
and hashing. Paths come down from the roots: a parent hands its own path to at most FANOUT children, so no key is met by more rows than that, however large a
source is. Ranks within a source come from ranges of the whole order, so a source with most of all rows is ranked in parallel.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from quillgrid.llm.common import lower_ascii, table

FANOUT = 16
DIGITS = 64
#: What a row's leaf is made of, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<pre:string,slot:int>>"


def digest(text: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return digest(F.concat(*map(field, fields)))


def ranked(nodes: DataFrame, group: str, order: list[str]) -> DataFrame:
    """nodes with idx (from 0, dense within each group, in the given order, nulls first) and n, the size of the group. Kept as a table.

    All rows are cut into ranges of (group, order), so a large group lies in many of them. A row's place is its place in the range's part of the group
    plus the sizes of the group's earlier parts. Rows equal in `order` take their places in any order; the result is kept, so it doesn't change afterwards.
    """
    spread = nodes.repartitionByRange(*(F.col(c).asc_nulls_first() for c in (group, *order)))
    spread = table(spread.withColumn("_part", F.spark_partition_id()))
    sizes = spread.groupBy(group, "_part").agg(F.count("*").alias("_size"))
    # one row for each range that a group has rows in
    sizes = sizes.withColumn("_before", F.sum("_size").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
    sizes = sizes.withColumn("n", F.sum("_size").over(Window.partitionBy(group))).select(F.col(group).alias("_g"), F.col("_part").alias("_p"), F.coalesce("_before", F.lit(0)).alias("_before"), "n")
    inside = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*(F.col(c).asc_nulls_first() for c in order)))
    placed = spread.withColumn("_inside", inside).join(sizes, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return table(placed.select(*nodes.columns, (F.col("_before") + F.col("_inside") - 1).alias("idx"), "n"))


def parents(nodes: DataFrame, group: str, below: int) -> DataFrame:
    """group, n, idx, pre, hash of the parents of nodes whose level has one node for each `below` leaves. Groups with a single node have none."""
    children = F.array_sort(F.collect_list(F.struct((F.col("idx") % FANOUT).alias("slot"), "hash")))
    up = nodes.where(F.col("n") > below).groupBy(group, "n", F.expr(f"idx div {FANOUT}").alias("idx")).agg(F.array_join(F.transform(children, lambda c: c["hash"]), "").alias("pre"))
    return up.withColumn("hash", digest(F.col("pre")))


def levels(leaves: DataFrame, group: str) -> list[DataFrame]:
    """The levels above the leaves (group, n, idx, hash), lowest first, up to the largest group's top."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    out, below, nodes = [], 1, leaves
    while most > below:
        nodes = table(parents(nodes, group, below))
        out.append(nodes)
        below *= FANOUT
    return out


def tops(leaves: DataFrame, above: list[DataFrame], group: str) -> DataFrame:
    """One row per group: its top node's digest. A group of one leaf has that leaf."""
    each = [d.where((F.col("n") <= FANOUT**k) & (F.col("idx") == 0)).select(group, "hash") for k, d in enumerate([leaves, *above])]
    return reduce(DataFrame.unionByName, each)


def paths(leaves: DataFrame, above: list[DataFrame], group: str, start: DataFrame) -> DataFrame:
    """leaves with path and what else start has; start: one row per group with the path of its top node, as (group, path, ...)."""
    more = [c for c in start.columns if c not in (group, "path")]
    start = start.select(F.col(group).alias("_g"), *(c for c in start.columns if c != group))
    found = None
    for k in range(len(above), -1, -1):
        nodes = leaves if k == 0 else above[k - 1].select(group, "n", "idx", "pre")
        top = nodes.where(F.col("n") <= FANOUT**k).join(start, F.col(group).eqNullSafe(F.col("_g"))).drop("_g")
        if found is not None:  # found: the level above, every node with its own path
            up = found.select(F.col(group).alias("_g"), F.col("idx").alias("_i"), F.col("pre").alias("_pre"), F.col("path").alias("_path"), *more)
            below = nodes.where(F.col("n") > FANOUT**k).join(up, F.col(group).eqNullSafe(F.col("_g")) & (F.expr(f"idx div {FANOUT}") == F.col("_i")))
            step = F.array(F.struct(F.col("_pre").alias("pre"), (F.col("idx") % FANOUT).cast("int").alias("slot")))
            top = top.unionByName(below.withColumn("path", F.concat(step, "_path")).drop("_g", "_i", "_pre", "_path"))
        found = top
    return found


def siblings(path: Column) -> Column:
    """All siblings' digests along a path, level by level from the leaf, left to right."""
    others = F.transform(path, lambda p: F.concat(F.substring(p["pre"], F.lit(1), p["slot"] * DIGITS), F.substr(p["pre"], p["slot"] * DIGITS + DIGITS + 1)))
    return F.array_join(others, "")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf digest leads to: at each level it is put into its slot of the preimage, which is hashed."""
    return F.aggregate(path, start, lambda h, p: digest(F.overlay(p["pre"], h, p["slot"] * DIGITS + 1, F.lit(DIGITS))))


def manifest(docs: DataFrame, changed: Column | None = None, group: str = "source", key: str = "doc_id", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """One row per row of docs: group, key, leaf, claimed (the leaf with `changed` instead of the text where that isn't null), subroot, root, path.

    changed: a column over docs; its text takes the place of the last field in `claimed`. Null ids and null sources are values of their own that come first;
    null and empty texts give different leaves; a text of any length is one value and hashed whole. Rows with the same id are leaves of their own, ordered by
    their digest; equal rows are equal leaves side by side. An empty table gives an empty result. Only the columns in `fields` are read; others may have any names.
    """
    plain = [docs[f"`{f}`"] for f in fields]
    columns = [docs[f"`{group}`"].alias("grp"), docs[f"`{key}`"].alias("key"), leaf(plain).alias("hash")]
    # the text's own length leads it, so the changed leaf is made anew
    columns.append((leaf(plain) if changed is None else F.when(changed.isNull(), leaf(plain)).otherwise(leaf([*plain[:-1], changed]))).alias("claimed"))
    leaves = ranked(docs.select(*columns), "grp", ["key", "hash"])
    above = levels(leaves, "grp")
    heads = ranked(tops(leaves, above, "grp").select(F.lit(0).alias("all"), "grp", "hash"), "all", ["grp"])
    over = levels(heads, "all")
    root = tops(heads, over, "all").withColumnRenamed("hash", "root")
    first = root.select("all", F.array().cast(PATH).alias("path"), "root")
    start = paths(heads, over, "all", first).select("grp", "path", F.col("hash").alias("subroot"), "root")
    return paths(leaves, above, "grp", start).select(F.col("grp").alias(group), F.col("key").alias(key), F.col("hash").alias("leaf"), "claimed", "subroot", "root", "path")


def tampered_text(docs: DataFrame) -> Column:
    """A-Z of the text lower-cased where 5 divides the CRC-32 of the decimal id; else null. Null ids and null texts stay."""
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, lower_ascii(F.col("text")))


def manifest_proofs(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row. Odd rows as in manifest()."""
    rows = manifest(docs, tampered_text(docs))
    rows = rows.withColumn("folded_root", fold(F.col("claimed"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", digest(siblings(F.col("path"))).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
