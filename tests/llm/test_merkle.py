import hashlib
import zlib

import duckdb
import pytest

from quillgrid.llm import merkle
from quillgrid.llm.queries import ORACLES

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, path string, n int, hash string, idx int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """Every tree built level by level in lists."""

    def leaf(r, text):
        values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def tree(nodes):
        paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            above, held = [], []
            for at in range(0, len(nodes), 16):
                run = nodes[at : at + 16]
                for k, inside in enumerate(members[at : at + 16]):
                    for m in inside:
                        paths[m].append((run, k))
                above.append(sha("".join(run)))
                held.append(sum(members[at : at + 16], []))
            nodes, members = above, held
        return nodes[0], paths

    sources = {}
    for r in rows:
        sources.setdefault(r["source"], []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        members = sorted(sources[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees.append((members, *tree([leaf(r, r["text"]) for r in members])))
    root, over = tree([t[1] for t in trees])
    for (members, subroot, paths), up in zip(trees, over):
        for r, path in zip(members, paths):
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            h, proof = leaf(r, text), ""
            for run, k in [*path, *up]:
                proof += "".join(run[:k] + run[k + 1 :])
                h = sha("".join([*run[:k], h, *run[k + 1 :]]))
            yield (r["doc_id"], leaf(r, r["text"]), subroot, root, sha(proof), h, h == root)


def key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def check(df):
    got = [tuple(r) for r in merkle.manifest_proofs(df).select(*COLUMNS).collect()]
    assert sorted(got, key=key) == sorted(plain([r.asDict() for r in df.collect()]), key=key)
    return got


@pytest.mark.parametrize("sizes", [[1], [1, 1], [16], [17], [257, 1, 40], [1] * 35, [256, 2]])
def test_trees_of_many_shapes(spark, sizes):
    rows = [(i * 3, f"s{k}", "en", i, f"Text {i} é", "x", 1, "h", 2) for k, n in enumerate(sizes) for i in range(k * 1000, k * 1000 + n)]
    got = check(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert any(not r[-1] for r in got) or len(rows) < 3


def test_odd_rows(spark, odd, empty):
    got = check(odd)
    assert len(got) == odd.count()
    assert merkle.manifest_proofs(empty).count() == 0
    texts = {r[0]: r[1] for r in got}
    assert texts[3] != texts[4]  # null and empty differ


def test_a_source_is_ranked_in_several_ranges(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(5000).selectExpr("id as doc_id", "if(id % 3 = 0, 'rare', 'hot') as source", "'en' as lang", "id as n_chars", "concat('T', id) as text")
        leaves = rows.selectExpr("source as grp", "doc_id as key", "sha2(text, 256) as hash")
        placed = merkle.ranked(leaves, "grp", ["key", "hash"]).collect()
        for g in ("hot", "rare"):
            mine = sorted((r for r in placed if r["grp"] == g), key=lambda r: r["key"])
            assert [r["idx"] for r in mine] == list(range(len(mine))) and {r["n"] for r in mine} == {len(mine)}
        check(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    want = con.execute(ORACLES["op12_merkle_manifest"]).fetchall()
    got = [tuple(r) for r in merkle.manifest_proofs(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).select(*COLUMNS).collect()]
    assert sorted(got) == sorted(want)
