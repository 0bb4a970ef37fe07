"""Recognised words, queues, and merges by position."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillgrid.operators import mapping as M
from quillgrid.operators import queues as Q
from quillgrid.operators import recognised as W
from quillgrid.operators import relational as R
from quillgrid.plans.catalogue import ORACLES, query, read
from quillgrid.sources import sinks


def _words(spark, sf_dir):
    """Each order as a recogniser's lists: a word per line, some without a number as confidence, some blank."""
    li = read(spark, sf_dir, "lineitem")
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    conf = F.when(n == 4, "x").when(n == 6, "-1").otherwise(F.concat(q.cast("string"), F.lit(".5")))
    text = F.when(q % 9 == 0, " \t").otherwise(F.concat("l_returnflag", n.cast("string")))
    one = F.struct(
        n.alias("word_num"), F.col("l_partkey").alias("p"), (n % 2).cast("string").alias("block_num"), (n % 3).cast("string").alias("par_num"), (q % 2).cast("string").alias("line_num"),
        (n * 10).cast("string").alias("left"), (q * 2).cast("string").alias("top"), F.lit("9").alias("width"), (n + 5).cast("string").alias("height"), conf.alias("conf"), text.alias("text"),
    )
    lists = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(one)).alias("w"))
    names = ["block_num", "par_num", "line_num", "word_num", "left", "top", "width", "height", "conf", "text"]
    texts = lambda c: F.transform("w", lambda s: s[c].cast("string")).alias(c)
    lists = lists.select("l_orderkey", *map(texts, names))
    return W.words(lists, ["l_orderkey"], names)


_W = """w AS (SELECT l_orderkey, l_linenumber AS n, l_quantity::INT AS q, l_partkey, CASE WHEN l_linenumber IN (4, 6) THEN -1.0 ELSE l_quantity::INT + 0.5 END AS conf,
    CASE WHEN l_quantity::INT % 9 = 0 THEN '' ELSE l_returnflag || l_linenumber END AS text FROM lineitem)"""


@query(
    f"""WITH {_W} SELECT l_orderkey, n % 2 AS block_num, n % 3 AS par_num, q % 2 AS line_num, string_agg(text, ' ' ORDER BY n, l_partkey) AS text, min(n * 10) AS left_, min(q * 2) AS top_, max(n * 10 + 9) - min(n * 10) AS width,
    max(q * 2 + n + 5) - min(q * 2) AS height, round_even(avg(conf), 2) AS conf, count(*) AS n_words FROM w WHERE conf > -1 AND text <> '' GROUP BY ALL"""
)
def recognised_lines(spark, sf_dir):
    """Lines by order, block, paragraph and line, from the words that are words."""
    lines = W.lines(W.real_words(_words(spark, sf_dir)), ["l_orderkey", "block_num", "par_num", "line_num"], ["place"])
    return lines.withColumnsRenamed({"left": "left_", "top": "top_", "n": "n_words"})


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_discount, k) AS by_rows, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity + l_discount * 100, k) AS by_corners,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_discount, k) AS by_left FROM (SELECT *, l_linenumber * 1000000 + l_partkey AS k FROM lineitem WHERE l_quantity > 10)"""
)
def reading_orders(spark, sf_dir):
    """Boxes in three orders; those up to 10 wide are noise."""
    b = read(spark, sf_dir, "lineitem").withColumn("k", F.col("l_linenumber") * 1_000_000 + F.col("l_partkey")).withColumn("height", F.lit(11)).withColumn("x", F.col("l_discount") * 100)
    b = W.large_boxes(b, "l_quantity", "height")
    for mode, x in (("rows", "l_discount"), ("corners", "x"), ("left", "l_discount")):
        b = W.reading_order(b, ["l_orderkey"], x, "l_quantity", "k", mode).withColumnRenamed("place", f"by_{mode}")
    return b.select("l_orderkey", "l_linenumber", "l_partkey", "by_rows", "by_corners", "by_left")


_QUEUE = """q AS (SELECT o_custkey, o_orderkey, o_orderdate, CASE WHEN o_orderpriority LIKE '1%' THEN 'H' WHEN o_orderpriority LIKE '2%' THEN 'W' WHEN o_orderpriority LIKE '3%' THEN 'U' ELSE 'D' END AS status,
    CASE o_custkey % 4 WHEN 0 THEN 'manual__' WHEN 1 THEN 'scheduled__' WHEN 2 THEN 'manual--' ELSE 'test' END || o_custkey AS run FROM orders),
    r AS (SELECT *, CASE WHEN status IN ('H', 'W') THEN row_number() OVER (PARTITION BY o_custkey ORDER BY CASE status WHEN 'H' THEN 1 WHEN 'W' THEN 2 ELSE 3 END, o_orderdate, o_orderkey) END AS turn,
      count(CASE WHEN status IN ('H', 'W') THEN 1 END) OVER (PARTITION BY o_custkey) AS waiting FROM q),
    s AS (SELECT *, waiting > 0 AND (starts_with(run, 'manual__') OR ((starts_with(run, 'scheduled__') OR starts_with(run, 'manual--')) AND waiting = 1)) AS ready FROM r)"""


def _queue(spark, sf_dir):
    p = F.col("o_orderpriority")
    status = F.when(p.startswith("1"), "H").when(p.startswith("2"), "W").when(p.startswith("3"), "U").otherwise("D")
    return read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", status.alias("status"))


def _run():
    k = F.col("o_custkey")
    return F.concat(F.when(k % 4 == 0, Q.BY_HAND).when(k % 4 == 1, Q.BY_TIME).when(k % 4 == 2, Q.BY_CHAIN).otherwise("test"), k.cast("string"))


@query(f"WITH {_QUEUE} SELECT o_custkey, o_orderkey, run AS run_id FROM s WHERE turn = 1")
def queue_targets(spark, sf_dir):
    return Q.targets(_queue(spark, sf_dir), ["o_custkey"], "o_orderdate", "o_orderkey", _run())


@query(
    f"""WITH {_QUEUE} SELECT o_custkey, o_orderkey, CASE WHEN turn = 1 THEN 'C' WHEN status = 'U' AND ready THEN 'W' ELSE status END AS status,
    CASE WHEN turn = 1 THEN 'closed' WHEN turn = 2 AND o_custkey % 4 IN (1, 2) THEN 'next' WHEN status = 'U' AND ready THEN 'promoted' ELSE 'kept' END AS kind FROM s
    UNION ALL SELECT o_custkey, NULL, CASE WHEN ready THEN 'W' ELSE 'U' END, 'new' FROM s WHERE turn = 1"""
)
def queue_after_run(spark, sf_dir):
    """Customers' queues of orders after the first of each is done, by runs that were started in different ways."""
    return Q.finish(_queue(spark, sf_dir), ["o_custkey"], "o_orderdate", "o_orderkey", _run())


_SIDES = """x AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS a FROM lineitem WHERE l_returnflag = 'N' GROUP BY ALL), y AS (SELECT l_orderkey, list(l_suppkey ORDER BY l_linenumber, l_suppkey) AS b FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL),
    z AS (SELECT l_orderkey, coalesce(a, []) AS a, coalesce(b, []) AS b FROM x FULL JOIN y USING (l_orderkey))"""


@query(
    f"""WITH {_SIDES} SELECT l_orderkey, unnest(a) AS a, unnest(b) AS b, NULL::VARCHAR AS error FROM z WHERE len(a) = len(b)
    UNION ALL SELECT l_orderkey, NULL, NULL, 'files and layouts differ: ' || len(a) || ' and ' || len(b) FROM z WHERE len(a) <> len(b)"""
)
def zip_with_length_check(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    part = lambda cond, c: F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("l_linenumber", c)))), lambda s: s[c])
    both = li.groupBy("l_orderkey").agg(part(F.col("l_returnflag") == "N", "l_partkey").alias("a"), part(F.col("l_linestatus") == "O", "l_suppkey").alias("b"))
    return both.where("size(a) + size(b) > 0").select("l_orderkey", F.inline(M.zip_checked(F.col("a"), F.col("b"), "files and layouts differ")))


@query(
    """WITH a AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS pos, l_partkey::VARCHAR AS part, l_returnflag AS flag FROM lineitem WHERE l_returnflag <> 'R'),
    b AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS pos, l_linestatus AS flag, l_shipdate::DATE::VARCHAR AS day FROM lineitem WHERE l_linestatus = 'F'),
    m AS (SELECT l_orderkey, pos, a.part, coalesce(b.flag, a.flag) AS flag, b.day FROM a FULL JOIN b USING (l_orderkey, pos)),
    c AS (SELECT l_orderkey, pos::INT AS pos, 'part' AS key, part AS value FROM m UNION ALL SELECT l_orderkey, pos::INT, 'flag', flag FROM m UNION ALL SELECT l_orderkey, pos::INT, 'day', day FROM m)
    SELECT * FROM c WHERE value IS NOT NULL"""
)
def update_rows_by_position(spark, sf_dir):
    """Two lists of rows of an order merged by position; a key that both have keeps the second one's value."""
    li = read(spark, sf_dir, "lineitem")
    place = (F.isnull("l_linenumber").alias("n"), "l_linenumber", F.isnull("l_partkey").alias("p"), "l_partkey")  # missing ones last
    part = F.struct(*place, F.col("l_returnflag").alias("f"))
    other = F.struct(*place, F.col("l_linestatus").alias("f"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("d"))
    both = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.when(F.col("l_returnflag") != "R", part))).alias("a"), F.array_sort(F.collect_list(F.when(F.col("l_linestatus") == "F", other))).alias("b"))
    a = F.transform("a", lambda s: F.create_map(F.lit("part"), s["l_partkey"].cast("string"), F.lit("flag"), s["f"]))
    b = F.transform("b", lambda s: F.create_map(F.lit("flag"), s["f"], F.lit("day"), s["d"]))
    rows = both.select("l_orderkey", F.posexplode(R.update_by_position(a, b)).alias("pos", "m"))
    return rows.select("l_orderkey", (F.col("pos") + 1).alias("pos"), F.explode("m").alias("key", "value")).where("value IS NOT NULL")


# The same with every tie in the SQL's order settled: rows of an order with equal numbers and parts come by flag, then by day.
query(
    ORACLES["update_rows_by_position"]
    .replace("l_partkey) AS pos, l_partkey", "l_partkey, l_returnflag) AS pos, l_partkey")
    .replace("l_partkey) AS pos, l_linestatus", "l_partkey, l_linestatus, l_shipdate::DATE NULLS FIRST) AS pos, l_linestatus"),
    name="update_rows_by_position_total",
)(update_rows_by_position)


@query(
    """WITH c AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'late' END AS o_orderpriority FROM orders WHERE o_orderkey % 3 = 0)
    SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, CASE WHEN c.o_orderkey IS NULL THEN o.o_orderpriority ELSE c.o_orderpriority END AS o_orderpriority FROM orders o LEFT JOIN c ON c.o_orderkey = o.o_orderkey AND c.o_custkey = o.o_custkey"""
)
def update_by_keys(spark, sf_dir):
    """Orders with the priority of every third set, some to nothing; changes of orders that aren't there do nothing."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    changes = o.where("o_orderkey % 3 = 0").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 6 != 0, "late").alias("o_orderpriority"))
    absent = changes.withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    return sinks.update_rows(o, changes.unionByName(absent), ["o_orderkey", "o_custkey"], ["o_orderpriority"])


@query("SELECT o_custkey AS key FROM orders INTERSECT SELECT s_suppkey FROM supplier")
def keys_in_both(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key")).intersect(read(spark, sf_dir, "supplier").select("s_suppkey"))


@query("SELECT c_custkey AS key FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 200000")
def keys_in_one(spark, sf_dir):
    return read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")).subtract(read(spark, sf_dir, "orders").where("o_totalprice > 200000").select("o_custkey"))


@query("SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus, l_linenumber)")
def rollup_counts(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    return li.rollup("l_returnflag", "l_linestatus", "l_linenumber").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, true AS near FROM lineitem GROUP BY l_returnflag")
def approximate_distinct(spark, sf_dir):
    """Whether the estimate of different parts lies within a tenth of their number."""
    g = read(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"), F.approx_count_distinct("l_partkey", 0.02).alias("e"))
    return g.select("l_returnflag", "parts", (F.abs(F.col("e") - F.col("parts")) <= F.col("parts") / 10).alias("near"))
