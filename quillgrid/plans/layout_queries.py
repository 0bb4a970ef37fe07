"""Queries on positions and structure: grids, clusters, boxes, templates, classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillgrid.functions import boxes as B
from quillgrid.operators import grid as G
from quillgrid.operators import relational as R
from quillgrid.plans.catalogue import query, read

_BLOCKS = "b AS (SELECT user_id, event_id, floor(value)::DOUBLE AS y, (event_id % 97)::DOUBLE AS x FROM events)"


def blocks(spark, sf_dir):
    return read(spark, sf_dir, "events").select("user_id", "event_id", F.floor("value").cast("double").alias("y"), (F.col("event_id") % 97).cast("double").alias("x"))


@query(
    f"""WITH {_BLOCKS}, d AS (SELECT *, y - lag(y) OVER (PARTITION BY user_id ORDER BY y, event_id) AS dy, count(*) OVER (PARTITION BY user_id) AS n,
        row_number() OVER (PARTITION BY user_id ORDER BY y, event_id) AS k FROM b),
    r AS (SELECT *, sum(CASE WHEN dy IS NULL THEN CASE WHEN y > 0 THEN 1 ELSE 0 END WHEN dy > 25 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY y, event_id ROWS UNBOUNDED PRECEDING) AS r FROM d)
    SELECT user_id, event_id, CASE WHEN n = 1 THEN 1 ELSE r END::INT AS row, row_number() OVER (PARTITION BY user_id, r ORDER BY x, k)::INT AS col FROM r"""
)
def grid_row_col(spark, sf_dir):
    return G.grid(blocks(spark, sf_dir), ["user_id"], "x", "y", "event_id", gap=25).select("user_id", "event_id", "row", "col")


def _cluster_sql(limit: str) -> str:
    return f"""WITH {_BLOCKS}, d AS (SELECT *, y - lag(y) OVER (PARTITION BY user_id ORDER BY y, event_id) AS g FROM b),
    l AS (SELECT user_id, {limit} AS lim FROM d GROUP BY user_id)
    SELECT d.user_id, d.event_id, (1 + sum(CASE WHEN g > lim THEN 1 ELSE 0 END) OVER (PARTITION BY d.user_id ORDER BY y, event_id ROWS UNBOUNDED PRECEDING))::INT AS cluster
    FROM d JOIN l ON l.user_id = d.user_id"""


for _m, _q in {"mean_std": "avg(g) + stddev_pop(g)", "median_std": "quantile_cont(g, 0.5) + stddev_pop(g)", "p75": "quantile_cont(g, 0.75)"}.items():
    query(_cluster_sql(_q), name=f"gap_clusters_{_m}")(lambda spark, sf_dir, m=_m: G.gap_clusters(blocks(spark, sf_dir), ["user_id"], "y", "event_id", m).select("user_id", "event_id", "cluster"))


@query(
    """WITH w AS (SELECT o_custkey AS line, o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS t, o_orderkey / 250.0 AS x, 4.0 + o_orderkey % 7 AS w, 4.0 * (o_orderkey % 4) AS h FROM orders),
    m AS (SELECT line, 0.55 * avg(h) FILTER (h > 0) AS lim FROM w GROUP BY line),
    g AS (SELECT w.*, lim, lead(x) OVER (PARTITION BY w.line ORDER BY x) - (x + w) AS gap FROM w JOIN m ON m.line = w.line)
    SELECT line, string_agg(t || CASE WHEN gap IS NULL THEN '' WHEN gap < lim THEN '' ELSE ' ' END, '' ORDER BY x) AS text FROM g GROUP BY line"""
)
def word_join_spacing(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    w = o.select(F.col("o_custkey").alias("line"), F.col("o_orderkey").cast("string").alias("t"), (F.col("o_orderkey") / F.lit(250.0)).alias("x"), (F.lit(4.0) + F.col("o_orderkey") % 7).alias("w"), (F.lit(4.0) * (F.col("o_orderkey") % 4)).alias("h"))
    return G.join_words(w, ["line"], "t", "x", "w", "h")


@query(
    """WITH s AS (SELECT l_orderkey, l_linenumber * 12.0 AS a, l_linenumber * 12.0 + l_quantity % 9 AS b, (l_linenumber % 2) * 20.0 AS y FROM lineitem),
    m AS (SELECT *, CASE WHEN abs(y - lag(y) OVER w) <= 5 AND a - lag(b) OVER w <= 10 AND a >= lag(a) OVER w THEN 0 ELSE 1 END AS new FROM s WINDOW w AS (PARTITION BY l_orderkey ORDER BY y, a, b)),
    i AS (SELECT *, sum(new) OVER (PARTITION BY l_orderkey ORDER BY y, a, b ROWS UNBOUNDED PRECEDING) AS seg FROM m),
    g AS (SELECT l_orderkey, seg, max(b) - min(a) AS length FROM i GROUP BY l_orderkey, seg)
    SELECT l_orderkey, count(*) AS n, round(avg(length), 6) AS mean_length, round(stddev_pop(length), 6) AS std_length FROM g GROUP BY l_orderkey"""
)
def segment_merge_lengths(spark, sf_dir):
    n = F.col("l_linenumber")
    s = read(spark, sf_dir, "lineitem").select("l_orderkey", (n * F.lit(12.0)).alias("a"), (n * F.lit(12.0) + F.col("l_quantity") % 9).alias("b"), ((n % 2) * F.lit(20.0)).alias("y"))
    m = G.merge_segments(s, ["l_orderkey"], "a", "b", "y")
    return m.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.round(F.avg("length"), 6).alias("mean_length"), F.round(F.stddev_pop("length"), 6).alias("std_length"))


# The same with one place for each of several equal segments, so that both windows of the SQL take them in one order.
query(
    """WITH s AS (SELECT l_orderkey, l_linenumber * 12.0 AS a, l_linenumber * 12.0 + l_quantity % 9 AS b, (l_linenumber % 2) * 20.0 AS y FROM lineitem),
    k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY y, a, b) AS k FROM s),
    m AS (SELECT *, CASE WHEN abs(y - lag(y) OVER w) <= 5 AND a - lag(b) OVER w <= 10 AND a >= lag(a) OVER w THEN 0 ELSE 1 END AS new FROM k WINDOW w AS (PARTITION BY l_orderkey ORDER BY k)),
    i AS (SELECT *, sum(new) OVER (PARTITION BY l_orderkey ORDER BY k ROWS UNBOUNDED PRECEDING) AS seg FROM m),
    g AS (SELECT l_orderkey, seg, max(b) - min(a) AS length FROM i GROUP BY l_orderkey, seg)
    SELECT l_orderkey, count(*) AS n, round(avg(length), 6) AS mean_length, round(stddev_pop(length), 6) AS std_length FROM g GROUP BY l_orderkey""",
    name="segment_merge_lengths_total",
)(segment_merge_lengths)


@query(
    """WITH t AS (SELECT l_orderkey, max(l_linenumber) AS needed FROM lineitem GROUP BY l_orderkey), k AS (SELECT unnest(range(0, 10)) AS k), r AS (SELECT unnest([2, 3]) AS r)
    SELECT l_orderkey, 1::INT AS row, 'key' AS cell_type, 0::INT AS repeat FROM t
    UNION ALL SELECT l_orderkey, (r + 2 * k)::INT, 'val', k::INT FROM t, r, k WHERE k = 0 OR 3 + 2 * (k - 1) < needed"""
)
def multirow_template_expand(spark, sf_dir):
    """A header row and a unit of two value rows: the unit comes again until the template has as many rows as the order has lines."""
    needed = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_linenumber").alias("needed"))
    cells = spark.createDataFrame([(s, r, "key" if r == 1 else "val") for s in ("even", "odd") for r in (1, 2, 3)], "section string, row int, cell_type string")
    section = F.when(F.col("l_orderkey") % 2 == 0, "even").otherwise("odd")
    return G.expand_template(F.broadcast(cells), needed.withColumn("section", section), ["section"], "needed").select("l_orderkey", "row", "cell_type", "repeat")


@query(
    """WITH RECURSIVE s AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
    p AS (SELECT *, coalesce(lag(k) OVER (PARTITION BY user_id, event_type ORDER BY k), 0) AS before FROM s),
    f(user_id, event_id, k, rec, st) AS (SELECT user_id, event_id, k, 1, 1::BIGINT FROM p WHERE k = 1
      UNION ALL SELECT p.user_id, p.event_id, p.k, f.rec + CASE WHEN p.before >= f.st THEN 1 ELSE 0 END, CASE WHEN p.before >= f.st THEN p.k ELSE f.st END FROM f JOIN p ON p.user_id = f.user_id AND p.k = f.k + 1)
    SELECT event_id, rec::INT AS record_no FROM f"""
)
def record_break(spark, sf_dir):
    """Events as cells, their types as columns: a record ends where a type comes that it already has."""
    return G.record_numbers(read(spark, sf_dir, "events"), ["user_id"], "event_type", ["event_id"]).select("event_id", "record_no")


@query(
    """WITH f AS (SELECT l_orderkey, l_linenumber::BIGINT AS p, max(l_quantity) < 25 AS blank FROM lineitem GROUP BY ALL),
    i AS (SELECT *, p - row_number() OVER (PARTITION BY l_orderkey, blank ORDER BY p) AS id FROM f),
    r AS (SELECT l_orderkey, min(p) AS start, count(*) AS length FROM i WHERE blank GROUP BY l_orderkey, id HAVING count(*) >= 2 AND min(p) > 1)
    SELECT l_orderkey, start, length FROM r WHERE (l_orderkey, start) IN (SELECT l_orderkey, min(start) FROM r GROUP BY l_orderkey)"""
)
def first_blank_run(spark, sf_dir):
    f = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").cast("bigint").alias("p")).agg((F.max("l_quantity") < 25).alias("blank"))
    return G.first_run(f, ["l_orderkey"], "blank", "p", least=2, after=1)


@query(
    """WITH e AS (SELECT l_orderkey, l_quantity::INT AS e FROM lineitem UNION SELECT l_orderkey, 0 FROM lineitem UNION SELECT l_orderkey, 60 FROM lineitem),
    g AS (SELECT l_orderkey, e AS start, lead(e) OVER (PARTITION BY l_orderkey ORDER BY e) - e AS length FROM e)
    SELECT l_orderkey, start, length::INT AS length FROM g WHERE length >= 10"""
)
def split_points(spark, sf_dir):
    edges = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(F.col("l_quantity").cast("int")).alias("edges"))
    return edges.select("l_orderkey", F.inline(B.split_points(F.col("edges"), F.lit(60), 10)))


@query("SELECT l_orderkey, l_linenumber, floor(1000 * l_quantity / 60.0)::INT AS x, floor(1000 * l_extendedprice / 120000.0)::INT AS y FROM lineitem")
def bbox_normalise(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", B.normalize(F.col("l_quantity"), F.lit(60.0)).alias("x"), B.normalize(F.col("l_extendedprice"), F.lit(120000.0)).alias("y"))


@query(
    """WITH t AS (SELECT l_orderkey, l_linenumber, l_linenumber * 1.0 AS x, l_quantity AS y, 3.0 AS w, 5.0 AS h, 90 * (l_linenumber % 4) AS a FROM lineitem)
    SELECT l_orderkey, l_linenumber,
      CASE a WHEN 90 THEN 100 - y - h + 7 WHEN 180 THEN 7 + x WHEN 270 THEN y + 7 ELSE x + 7 END AS bx,
      CASE a WHEN 90 THEN x + 9 WHEN 180 THEN 200 - h + 9 - y WHEN 270 THEN x + 9 ELSE y + 9 END AS by_,
      CASE WHEN a IN (90, 270) THEN h ELSE w END AS bw FROM t"""
)
def box_reorient(spark, sf_dir):
    n, lit = F.col("l_linenumber"), F.lit
    box = B.reorient(n * lit(1.0), F.col("l_quantity"), lit(3.0), lit(5.0), lit(7.0), lit(9.0), lit(100.0), lit(200.0), 90 * (n % 4))
    t = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", box.alias("b"))
    return t.select("l_orderkey", "l_linenumber", F.get("b", F.lit(0)).alias("bx"), F.get("b", F.lit(1)).alias("by_"), F.get("b", F.lit(2)).alias("bw"))


_CROP = """c AS (SELECT *, greatest(0, sx) AS x1, greatest(0, sy) AS y1, least(pw, sx + cw) AS x2, least(ph, sy + ch) AS y2 FROM t)
    SELECT p_partkey, CASE WHEN x1 < x2 AND y1 < y2 THEN x1 ELSE 0 END::INT AS x, CASE WHEN x1 < x2 AND y1 < y2 THEN y1 ELSE 0 END::INT AS y,
      CASE WHEN x1 < x2 AND y1 < y2 THEN x2 - x1 ELSE pw END::INT AS w, CASE WHEN x1 < x2 AND y1 < y2 THEN y2 - y1 ELSE ph END::INT AS h FROM c"""


def _crop_columns(df, crop):
    return df.select("p_partkey", crop.alias("c")).select("p_partkey", *(F.get("c", F.lit(i)).cast("int").alias(n) for i, n in enumerate("xywh")))


@query(f"WITH t AS (SELECT p_partkey, 100 AS pw, 80 AS ph, 100 - 3 * p_size AS sx, 3 * p_size - 25 AS sy, 20 AS cw, 80 - (3 * p_size - 25) AS ch FROM part), {_CROP}")
def anchored_crop_geometry(spark, sf_dir):
    """From the top right corner: sizes that fit, that the page cuts and, below the page, none (the whole page)."""
    s = F.col("p_size") * 3
    return _crop_columns(read(spark, sf_dir, "part"), B.anchored_crop("top_right", F.lit(100), F.lit(80), -s, s - 25, F.lit(20), F.lit(-1)))


@query(
    f"""WITH s AS (SELECT p_partkey, 90 + p_size AS pw, 71 AS ph FROM part), t AS (SELECT *, pw // 2 + trunc(pw * -0.13)::INT AS sx, ph // 2 + trunc(ph * 0.21)::INT AS sy, trunc(pw * 0.37)::INT AS cw,
      ph - (ph // 2 + trunc(ph * 0.21)::INT) AS ch FROM s), {_CROP}"""
)
def ratio_crop_geometry(spark, sf_dir):
    """From the middle of the page, by shares of it."""
    return _crop_columns(read(spark, sf_dir, "part"), B.ratio_crop("center", F.lit(90) + F.col("p_size"), F.lit(71), -0.13, 0.21, 0.37, -1))


@query("SELECT l_orderkey, l_linenumber, round(coalesce(0.9 * l_discount + (1 - 0.9) * CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax END, l_discount), 6) AS score FROM lineitem")
def score_blend(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(B.blend(F.col("l_discount"), F.when(F.col("l_linenumber") != 1, F.col("l_tax"))), 6).alias("score"))


@query("SELECT p_partkey, round_even((p_retailprice - 10) * 1.25, 2) AS px FROM part")
def canvas_to_pixels(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", B.to_pixels(F.col("p_retailprice"), F.lit(10), F.lit(1.25)).alias("px"))


@query(
    """WITH b AS (SELECT l_orderkey, l_returnflag, l_discount * 10 AS conf, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_discount DESC, l_linenumber, l_returnflag DESC) AS k FROM lineitem WHERE l_returnflag <> 'N'),
    o AS (SELECT DISTINCT l_orderkey FROM lineitem)
    SELECT o.l_orderkey, coalesce(round(conf, 6), -1) AS confidence, CASE WHEN conf > 0.5 THEN l_returnflag END AS l_returnflag FROM o LEFT JOIN b ON b.l_orderkey = o.l_orderkey AND k = 1"""
)
def classify_argmax_threshold(spark, sf_dir):
    df = read(spark, sf_dir, "lineitem").withColumn("conf", F.col("l_discount") * 10)
    out = R.choose(df, ["l_orderkey"], F.col("l_returnflag") != "N", "conf", "l_linenumber", ["l_returnflag"])
    return out.select("l_orderkey", F.round("confidence", 6).alias("confidence"), "l_returnflag")


@query(
    """WITH l AS (SELECT user_id, event_type, round(value, 6) AS v, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS k FROM events)
    SELECT user_id, event_type AS key, v FROM l WHERE k = 1"""
)
def classify_map_merge(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "event_id", F.create_map("event_type", F.round("value", 6)).alias("m"))
    return R.merge_maps(e, ["user_id"], "m", "event_id").select("user_id", F.explode("m").alias("key", "v"))


@query("SELECT user_id, round(coalesce(avg(CASE WHEN value >= 10 THEN floor(value) END), 0), 6) AS conf FROM events GROUP BY user_id")
def mean_conf_valid_only(spark, sf_dir):
    v = F.when(F.col("value") >= 10, F.floor("value"))
    return read(spark, sf_dir, "events").groupBy("user_id").agg(F.round(F.coalesce(F.avg(v), F.lit(0.0)), 6).alias("conf"))


@query(
    """SELECT l_orderkey, string_agg(l_shipmode_t, ' ' ORDER BY l_linenumber, l_shipmode_t) AS text, min(l_linenumber) AS x0, max(l_linenumber + l_quantity) AS x1, round_even(avg(l_discount * 100), 2) AS conf
    FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode_t FROM lineitem) GROUP BY l_orderkey"""
)
def line_text_bbox(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").withColumn("t", F.concat("l_returnflag", "l_linestatus"))
    words = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "t"))), lambda s: s["t"]), " ")
    return li.groupBy("l_orderkey").agg(words.alias("text"), F.min("l_linenumber").alias("x0"), F.max(F.col("l_linenumber") + F.col("l_quantity")).alias("x1"), F.bround(F.avg(F.col("l_discount") * 100), 2).alias("conf"))


@query("SELECT l_suppkey, min(l_quantity) AS lo, max(l_quantity) AS hi, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS std FROM lineitem GROUP BY l_suppkey")
def span_mean_std_features(spark, sf_dir):
    q = F.col("l_quantity")
    return read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.min(q).alias("lo"), F.max(q).alias("hi"), F.round(F.avg(q), 6).alias("mean"), F.round(F.stddev_pop(q), 6).alias("std"))


@query("SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS horiz, count(*) FILTER (l_linestatus = 'F') AS vert FROM lineitem GROUP BY l_suppkey")
def line_counts(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("horiz"), F.count_if(F.col("l_linestatus") == "F").alias("vert"))


@query(
    """WITH a AS (SELECT l_suppkey, round_even(l_quantity / 5.0, 0) * 5 AS angle, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT l_suppkey, angle FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, angle) AS k FROM a) WHERE k = 1"""
)
def dominant_bucket_mode(spark, sf_dir):
    a = read(spark, sf_dir, "lineitem").groupBy("l_suppkey", (F.bround(F.col("l_quantity") / 5, 0) * 5).alias("angle")).count()
    return a.groupBy("l_suppkey").agg(F.max_by("angle", F.struct("count", -F.col("angle"))).alias("angle"))


@query("SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events) WHERE k = 1")
def first_seen_dedup(spark, sf_dir):
    return G.first_seen(read(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id").select("event_id")


@query(
    """WITH RECURSIVE p AS (SELECT conv_id, role || (turn % 3) AS key, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
    f AS (SELECT conv_id, k, 1 AS n_rows, 1 AS n_cells, [key] AS first, [key] AS last FROM p WHERE k = 1
          UNION ALL SELECT conv_id, k, CASE WHEN joins THEN 1 ELSE n_rows + 1 END, n_cells + 1, CASE WHEN joins THEN list_append(first, key) ELSE first END, CASE WHEN joins THEN list_append(first, key) ELSE [key] END
          FROM (SELECT p.conv_id, p.k, p.key, f.n_rows, f.n_cells, f.first, f.last, f.n_rows = 1 AND NOT list_contains(f.last, p.key) AS joins FROM f JOIN p ON p.conv_id = f.conv_id AND p.k = f.k + 1))
    SELECT conv_id, max_by(n_rows, k)::INT AS n_rows, max(n_cells)::INT AS n_cells FROM f GROUP BY conv_id"""
)
def page_merge_fold(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    pages = c.select("conv_id", "turn", F.array(F.create_map(F.concat("role", (F.col("turn") % 3).cast("string")), F.col("text"))).alias("rows"))
    merged = R.page_merge(pages, ["conv_id"], "turn", "rows")
    return merged.select("conv_id", F.size("rows").alias("n_rows"), F.aggregate(F.transform("rows", F.size), F.lit(0), lambda a, b: a + b).alias("n_cells"))


@query(
    """WITH a AS (SELECT o_custkey, o_orderkey AS ka, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos FROM orders WHERE o_orderstatus = 'F'),
    b AS (SELECT o_custkey, o_orderkey AS kb, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos FROM orders WHERE o_orderstatus = 'O')
    SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.pos, b.pos)::INT AS pos, ka, kb FROM a FULL JOIN b ON a.o_custkey = b.o_custkey AND a.pos = b.pos"""
)
def positional_merge(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    side = lambda s, n: o.where(F.col("o_orderstatus") == s).select("o_custkey", F.col("o_orderkey").alias(n), F.col("o_orderkey").alias("_o"))
    return R.positional_merge(side("F", "ka"), side("O", "kb"), ["o_custkey"], "_o")
