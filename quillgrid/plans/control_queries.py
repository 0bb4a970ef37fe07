"""Queries of lists, schedules and run control."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillgrid.functions import text as T
from quillgrid.operators import listing as L
from quillgrid.operators import load as D
from quillgrid.operators import mapping as M
from quillgrid.operators import relational as R
from quillgrid.plans.catalogue import query, read


@query("SELECT o_custkey, count(*) AS total, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS ready, CASE WHEN count(*) = 1 THEN max(o_orderkey) END AS single FROM orders GROUP BY o_custkey")
def consumer_ready_counts(spark, sf_dir):
    n = F.count("*")
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(n.alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("ready"), F.when(n == 1, F.max("o_orderkey")).alias("single"))


@query(
    """WITH g AS (SELECT user_id, count(*) AS n, max(60 + user_id % 15) AS most FROM events GROUP BY user_id)
    SELECT event_id FROM events WHERE user_id NOT IN (SELECT user_id FROM g WHERE n >= most)"""
)
def full_groups_excluded(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("most", F.lit(60) + F.col("user_id") % 15)
    full = e.groupBy("user_id").agg(F.count("*").alias("n"), F.max("most").alias("most")).where("n >= most").select("user_id")
    return e.join(full, "user_id", "left_anti").select("event_id")


@query("SELECT o_custkey FROM orders GROUP BY o_custkey HAVING min(o_orderdate) <= max(CASE WHEN o_orderstatus = 'O' THEN o_orderdate END) - INTERVAL 100 DAY")
def stale_decisions(spark, sf_dir):
    g = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("decided"), F.max(F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate"))).alias("updated"))
    return g.where("decided <= updated - INTERVAL 100 DAYS").select("o_custkey")


@query(
    """SELECT o_orderkey, l_linenumber, l_quantity FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 20) LEFT JOIN lineitem ON l_orderkey = o_orderkey"""
)
def page_before_join(spark, sf_dir):
    """The third page of ten orders, with all lines of each."""
    o, li = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    page = L.page_then_join(o, [F.desc("o_totalprice"), F.asc("o_orderkey")], 10, 2, li, li.l_orderkey == o.o_orderkey)
    return page.select("o_orderkey", "l_linenumber", "l_quantity")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END NULLS FIRST, o_orderkey) AS place FROM orders")
def none_first_places(spark, sf_dir):
    """Every order's place, those without a price first."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("price"))
    return D.assign_keys(o, "place", ["price", "o_orderkey"]).select("o_orderkey", F.col("place").cast("bigint").alias("place"))


@query(
    """WITH g AS (SELECT o_custkey, o_orderkey * 1.0 AS x, o_orderkey + 40.0 AS e, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - (o_orderkey + 40.0) AS gap FROM orders)
    SELECT o_custkey, e AS gap_start, gap FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY x) AS k FROM g WHERE gap >= 300 AND e > 500) WHERE k = 1"""
)
def contour_gap(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").cast("double").alias("x"), F.lit(40.0).alias("w"))
    return R.first_gap(o, ["o_custkey"], "x", "w", 300, 500)


@query(
    """WITH b AS (SELECT n_nationkey AS box, n_nationkey * 2.0 AS x0, n_nationkey * 2.0 + 7 AS x1, n_nationkey * 0.003 AS y0, n_nationkey * 0.003 + 0.02 AS y1 FROM nation)
    SELECT l_orderkey, l_linenumber, l_partkey, box FROM lineitem JOIN b ON l_quantity BETWEEN x0 AND x1 AND l_discount BETWEEN y0 AND y1"""
)
def points_in_rectangles(spark, sf_dir):
    k = F.col("n_nationkey")
    boxes = read(spark, sf_dir, "nation").select(k.alias("box"), (k * F.lit(2.0)).alias("x0"), (k * F.lit(2.0) + 7).alias("x1"), (k * F.lit(0.003)).alias("y0"), (k * F.lit(0.003) + 0.02).alias("y1"))
    return R.points_in_boxes(read(spark, sf_dir, "lineitem"), boxes, "l_quantity", "l_discount", 0.01).select("l_orderkey", "l_linenumber", "l_partkey", "box")


@query(
    """WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS part FROM lineitem)
    SELECT l_orderkey, (row_number() OVER (PARTITION BY l_orderkey ORDER BY part, l_linenumber, l_partkey) - 1)::INT AS map_index, l_partkey FROM s"""
)
def concat_sequences(spark, sf_dir):
    """Two mapped sequences of an order as one: the returned lines, then the others."""
    part = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.struct("l_linenumber", "l_partkey"))))
    both = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.concat(part(F.col("l_returnflag") == "R"), part(F.col("l_returnflag") != "R")).alias("s"))
    return both.select("l_orderkey", F.posexplode("s").alias("map_index", "v")).select("l_orderkey", "map_index", "v.l_partkey")


@query("SELECT conv_id, string_agg(coalesce(role, '') || '#' || turn, ',' ORDER BY turn, role) AS pages FROM conversations GROUP BY conv_id")
def pages_by_file(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"))
    pages = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return c.groupBy("conv_id").agg(F.array_join(F.transform(pages, lambda p: F.concat(p["role"], F.lit("#"), p["turn"].cast("string"))), ",").alias("pages"))


@query(
    """SELECT o_custkey, string_agg(o_orderpriority, ' ' ORDER BY o_orderkey) FILTER (o_orderkey % 5 > 0) AS text, coalesce(round(avg(CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 100 END), 6), 0) AS conf
    FROM orders GROUP BY o_custkey HAVING count(*) FILTER (o_orderkey % 5 > 0) > 0"""
)
def cell_text_conf(spark, sf_dir):
    """Words of a cell with their mean confidence, without those that weren't recognised."""
    w = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderpriority").alias("t"), F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderkey") % 100).otherwise(-1).alias("c")).where("c > -1 and trim(t) <> ''")
    words = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "t"))), lambda s: s["t"]), " ")
    return w.groupBy("o_custkey").agg(words.alias("text"), F.round(F.avg("c"), 6).alias("conf"))


@query("SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL")
def concurrency_map(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(F.count("*").alias("n"))


@query(
    """SELECT c_mktsegment, CASE WHEN o_totalprice > 100000 THEN 'high' ELSE 'low' END AS band, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS running, min(o_orderdate) AS first, max(o_orderdate) AS last
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY ALL"""
)
def conditional_counts(spark, sf_dir):
    o, c = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    j = o.join(c, c.c_custkey == o.o_custkey, "left").withColumn("band", F.when(F.col("o_totalprice") > 100000, "high").otherwise("low"))
    return j.groupBy("c_mktsegment", "band").agg(F.count_if(F.col("o_orderstatus") == "O").alias("running"), F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))


@query(
    """SELECT 'status' AS kind, o_orderstatus AS name, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' GROUP BY o_orderstatus
    UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' GROUP BY o_orderpriority"""
)
def historical_metrics(spark, sf_dir):
    """Counts by both keys from one scan: each row is counted once per kind."""
    o = read(spark, sf_dir, "orders").where("o_orderdate >= TIMESTAMP'1995-01-01'")
    kinds = F.inline(F.array(F.struct(F.lit("status").alias("kind"), F.col("o_orderstatus").alias("name")), F.struct(F.lit("priority").alias("kind"), F.col("o_orderpriority").alias("name"))))
    return o.select(kinds).groupBy("kind", "name").agg(F.count("*").alias("n"))


@query(
    """SELECT year(o_orderdate)::INT AS year, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS mean, max(o_totalprice) AS most FROM orders GROUP BY ALL"""
)
def group_multi_aggregate(spark, sf_dir):
    p = F.col("o_totalprice")
    return read(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"), "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum(p), 2).alias("total"), F.round(F.avg(p), 4).alias("mean"), F.max(p).alias("most"))


@query("SELECT (SELECT count(*) FROM nation WHERE n_name = 'nowhere') > 0 AS a, (SELECT count(*) FROM nation WHERE n_regionkey = 1) > 0 AS b")
def existence_check(spark, sf_dir):
    n = read(spark, sf_dir, "nation")
    return n.agg((F.count_if(F.col("n_name") == "nowhere") > 0).alias("a"), (F.count_if(F.col("n_regionkey") == 1) > 0).alias("b"))


@query(
    """WITH l AS (SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1)
    SELECT event_id, e.event_type, l.event_type AS latest_event_type FROM events e JOIN l ON l.user_id = e.user_id"""
)
def latest_back_join(spark, sf_dir):
    return R.latest_joined(read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], ["event_type"]).select("event_id", "event_type", "latest_event_type")


@query("SELECT s_name, n_name, r_name FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey WHERE r_name LIKE 'A%'")
def asked_relation_join(spark, sf_dir):
    """The relation is asked for something, so rows without it go."""
    s, n, r = (read(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return R.optional_join(s.join(n, n.n_nationkey == s.s_nationkey), r, r.r_regionkey == n.n_regionkey, F.col("r_name").startswith("A")).select("s_name", "n_name", "r_name")


@query("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey")
def unasked_relation_join(spark, sf_dir):
    c, o = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    return R.optional_join(c, o, o.o_custkey == c.c_custkey, None).select("c_custkey", "o_orderkey")


@query(
    """SELECT p_partkey FROM part WHERE contains(lower(p_name), lower(split_part(p_name, ' ', 1))) AND lower(p_type) LIKE '%e%' AND lower(p_type) LIKE '%a%' AND NOT starts_with(lower(p_brand), 'brand#1') AND p_retailprice > 905"""
)
def store_filters(spark, sf_dir):
    """Filters of a store in a chain: all tokens in any case, not a prefix, a number above."""
    allowed = {"p_type": ["contains"], "p_brand": ["not_starts_with"], "p_retailprice": ["greater"]}
    return L.apply_all(read(spark, sf_dir, "part"), [("p_type", "contains", ["E", "a"]), ("p_brand", "not_starts_with", "Brand#1"), ("p_retailprice", "greater", "905")], allowed).select("p_partkey")


@query(
    """SELECT event_id, to_timestamp(epoch(TIMESTAMP '2023-12-31 05:00:00') + floor((epoch(date_trunc('second', ts)) - epoch(TIMESTAMP '2023-12-31 05:00:00')) / 25200) * 25200)::TIMESTAMP AS start,
      to_timestamp(epoch(TIMESTAMP '2023-12-31 05:00:00') + floor((epoch(date_trunc('second', ts)) - epoch(TIMESTAMP '2023-12-31 05:00:00')) / 25200) * 25200 + 25200)::TIMESTAMP AS stop FROM events"""
)
def delta_timetable(spark, sf_dir):
    """Intervals of seven hours from a start."""
    start, stop = M.delta_intervals(F.col("ts"), "2023-12-31 05:00:00", "7 HOURS")
    return read(spark, sf_dir, "events").select("event_id", start.cast("timestamp_ntz").alias("start"), stop.cast("timestamp_ntz").alias("stop"))


@query(
    """SELECT event_id, (SELECT min(t) FROM (VALUES (TIMESTAMP '2024-01-03'), (TIMESTAMP '2024-01-10 12:00:00'), (TIMESTAMP '2024-01-20')) AS s(t) WHERE t >= ts) AS event FROM events"""
)
def events_timetable(spark, sf_dir):
    e = M.next_event(read(spark, sf_dir, "events"), "ts", ["2024-01-10 12:00:00", "2024-01-03 00:00:00", "2024-01-20 00:00:00"])
    return e.select("event_id", F.col("event").cast("timestamp_ntz").alias("event"))


@query(
    """SELECT user_id, bool_or(value > 50 AND event_type IN ('click', 'view')) AS any_ready, bool_or(value > 50 AND event_type = 'click') AND bool_or(value > 50 AND event_type = 'view') AS all_ready FROM events GROUP BY user_id"""
)
def dataset_conditions(spark, sf_dir):
    return M.conditions(read(spark, sf_dir, "events"), ["user_id"], "event_type", F.col("value") > 50, ["click", "view"])


@query(
    """SELECT o_orderkey, task, CASE WHEN task = CASE WHEN isodow(o_orderdate) >= 6 THEN 'weekend' ELSE 'weekday' END THEN 'run' ELSE 'skipped' END AS state FROM orders, (VALUES ('weekend'), ('weekday')) AS t(task)"""
)
def branch_day_of_week(spark, sf_dir):
    choice = F.when(F.weekday("o_orderdate") >= 5, "weekend").otherwise("weekday")
    return M.branch(read(spark, sf_dir, "orders"), choice, ["weekend", "weekday"]).select("o_orderkey", "task", "state")


_NAMES = ["eng", "zh_tra", "kor", "tl", "bo", "ENG", "독일어", " ko"]


@query(
    "SELECT n_nationkey, CASE n_nationkey % 8 "
    + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(["en", "zh-TW", "ko", "fil", "", "", "de", ""]))
    + " END AS code FROM nation"
)
def language_codes(spark, sf_dir):
    names = F.array(*map(F.lit, _NAMES))
    return read(spark, sf_dir, "nation").select("n_nationkey", T.language_code(F.get(names, (F.col("n_nationkey") % 8).cast("int"))).alias("code"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN CASE WHEN lang IN ('en', 'ko', 'ja', 'es', 'fr', 'de', 'ru', 'ar', 'pt') THEN lang ELSE '' END ELSE '' END AS code FROM documents")
def document_language_codes(spark, sf_dir):
    """Names are looked up as they are: in capitals, or with a space, they are unknown."""
    lang = F.when(F.col("doc_id") % 3 == 0, F.col("lang")).when(F.col("doc_id") % 3 == 1, F.upper("lang")).otherwise(F.concat(F.lit(" "), "lang"))
    return read(spark, sf_dir, "documents").select("doc_id", T.language_code(lang).alias("code"))


@query("SELECT event_id FROM events WHERE coalesce(CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 2 END, -1) = 0")
def leaf_blocks(spark, sf_dir):
    """Blocks without children; one whose number isn't known is no leaf."""
    e = read(spark, sf_dir, "events").withColumn("child", F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 2))
    return e.where("coalesce(child, -1) = 0").select("event_id")
