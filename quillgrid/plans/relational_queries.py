"""Catalogue joins, choices, aggregations and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillgrid.operators import listing as L
from quillgrid.operators import relational as R
from quillgrid.operators import relations as N
from quillgrid.plans.catalogue import query, read


@query("SELECT r_name, n_name, s_suppkey, s_name FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey")
def layout_section_view(spark, sf_dir):
    r, n, s = (read(spark, sf_dir, t) for t in ("region", "nation", "supplier"))
    return s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select("r_name", "n_name", "s_suppkey", "s_name")


@query("SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey")
def block_left_chain(spark, sf_dir):
    o, c, n = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return o.join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left").select("o_orderkey", "c_name", "n_name")


@query("SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k = 1")
def latest_scalar_lookup(spark, sf_dir):
    return R.latest_value(read(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id")


@query("SELECT DISTINCT n_name, p_brand FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN lineitem ON l_suppkey = s_suppkey JOIN part ON p_partkey = l_partkey")
def related_tables_distinct(spark, sf_dir):
    s, n, l, p = (read(spark, sf_dir, t) for t in ("supplier", "nation", "lineitem", "part"))
    # distinct pairs of keys first: the fact table shrinks before it meets names
    keys = l.select("l_suppkey", "l_partkey").distinct()
    named = keys.join(s, keys.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey).join(p, keys.l_partkey == p.p_partkey)
    return named.select("n_name", "p_brand").distinct()


@query(
    """SELECT c_custkey, o_orderkey, n_name FROM customer LEFT JOIN (orders JOIN nation ON n_nationkey = o_orderkey % 25) ON o_custkey = c_custkey
    WHERE c_custkey IN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F')"""
)
def nested_outer_pk_lookup(spark, sf_dir):
    c, o, n = (read(spark, sf_dir, t) for t in ("customer", "orders", "nation"))
    inner = o.join(n, F.col("o_orderkey") % 25 == F.col("n_nationkey")).select("o_custkey", "o_orderkey", "n_name")
    wanted = c.join(o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")
    return wanted.join(inner, wanted.c_custkey == inner.o_custkey, "left").select("c_custkey", "o_orderkey", "n_name")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def untranslated_anti_join(spark, sf_dir):
    return R.not_in_log(read(spark, sf_dir, "documents").select("doc_id", "lang"), read(spark, sf_dir, "labels"), ["doc_id"])


@query("SELECT DISTINCT o_orderpriority, l_shipmode, p_type FROM (SELECT *, l_returnflag AS l_shipmode FROM lineitem) JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey WHERE p_size < 10")
def complete_map_distinct_join(spark, sf_dir):
    l, o, p = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders"), read(spark, sf_dir, "part").where("p_size < 10")
    j = l.join(p, l.l_partkey == p.p_partkey).join(o, l.l_orderkey == o.o_orderkey)
    return j.select("o_orderpriority", F.col("l_returnflag").alias("l_shipmode"), "p_type").distinct()


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, o_orderdate, o_orderkey LIMIT 1")
def queue_priority_top1(spark, sf_dir):
    return R.queue_head(read(spark, sf_dir, "orders"), "o_orderstatus", "o_orderdate", "o_orderkey", {"P": 1, "O": 2}, 3).select("o_orderkey", "o_orderstatus")


@query("SELECT c_custkey, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' GROUP BY c_custkey")
def multirow_minmax(spark, sf_dir):
    c, o = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return c.join(o, c.c_custkey == o.o_custkey, "left").groupBy("c_custkey").agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))


@query("SELECT p_partkey, p_type FROM part ORDER BY (p_type = 'STANDARD') DESC, p_partkey LIMIT 1")
def static_first_limit1(spark, sf_dir):
    return read(spark, sf_dir, "part").orderBy((F.col("p_type") == "STANDARD").desc(), "p_partkey").limit(1).select("p_partkey", "p_type")


@query("SELECT s_nationkey, count(*) AS n FROM supplier JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_nationkey ORDER BY n DESC, s_nationkey LIMIT 1")
def doc_class_mode(spark, sf_dir):
    s, l = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "lineitem")
    counts = l.groupBy("l_suppkey").agg(F.count("*").alias("c"))
    return counts.join(s, counts.l_suppkey == s.s_suppkey).groupBy("s_nationkey").agg(F.sum("c").alias("n")).orderBy(F.desc("n"), "s_nationkey").limit(1)


@query(
    """WITH RECURSIVE e AS (SELECT p_partkey AS node, CASE WHEN p_partkey >= 2 THEN p_partkey // 2 END AS parent FROM part WHERE p_partkey >= 1),
    up(node, ancestor, level) AS (SELECT node, parent, 1 FROM e WHERE parent IS NOT NULL UNION ALL SELECT u.node, e.parent, u.level + 1 FROM up u JOIN e ON e.node = u.ancestor WHERE e.parent IS NOT NULL)
    SELECT node, ancestor, level FROM up"""
)
def recursive_block_hierarchy(spark, sf_dir):
    edges = read(spark, sf_dir, "part").where("p_partkey >= 1").select(F.col("p_partkey").alias("node"), F.expr("CASE WHEN p_partkey >= 2 THEN p_partkey div 2 END").alias("parent"))
    return R.hierarchy(edges, "node", "parent")


@query("SELECT event_id, event_type IS NOT DISTINCT FROM 'purchase' AS success FROM events")
def success_failed_split(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.col("event_type").eqNullSafe("purchase").alias("success"))


@query(
    """SELECT o_orderkey FROM orders WHERE o_orderstatus NOT IN ('F', 'P') AND o_orderpriority LIKE '%LOW%' AND o_totalprice > 1000"""
)
def list_filter_optional(spark, sf_dir):
    o = read(spark, sf_dir, "orders").where(~F.col("o_orderstatus").isin("F", "P") & L.like("o_orderpriority", "LOW") & L.like("o_orderstatus", None))
    return L.search(o, {"o_totalprice_gt": 1000.0, "o_totalprice_lt": None, "o_comment_like": "x"}, ["o_totalprice"]).select("o_orderkey")


@query("SELECT p_partkey, p_name ILIKE 'a%' AS starts, p_name ILIKE '%e' AS ends, NOT p_name ILIKE '%or%' AS lacks FROM part")
def ilike_family(spark, sf_dir):
    n = F.col("p_name")
    return read(spark, sf_dir, "part").select("p_partkey", L.ilike(n, "starts", "A").alias("starts"), L.ilike(n, "ends", "E").alias("ends"), L.ilike(n, "contains", "OR", negate=True).alias("lacks"))


@query("SELECT p_partkey FROM part WHERE p_size > 20")
def typed_filters(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    return L.typed(L.typed(p, "p_size", "gt", "20"), "p_size", "lt", "not a number").select("p_partkey")


@query("SELECT doc_id FROM documents WHERE contains(lower(text), 'the') AND contains(lower(text), 'of')")
def all_tokens_contains(spark, sf_dir):
    return read(spark, sf_dir, "documents").where(L.all_tokens(F.col("text"), "The OF")).select("doc_id")


@query("SELECT o_orderkey, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS total FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40")
def paged_list_with_count(spark, sf_dir):
    o = read(spark, sf_dir, "orders").where("o_orderstatus = 'O'")
    total = o.agg(F.count("*").alias("total"))
    rows = L.page(L.order_by(o, ["-o_totalprice", "o_orderkey"], ["o_totalprice", "o_orderkey"]), 2, 20).select("o_orderkey")
    return rows.select("o_orderkey", total.scalar().alias("total"))


@query("SELECT o_orderkey, k AS shown FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS k FROM orders) ORDER BY k ASC NULLS LAST, o_orderkey LIMIT 50")
def nulls_last_sort(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("shown"))
    return L.order_by(o, ["shown", "o_orderkey"], ["shown", "o_orderkey"]).limit(50)


@query(
    """SELECT o_orderkey, k AS shown, row_number() OVER (ORDER BY k ASC NULLS LAST, o_orderkey) AS place
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS k FROM orders)"""
)
def nulls_last_sort_all(spark, sf_dir):
    """Every order with its place, those without a key last; nulls_last_sort is the first page of it."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("shown"))
    return L.nulls_last_places(o, "place", ["shown", "o_orderkey"])


@query("SELECT n_nationkey, n_name, CASE n_nationkey WHEN 7 THEN 0 WHEN 3 THEN 1 WHEN 11 THEN 2 END::INT AS place FROM nation WHERE n_nationkey IN (7, 3, 11)")
def in_list_order(spark, sf_dir):
    return L.in_given_order(read(spark, sf_dir, "nation"), "n_nationkey", [7, 3, 11]).select("n_nationkey", "n_name", F.col("place").cast("int"))


@query("SELECT year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, strftime(o_orderdate, '%B %Y') AS label, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY ALL")
def group_month(spark, sf_dir):
    return L.by_month(read(spark, sf_dir, "orders"), "o_orderdate", [F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean")])


@query("SELECT year(o_orderdate)::INT AS year, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL")
def group_year(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"), "o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


_STATE = "CASE event_type WHEN 'click' THEN 'running' WHEN 'view' THEN 'queued' WHEN 'error' THEN 'deferred' ELSE 'scheduled' END"


@query(
    f"""WITH i AS (SELECT user_id % 5 AS pool, {_STATE} AS state, 1 AS slots FROM events), p AS (SELECT unnest(range(0, 6)) AS pool),
    s AS (SELECT p.pool, coalesce(sum(CASE WHEN state = 'running' THEN slots END), 0)::BIGINT AS running, coalesce(sum(CASE WHEN state = 'queued' THEN slots END), 0)::BIGINT AS queued,
      coalesce(sum(CASE WHEN state = 'deferred' THEN slots END), 0)::BIGINT AS deferred, coalesce(sum(CASE WHEN state = 'scheduled' THEN slots END), 0)::BIGINT AS scheduled FROM p LEFT JOIN i ON i.pool = p.pool GROUP BY p.pool)
    SELECT pool, CASE WHEN pool = 3 THEN -1 ELSE 10000 END::INT AS total, running, queued, deferred, scheduled, CASE WHEN pool <> 3 THEN 10000 - running - queued END AS open FROM s"""
)
def pool_slot_pivot(spark, sf_dir):
    i = read(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("pool"), F.expr(_STATE).alias("state"), F.lit(1).alias("slots"))
    pools = spark.range(6).select(F.col("id").alias("pool"), F.when(F.col("id") == 3, -1).otherwise(10000).alias("total"))
    return L.slot_stats(i, pools)


@query(
    """WITH u AS (SELECT user_id, event_type FROM events WHERE value < 5 UNION ALL SELECT user_id, event_type FROM events WHERE value >= 50),
    e AS (SELECT DISTINCT user_id FROM u), s AS (SELECT unnest(['click', 'view', 'error']) AS event_type)
    SELECT e.user_id, s.event_type, count(u.user_id) AS n FROM e CROSS JOIN s LEFT JOIN u ON u.user_id = e.user_id AND u.event_type = s.event_type GROUP BY e.user_id, s.event_type"""
)
def running_last_union_zero_fill(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "event_type", "value")
    return R.union_counts([("running", e.where("value < 5")), ("last", e.where("value >= 50"))], ["user_id"], ["click", "view", "error"], "event_type")


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def calendar_counts(spark, sf_dir):
    return read(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(F.count("*").alias("n"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey)")
def having_orphans(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey")
    return R.orphans(c, "c_custkey", (read(spark, sf_dir, "orders"), "o_custkey"), (read(spark, sf_dir, "supplier"), "s_suppkey"))


@query("SELECT event_id FROM events e WHERE event_id <> (SELECT max(event_id) FROM events x WHERE x.user_id = e.user_id AND x.event_type = e.event_type) AND ts < TIMESTAMP '2024-01-15'")
def keep_last_cleanup(spark, sf_dir):
    return R.superseded(read(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id").where("ts < TIMESTAMP '2024-01-15'").select("event_id")


@query(
    """SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)
    AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey AND s_acctbal > 0)"""
)
def orphans_of_kinds(spark, sf_dir):
    """Customers without a large order who have no number of a supplier with a balance."""
    orders, suppliers = read(spark, sf_dir, "orders").where("o_totalprice > 300000"), read(spark, sf_dir, "supplier").where("s_acctbal > 0")
    return R.orphans(read(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", (orders, "o_custkey"), (suppliers, "s_suppkey"))


@query(
    """SELECT event_id, 'go on' AS way, NULL::VARCHAR AS status FROM events WHERE event_id % 7 <> 0 AND event_type = 'purchase'
    UNION ALL SELECT event_id, 'stopped', CASE WHEN event_id % 7 <> 0 THEN event_type END FROM events WHERE event_id % 7 = 0 OR event_type <> 'purchase'"""
)
def success_failed_rows(spark, sf_dir):
    """What succeeded goes on without its status; the rest, some of it without a status, stays apart."""
    e = read(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("status"))
    good, rest = R.by_status(e, "status", "purchase")
    return good.select("event_id", F.lit("go on").alias("way"), F.lit(None).cast("string").alias("status")).unionByName(rest.select("event_id", F.lit("stopped").alias("way"), "status"))


@query("SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k <= 3")
def latest_n_keep(spark, sf_dir):
    return R.keep_last(read(spark, sf_dir, "events"), ["user_id"], "event_id", 3).select("event_id")


@query("SELECT name FROM (SELECT c_name AS name FROM customer WHERE c_name LIKE '%11%' UNION SELECT s_name FROM supplier WHERE s_name LIKE '%1%') ORDER BY name LIMIT 10")
def union_distinct_search(spark, sf_dir):
    c, s = read(spark, sf_dir, "customer").select(F.col("c_name").alias("name")), read(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"))
    return c.where("name LIKE '%11%'").union(s.where("name LIKE '%1%'")).distinct().orderBy("name").limit(10)


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 5")
def having_duplicates(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).where("n > 5")


@query("SELECT user_id, event_id, lag(ts) OVER w AS previous, lead(ts) OVER w AS following FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)")
def previous_next_run(spark, sf_dir):
    from quillgrid.operators.mapping import neighbours

    return neighbours(read(spark, sf_dir, "events"), ["user_id"], "ts").select("user_id", "event_id", "previous", "following")


@query("SELECT c_custkey, CASE WHEN n < 3 THEN 'below' ELSE 'full' END AS limit_state, n FROM (SELECT c_custkey, coalesce(n, 0) AS n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey)")
def outer_count_limit(spark, sf_dir):
    n = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("k"))
    j = read(spark, sf_dir, "customer").join(n, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("k", F.lit(0)).alias("n"))
    return j.select("c_custkey", F.when(F.col("n") < 3, "below").otherwise("full").alias("limit_state"), "n")


@query("SELECT s_suppkey, max(l_shipdate) AS last_update, coalesce(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 0)::BIGINT AS updates FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_suppkey")
def dataset_last_update(spark, sf_dir):
    l = read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.max("l_shipdate").alias("last_update"), F.count_if(F.col("l_returnflag") == "R").alias("u"))
    return read(spark, sf_dir, "supplier").join(l, F.col("s_suppkey") == F.col("l_suppkey"), "left").select("s_suppkey", "last_update", F.coalesce("u", F.lit(0)).alias("updates"))


@query("SELECT l_returnflag, l_linestatus, grouping(l_returnflag, l_linestatus)::INT AS level, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def grouping_sets_cube(spark, sf_dir):
    c = read(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("n"))
    return c.select("l_returnflag", "l_linestatus", "level", "n")


@query("SELECT l_suppkey, round(quantile_cont(l_quantity, 0.75), 6) AS p75, round(quantile_cont(l_quantity, 0.5), 6) AS median FROM lineitem GROUP BY l_suppkey")
def percentile_thresholds(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.round(F.percentile("l_quantity", 0.75), 6).alias("p75"), F.round(F.percentile("l_quantity", 0.5), 6).alias("median"))


def _relations(spark, sf_dir):
    r = N.Relations({t: read(spark, sf_dir, t) for t in ("region", "nation", "customer", "supplier", "orders", "lineitem")})
    r.add("nation", "n_regionkey", "region", "r_regionkey").add("customer", "c_nationkey", "nation", "n_nationkey").add("supplier", "s_nationkey", "nation", "n_nationkey")
    return r.add("orders", "o_custkey", "customer", "c_custkey").add("lineitem", "l_orderkey", "orders", "o_orderkey", back="lines").add("lineitem", "l_suppkey", "supplier", "s_suppkey")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, cn.n_name AS orders_customer_nation_n_name, sn.n_name AS supplier_nation_n_name, cr.r_name AS orders_region_r_name
    FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation cn ON cn.n_nationkey = c_nationkey LEFT JOIN region cr ON cr.r_regionkey = cn.n_regionkey
    LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation sn ON sn.n_nationkey = s_nationkey
    WHERE cn.n_name > 'F' AND o_totalprice > 20000 AND cn.n_name IS DISTINCT FROM 'JAPAN' AND lower(sn.n_name) LIKE '%a%'"""
)
def relation_paths(spark, sf_dir):
    """Lines by the nations of their customers and of their suppliers: `nation` is met by two ways, each relation is joined once."""
    lines = _relations(spark, sf_dir).of("lineitem").where("orders.customer.nation.n_name", "gt", "F").where("orders.o_totalprice", "gt", 20000).where("orders.nation.n_name", "neq", "JAPAN")
    lines = lines.where("supplier.nation.n_name", "contains", "A").sort("-supplier.nation.n_name", "orders.customer.c_acctbal")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "orders.customer.nation.n_name", "supplier.nation.n_name", "orders.region.r_name")


@query(
    """SELECT o_orderkey, c_name AS customer_c_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    WHERE EXISTS (SELECT 1 FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE l_orderkey = o_orderkey AND n_name < 'G')
    AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')"""
)
def relation_to_many(spark, sf_dir):
    """Orders with a line from some nations' suppliers and without a returned line: conditions over many rows are semi joins."""
    orders = _relations(spark, sf_dir).of("orders").where("lines.supplier.nation.n_name", "lt", "G").where("lines.l_returnflag", "neq", "R")
    return orders.select("o_orderkey", "customer.c_name")
