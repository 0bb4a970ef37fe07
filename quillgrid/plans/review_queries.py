"""Checks, mapping, loading, export and translation queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillgrid.operators import checks as C
from quillgrid.operators import load as D
from quillgrid.functions import text as T
from quillgrid.operators import mapping as M
from quillgrid.operators import review as V
from quillgrid.operators.relational import work_folder
from quillgrid.plans.catalogue import query, read
from quillgrid.sources import workbook as W
from quillgrid.sources.transactions import Tables


@query(
    """WITH m AS (SELECT sum(CASE WHEN l_tax IS NULL THEN 1 ELSE 0 END)::DOUBLE AS a, min(l_quantity)::DOUBLE AS b, max(l_discount)::DOUBLE AS c, (count(l_orderkey) - count(DISTINCT l_orderkey))::DOUBLE AS d FROM lineitem)
    SELECT 'l_tax' AS column_name, 'null_check' AS check_name, a AS value, a = 0 AS passed FROM m UNION ALL SELECT 'l_quantity', 'min', b, b >= 1 FROM m
    UNION ALL SELECT 'l_discount', 'max', c, c <= 0.1 * 1.1 FROM m UNION ALL SELECT 'l_orderkey', 'unique_check', d, d = 0 FROM m"""
)
def column_checks(spark, sf_dir):
    rules = {"l_tax": {"null_check": {"equal_to": 0}}, "l_quantity": {"min": {"geq_to": 1}}, "l_discount": {"max": {"leq_to": 0.1, "tolerance": 0.1}}, "l_orderkey": {"unique_check": {"equal_to": 0}}}
    return C.column_checks(read(spark, sf_dir, "lineitem"), rules)


@query(
    """SELECT 'rows' AS check_name, count(*) > 1000 AS passed FROM lineitem UNION ALL SELECT 'dates', min(CASE WHEN l_shipdate >= TIMESTAMP '1992-01-01' THEN 1 ELSE 0 END) = 1 FROM lineitem
    UNION ALL SELECT 'cheap', min(CASE WHEN l_extendedprice < 5000 THEN 1 ELSE 0 END) = 1 FROM lineitem"""
)
def table_checks(spark, sf_dir):
    return C.table_checks(read(spark, sf_dir, "lineitem"), {"rows": "count(*) > 1000", "dates": "l_shipdate >= TIMESTAMP '1992-01-01'", "cheap": "l_extendedprice < 5000"})


@query("SELECT avg_q, avg_q BETWEEN 25 * 0.8 AND 25 * 1.2 AS passed FROM (SELECT round(avg(l_quantity), 4) AS avg_q FROM lineitem)")
def value_check(spark, sf_dir):
    return C.value_check(read(spark, sf_dir, "lineitem").agg(F.round(F.avg("l_quantity"), 4).alias("avg_q")), 25, 0.2)


@query(
    """WITH m AS (SELECT count(CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN event_id END)::DOUBLE AS a, count(CASE WHEN CAST(ts AS DATE) = DATE '2024-01-03' THEN event_id END)::DOUBLE AS b FROM events)
    SELECT 'n' AS metric, a AS current, b AS reference, greatest(a, b) / nullif(least(a, b), 0) AS ratio, coalesce(greatest(a, b) / nullif(least(a, b), 0) < 1.5, true) AS passed FROM m"""
)
def interval_check(spark, sf_dir):
    return C.interval_check(read(spark, sf_dir, "events"), "ts", {"n": "count(event_id)"}, "2024-01-10", 7, {"n": 1.5})


@query("SELECT max(o_totalprice)::DOUBLE AS value, 0.0::DOUBLE AS low, (avg(o_totalprice) * 10)::DOUBLE AS high, max(o_totalprice) BETWEEN 0 AND avg(o_totalprice) * 10 AS passed FROM orders")
def threshold_check(spark, sf_dir):
    return C.threshold_check(read(spark, sf_dir, "orders"), "max(o_totalprice)", 0.0, F.avg("o_totalprice") * 10)


@query("SELECT count(*) > 0 AND min(l_quantity) <> 0 AS passed FROM lineitem")
def all_truthy_check(spark, sf_dir):
    return C.all_truthy(read(spark, sf_dir, "lineitem").agg((F.count("*") > 0).alias("a"), F.min("l_quantity").alias("b")))


@query("SELECT p_partkey, 'size' AS rule FROM part WHERE NOT p_size < 40 UNION ALL SELECT p_partkey, 'price' FROM part WHERE NOT p_retailprice > 910")
def config_violations(spark, sf_dir):
    return C.rule_violations(read(spark, sf_dir, "part"), "p_partkey", {"size": "p_size < 40", "price": "p_retailprice > 910"})


@query(
    """SELECT n_nationkey, a, b, (ai * 3 + bi)::INT AS map_index FROM nation, (VALUES (0, 'x'), (1, 'y')) AS s(ai, a), (VALUES (0, 1), (1, 2), (2, 3)) AS t(bi, b)"""
)
def map_cartesian(spark, sf_dir):
    lists = {"a": F.array(F.lit("x"), F.lit("y")), "b": F.array(F.lit(1), F.lit(2), F.lit(3))}
    return M.cartesian(lists, read(spark, sf_dir, "nation"), ["n_nationkey"])


def _lists(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.when(F.col("l_returnflag") == "N", F.col("l_linenumber")))).alias("a"),
        F.array_sort(F.collect_list(F.when(F.col("l_returnflag") != "N", F.col("l_linenumber")))).alias("b"),
    )


_ZIP = """WITH s AS (SELECT l_orderkey, l_linenumber, l_returnflag = 'N' AS f, row_number() OVER (PARTITION BY l_orderkey, l_returnflag = 'N' ORDER BY l_linenumber) AS k FROM lineitem)
    SELECT coalesce(x.l_orderkey, y.l_orderkey) AS l_orderkey, x.l_linenumber AS a, y.l_linenumber AS b FROM (SELECT * FROM s WHERE f) x {} JOIN (SELECT * FROM s WHERE NOT f) y ON x.l_orderkey = y.l_orderkey AND x.k = y.k"""


@query(_ZIP.format(""))
def map_zip(spark, sf_dir):
    return _lists(spark, sf_dir).select("l_orderkey", F.inline(M.zipped(F.col("a"), F.col("b"), False)))


@query(_ZIP.format("FULL"))
def map_zip_longest(spark, sf_dir):
    return _lists(spark, sf_dir).select("l_orderkey", F.inline(M.zipped(F.col("a"), F.col("b"), True)))


_UP = "CASE event_type WHEN 'click' THEN 'success' WHEN 'view' THEN 'failed' WHEN 'error' THEN 'skipped' ELSE 'upstream_failed' END"


@query(
    f"""WITH c AS (SELECT user_id, count(*) AS n, count(*) FILTER (st = 'success') AS s, count(*) FILTER (st = 'failed') AS f, count(*) FILTER (st = 'upstream_failed') AS u, count(*) FILTER (st = 'skipped') AS k, count(*) AS d
      FROM (SELECT user_id, {_UP} AS st FROM events) GROUP BY user_id) """
    + " UNION ALL ".join(f"SELECT user_id, '{r}' AS rule, ({q}) AS ready FROM c" for r, q in M.TRIGGER_RULES.items())
)
def trigger_rule_eval(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", F.expr(_UP).alias("state"))
    return M.trigger(e, ["user_id"], "state")


@query("SELECT date_trunc('hour', ts)::TIMESTAMP AS start, date_trunc('hour', ts)::TIMESTAMP + INTERVAL 1 HOUR AS stop, count(*) AS n FROM events GROUP BY ALL")
def data_interval_buckets(spark, sf_dir):
    start, stop = M.intervals(F.col("ts"), "hour")
    return read(spark, sf_dir, "events").groupBy(start.cast("timestamp_ntz").alias("start"), stop.cast("timestamp_ntz").alias("stop")).agg(F.count("*").alias("n"))


@query("SELECT user_id, event_type AS status FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def run_state_latest(spark, sf_dir):
    return M.last_status(read(spark, sf_dir, "events").withColumnRenamed("event_type", "status"), "user_id", "status", "ts", "event_id").select("user_id", "status")


@query("SELECT user_id, 'E' AS status FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1 AND event_type IN ('click', 'view')")
def requeue_unfinished(spark, sf_dir):
    return M.requeue(read(spark, sf_dir, "events").withColumnRenamed("event_type", "status"), "user_id", "status", "ts", "event_id", ["click", "view"])


@query("SELECT l_orderkey, " + ", ".join(f"coalesce(max(CASE WHEN l_linenumber = {i} THEN l_returnflag END), '') AS col_{i}" for i in range(1, 8)) + " FROM lineitem GROUP BY l_orderkey")
def wide_export_sorted_keys(spark, sf_dir):
    cells = read(spark, sf_dir, "lineitem").select("l_orderkey", F.concat(F.lit("col_"), F.col("l_linenumber").cast("string")).alias("name"), F.col("l_returnflag").alias("value"))
    return D.wide(cells, ["l_orderkey"], "name", "value", [f"col_{i}" for i in (3, 1, 7, 2, 6, 5, 4)])


@query(
    """WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) + 1000 AS pk FROM orders WHERE o_orderstatus = 'F')
    SELECT pk, l_linenumber, row_number() OVER (PARTITION BY pk ORDER BY l_linenumber)::INT AS child_no FROM lineitem JOIN p ON o_orderkey = l_orderkey"""
)
def hierarchical_keys(spark, sf_dir):
    parents = D.assign_keys(read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey"), "pk", ["o_orderkey"], 1000)
    children = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    rows = D.child_rows(children, parents, ["o_orderkey"], "pk")
    return D.assign_keys(rows, "child_no", ["l_linenumber"], 0, ["pk"]).select("pk", "l_linenumber", F.col("child_no").cast("int"))


_INSERT = """o AS (SELECT o_custkey AS doc_id, o_orderkey FROM orders), c AS (SELECT doc_id, count(*) AS n FROM o GROUP BY doc_id),
    roots AS (SELECT doc_id, 1 AS id, row_number() OVER (ORDER BY doc_id) + 100 AS pk FROM c WHERE n <= 9 AND n % 2 = 1),
    mid AS (SELECT o.doc_id, o.o_orderkey AS id, row_number() OVER (ORDER BY o.doc_id, o.o_orderkey) AS pk, roots.pk AS parent_pk FROM o JOIN roots ON roots.doc_id = o.doc_id),
    l AS (SELECT o.doc_id, l_orderkey, row_number() OVER (PARTITION BY o.doc_id ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS id FROM lineitem JOIN o ON o_orderkey = l_orderkey),
    leaf AS (SELECT l.doc_id, l.id, row_number() OVER (ORDER BY l.doc_id, l.id) AS pk, mid.pk AS parent_pk FROM l JOIN mid ON mid.doc_id = l.doc_id AND mid.id = l.l_orderkey)"""


def _insert(spark, sf_dir):
    """Three levels: a customer's head rows (one; two for an even number of orders, which is an error, and none for more than nine), orders, lines."""
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("_id"))
    heads = o.groupBy("doc_id").agg(F.count("*").alias("n")).where("n <= 9")
    numbers = F.sequence(F.lit(1), F.when(F.col("n") % 2 == 1, 1).otherwise(2)).cast("array<bigint>")
    heads = heads.select("doc_id", F.explode(numbers).alias("_id"), F.lit(0).cast("bigint").alias("_par_id"))
    mid = o.withColumn("_par_id", F.lit(1).cast("bigint"))
    li = read(spark, sf_dir, "lineitem").join(o.withColumnRenamed("_id", "_par_id"), F.col("l_orderkey") == F.col("_par_id"))
    order = Window.partitionBy("doc_id").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    leaf = li.select("doc_id", F.row_number().over(order).cast("bigint").alias("_id"), "_par_id")
    return D.insert_plan({"line": (leaf, "order"), "order": (mid, "head"), "head": (heads, None)}, {"head": 100})


@query(f"WITH {_INSERT} SELECT doc_id, 'head' AS table_name, pk FROM roots UNION ALL SELECT doc_id, 'order', pk FROM mid UNION ALL SELECT doc_id, 'line', pk FROM leaf")
def insert_complete_map(spark, sf_dir):
    return _insert(spark, sf_dir)[1]


@query(f"WITH {_INSERT} SELECT doc_id, id, pk, parent_pk FROM leaf")
def insert_third_level(spark, sf_dir):
    return _insert(spark, sf_dir)[0]["line"].select("doc_id", F.col("_id").alias("id"), F.col("pk").cast("bigint").alias("pk"), "parent_pk")


@query(
    f"""WITH {_INSERT}, cells AS (SELECT doc_id, 'head' AS table_name, pk, {{'_id': id::VARCHAR, 'doc_id': doc_id::VARCHAR, 'pk': pk::VARCHAR}} AS m, NULL::VARCHAR AS parent FROM roots
      UNION ALL SELECT doc_id, 'order', pk, {{'_id': id::VARCHAR, 'doc_id': doc_id::VARCHAR, 'pk': pk::VARCHAR}}, parent_pk::VARCHAR FROM mid
      UNION ALL SELECT doc_id, 'line', pk, {{'_id': id::VARCHAR, 'doc_id': doc_id::VARCHAR, 'pk': pk::VARCHAR}}, parent_pk::VARCHAR FROM leaf),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, table_name ORDER BY pk)::INT AS row FROM cells)
    SELECT doc_id::VARCHAR AS doc_id, table_name, row, c AS column_name, CASE c WHEN '_id' THEN m._id WHEN 'doc_id' THEN m.doc_id WHEN 'pk' THEN m.pk ELSE parent END AS value
    FROM r, (VALUES ('_id'), ('doc_id'), ('pk'), ('parent_pk')) AS v(c) WHERE c <> 'parent_pk' OR parent IS NOT NULL"""
)
def complete_map_workbooks(spark, sf_dir):
    """What was inserted for each customer, found through the list of keys, written as workbooks and read again sheet by sheet."""
    done, kept, _ = _insert(spark, sf_dir)
    catalogue = spark.createDataFrame([(i, n, c, "Y" if c == "pk" else "N") for i, n in enumerate(done) for c in ("doc_id", "pk")], "table_id int, table_name string, column_name string, is_pk string")
    numbers = catalogue.select("table_id", "table_name").distinct()
    inserted = kept.join(numbers, "table_name").select("doc_id", "table_id", F.col("pk").alias("pk_value"))
    stored = {n: d.select("doc_id", "_id", "pk", "parent_pk") for n, d in done.items()}
    folder = work_folder(spark)
    W.write_workbooks(W.read_back(inserted, catalogue, stored), folder)
    return W.read_workbooks(spark, folder)


@query(
    f"""WITH {_INSERT}, b AS (SELECT doc_id, n FROM c WHERE n > 9 OR n % 2 = 0)
    SELECT doc_id, 'head' AS table_name, i::BIGINT AS id, 'several roots' AS reason FROM b, (VALUES (1), (2)) AS v(i) WHERE n <= 9
    UNION ALL SELECT o.doc_id, 'order', o_orderkey, 'parent missing' FROM o JOIN b ON b.doc_id = o.doc_id
    UNION ALL SELECT l.doc_id, 'line', id, 'parent missing' FROM l JOIN b ON b.doc_id = l.doc_id"""
)
def insert_violations(spark, sf_dir):
    return _insert(spark, sf_dir)[2].withColumnRenamed("_id", "id")


@query("SELECT l_orderkey * 10 + l_linenumber AS id, 'parent missing' AS reason FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def hierarchy_violations(spark, sf_dir):
    children = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    return D.violations(children, read(spark, sf_dir, "orders").where("o_orderstatus = 'F'"), ["o_orderkey"], "id")


@query(
    """WITH t AS (SELECT d.* FROM documents d WHERE doc_id NOT IN (SELECT doc_id FROM labels)), c AS (SELECT CAST(doc_id AS VARCHAR) AS row_key, 'lang' AS column_name, lang AS text FROM t UNION ALL SELECT CAST(doc_id AS VARCHAR), 'source', source FROM t),
    w AS (SELECT * FROM c WHERE trim(text) <> '' AND text <> 'en')
    SELECT 'documents' AS table_name, row_key, column_name, text FROM w UNION ALL SELECT 'documents', CAST(doc_id AS VARCHAR), NULL, NULL FROM t WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT row_key FROM w)"""
)
def translation_log_rows(spark, sf_dir):
    log = read(spark, sf_dir, "labels").select(F.lit("documents").alias("table_name"), F.col("doc_id").alias("row_key"))
    return D.translation_rows(read(spark, sf_dir, "documents"), "doc_id", "documents", ["lang", "source"], F.col("text") != "en", log)


@query(
    """WITH l AS (SELECT s_nationkey AS doc, s_suppkey AS id, s_suppkey % 4 = 0 AS model, s_suppkey % 3 <> 0 AS mask, s_suppkey % 5 <> 0 AS template, EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity > 45) AS has
      FROM supplier WHERE s_suppkey % 3 > 0)
    SELECT n_nationkey AS doc_class_id, NULL::BIGINT AS layout_class_id, 'active layouts' AS rule, NULL::VARCHAR AS detail FROM nation WHERE n_nationkey NOT IN (SELECT doc FROM l)
    UNION ALL SELECT doc, id, 'IMG_PREPROCESS_INFO', NULL FROM l WHERE id % 8 = 1 UNION ALL SELECT doc, id, 'CLASSIFY_AI_INFO', NULL FROM l WHERE id % 10 < 2
    UNION ALL SELECT doc, id, 'model', 'class/' || doc || '/' || id || '/classify/model' FROM l WHERE NOT model
    UNION ALL SELECT doc, id, 'sections', NULL FROM l WHERE NOT has
    UNION ALL SELECT doc, id, 'template file', 'template/' || id || '.png' FROM l WHERE has AND id % 2 = 0 AND NOT template
    UNION ALL SELECT doc, id, 'mask image', 'class/' || doc || '/' || id || '/classify/asset/mask_image.png' FROM l WHERE has AND id % 11 = 0"""
)
def config_rules(spark, sf_dir):
    """Nations as document classes, suppliers as their layouts, lines of large quantity as sections; the files are made up from the suppliers' keys."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    k = F.col("s_suppkey")
    layouts = s.select(
        F.col("s_nationkey").alias("doc_class_id"), k.alias("layout_class_id"), F.when(k % 3 > 0, "Y").otherwise("N").alias("use_yn"), F.when(k % 8 != 1, "{}").otherwise(" ").alias("img_preprocess_info"),
        F.when(k % 10 >= 2, "{}").alias("classify_ai_info"), F.lit("").alias("ai_model_dir"), F.when(k % 2 == 0, F.concat(F.lit("template/"), k.cast("string"), F.lit(".png"))).alias("template_file_path"),
    )
    own = F.concat(F.lit("class/"), F.col("s_nationkey").cast("string"), F.lit("/"), k.cast("string"), F.lit("/classify/"))
    paths = F.array(F.when(k % 4 == 0, F.concat(own, F.lit("model/m.json"))), F.when(k % 11 != 0, F.concat(own, F.lit("asset/mask_image.png"))), F.when(k % 5 != 0, F.concat(F.lit("template/"), k.cast("string"), F.lit(".png"))))
    files = s.select(F.explode(paths).alias("path")).where("path IS NOT NULL")
    sections = read(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_suppkey").alias("layout_class_id"))
    return V.config_violations(read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("doc_class_id")), layouts, sections, files, "class")


_EDITS = """e AS (SELECT CASE WHEN l_linenumber = 1 THEN 'head' ELSE 'lines' END AS section, CASE WHEN l_linenumber < 2 THEN l_linenumber ELSE (l_linenumber - 2) % 2 + 2 END AS row, l_orderkey % 4 + 1 AS col,
    replace(l_returnflag || ' ' || l_linestatus, ' ', '') AS error_text, CASE WHEN l_quantity > 25 THEN replace(l_returnflag || ' ' || l_linestatus, ' ', '') ELSE 'c' || (l_quantity::INT % 3) END AS correct_text FROM lineitem),
    b AS (SELECT section, row, col, section || row || col AS block_id FROM (VALUES ('head', 1), ('lines', 2), ('lines', 3)) AS s(section, row), (VALUES (1), (2), (3)) AS c(col)),
    p AS (SELECT e.*, block_id FROM e LEFT JOIN b USING (section, row, col) WHERE error_text <> correct_text)"""


def _corrections(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    error = F.concat("l_returnflag", F.lit(" "), "l_linestatus")
    edits = li.select(
        F.when(F.col("l_linenumber") == 1, "head").otherwise("lines").alias("section"), F.col("l_linenumber").alias("row"), (F.col("l_orderkey") % 4 + 1).alias("col"), error.alias("error_text"),
        F.when(F.col("l_quantity") > 25, error).otherwise(F.concat(F.lit(" c "), (F.col("l_quantity").cast("int") % 3).cast("string"))).alias("correct_text"),
    )
    sizes = spark.createDataFrame([("lines", 2, 2)], "section string, first int, step int")
    blocks = spark.createDataFrame([(s, r, c, f"{s}{r}{c}") for s, r in (("head", 1), ("lines", 2), ("lines", 3)) for c in (1, 2, 3)], "section string, row int, col int, block_id string")
    known = spark.createDataFrame([("head11", "NO", "c2"), ("lines21", "RF", "c0")], "block_id string, error_text string, correct_text string")
    return V.corrections(edits, sizes, blocks, known)


@query(
    f"""WITH {_EDITS}, n AS (SELECT block_id, error_text, max(correct_text) AS correct_text FROM p WHERE block_id IS NOT NULL GROUP BY ALL)
    SELECT * FROM n WHERE (block_id, error_text, correct_text) NOT IN (VALUES ('head11', 'NO', 'c2'), ('lines21', 'RF', 'c0'))"""
)
def review_corrections(spark, sf_dir):
    """Edits of repeated rows counted for the template's row, without spaces, as new entries of the block dictionary."""
    return _corrections(spark, sf_dir)[0]


@query(f"WITH {_EDITS} SELECT section, row, col, error_text, correct_text, count(*) AS n FROM p WHERE block_id IS NULL GROUP BY ALL")
def review_corrections_unplaced(spark, sf_dir):
    return _corrections(spark, sf_dir)[1].groupBy("section", "row", "col", "error_text", "correct_text").agg(F.count("*").alias("n"))


def _capitals(texts, langs):
    """Stands for a translator: capitals with the language before them; Spanish fails."""
    return [V.FAILED if lang == "es" else f"{lang}:{t.upper()}" for t, lang in zip(texts, langs)]


@query(
    """WITH c AS (SELECT doc_id, 'lang' AS column_name, lang AS text, lang FROM documents UNION ALL SELECT doc_id, 'source', source, '' FROM documents),
    t AS (SELECT doc_id, column_name, text AS ori_text, lang || ':' || upper(text) AS trn_text FROM c WHERE trim(text) <> '' AND lang IN ('fr', 'de') AND column_name = 'lang')
    SELECT 'documents' AS table_name, doc_id::VARCHAR AS row_key, column_name, ori_text, trn_text FROM t
    UNION ALL SELECT 'documents', doc_id::VARCHAR, 'doc_id', doc_id::VARCHAR, doc_id::VARCHAR FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM t)"""
)
def translation_with_hook(spark, sf_dir):
    """Documents' short columns through a translator, twice: the second time the log has all of them. English stays, Spanish fails."""
    tables = Tables(spark, work_folder(spark))
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    for run in ("first", "second"):
        log = V.translate_tables(tables, [("gone", None, "id"), ("documents", docs, "doc_id")], lambda c: F.when(c != 'en', T.language_code(c)).otherwise(''), _capitals, run)
    return log.select("table_name", "row_key", F.when(F.col("column_name") == "doc_id", "doc_id").otherwise(F.col("column_name")).alias("column_name"), "ori_text", "trn_text")
