"""Windows over events, and streaming runs that must equal them."""

from __future__ import annotations

import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillgrid.operators.relational import work_folder
from quillgrid.plans.catalogue import query, read
from quillgrid.sources import archive as A
from quillgrid.sources import page_source as P
from quillgrid.sources.transactions import Tables
from quillgrid.streaming import events as S
from quillgrid.streaming import runs
from quillgrid.streaming.sinks import to_end


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling(spark, sf_dir):
    return S.tumbling(read(spark, sf_dir, "events"), "1 hour").select(F.col("start").cast("timestamp_ntz"), "event_type", "n")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR * k AS start, event_type, count(*) AS n FROM events, (VALUES (0), (1)) AS o(k) GROUP BY ALL")
def sliding(spark, sf_dir):
    return S.tumbling(read(spark, sf_dir, "events"), "2 hours", "1 hour").select(F.col("start").cast("timestamp_ntz"), "event_type", "n")


@query(
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS id FROM g)
    SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, id"""
)
def session(spark, sf_dir):
    return S.sessions(read(spark, sf_dir, "events"), "6 hours").select("user_id", F.col("start").cast("timestamp_ntz"), "n")


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL")
def stream_dedup(spark, sf_dir):
    return S.first_by_stream(spark, sf_dir)


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def file_arrival(spark, sf_dir):
    return S.totals_by_stream(spark, sf_dir)


@query("SELECT user_id, max_by(event_type, event_id) AS status, count(*) AS n FROM events GROUP BY user_id")
def stream_state_machine(spark, sf_dir):
    return S.states_by_stream(spark, sf_dir)


@query("SELECT event_id, user_id, event_type, value FROM events")
def exactly_once_intake(spark, sf_dir):
    """Every event comes twice, in two runs of one stream, and is in the table once."""
    return S.twice_by_stream(spark, sf_dir).select("event_id", "user_id", "event_type", "value")


#: Hours that a run may be busy.
BUSY_HOURS = 20


def _allowed(state: str, status: str) -> str:
    return "CASE " + state + " " + " ".join(f"WHEN '{a}' THEN strpos('{b}', {status}) > 0" for a, b in runs.MOVES.items()) + " END"


@query(
    f"""WITH RECURSIVE e AS (SELECT user_id AS run_id, epoch_us(ts) AS t, event_id, substring('{runs.STATES}', 1 + (event_id % 8)::INT, 1) AS status,
                      row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
    l AS (SELECT *, {BUSY_HOURS} * 3600000000 AS busy FROM e UNION ALL SELECT run_id, 9000000000000000, NULL, NULL, max(k) + 1, {BUSY_HOURS} * 3600000000 FROM e GROUP BY run_id),
    s AS (SELECT run_id, 0::BIGINT AS k, ''::VARCHAR AS old, 0::BIGINT AS old_since, ''::VARCHAR AS now, 0::BIGINT AS since, 0::BIGINT AS t, NULL::BIGINT AS event_id, NULL::VARCHAR AS status, false AS late, false AS moved
          FROM e GROUP BY run_id
          UNION ALL SELECT run_id, k, old, old_since, CASE WHEN ok THEN status ELSE st END, CASE WHEN ok THEN t ELSE si END, t, event_id, status, late, ok
          FROM (SELECT *, coalesce({_allowed("st", "status")}, false) AS ok
                FROM (SELECT l.run_id, l.k, s.now AS old, s.since AS old_since, l.t, l.event_id, l.status, s.now = 'P' AND l.t > s.since + l.busy AS late,
                             CASE WHEN s.now = 'P' AND l.t > s.since + l.busy THEN 'E' ELSE s.now END AS st, CASE WHEN s.now = 'P' AND l.t > s.since + l.busy THEN s.since + l.busy ELSE s.since END AS si
                      FROM s JOIN l ON l.run_id = s.run_id AND l.k = s.k + 1)))
    SELECT run_id, t AS at_micros, event_id, CASE WHEN late THEN 'E' ELSE old END AS from_status, status AS to_status, CASE WHEN moved THEN 'move' ELSE 'illegal' END AS kind FROM s WHERE event_id IS NOT NULL
    UNION ALL SELECT run_id, old_since + {BUSY_HOURS} * 3600000000, NULL, 'P', 'E', 'timeout' FROM s WHERE late"""
)
def run_state_moves(spark, sf_dir):
    """Reported states of runs as a stream: allowed moves, refused ones, and runs that were busy for too long."""
    return S.moves_by_stream(spark, sf_dir, BUSY_HOURS * 3_600_000_000).withColumnRenamed("at", "at_micros")


#: A file per nation and segment with a text page per customer.
_PAGES = """SELECT (n_name || '/' || c_mktsegment || '.txt') AS file, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey)::INT AS page_num,
    c_custkey || ' ' || c_name AS text, true AS layout FROM customer JOIN nation ON n_nationkey = c_nationkey"""


def _files(spark, sf_dir, odd: bool | None = None):
    c = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    c = c if odd is None else c.where(F.col("c_nationkey") % 2 == int(odd))
    page = F.struct("c_custkey", F.concat(F.col("c_custkey").cast("string"), F.lit(" "), "c_name").alias("t"))
    pages = F.transform(F.array_sort(F.collect_list(page)), lambda p: p["t"])
    return c.groupBy(F.concat("n_name", F.lit("/"), "c_mktsegment", F.lit(".txt")).alias("name")).agg(F.encode(F.array_join(pages, "\f"), "UTF-8").alias("content"))


def _pages(df):
    parts = F.split("path", "/")
    file = F.concat_ws("/", F.element_at(parts, -2), F.element_at(parts, -1))
    return df.select(file.alias("file"), "page_num", F.decode("image", "UTF-8").alias("text"), F.col("layout_id").isNotNull().alias("layout"))


_OPTIONS = {"render": "quillgrid.sources.page_source:text_pages", "suffix": ".txt"}


@query(_PAGES)
def page_intake(spark, sf_dir):
    """Customers written as files of text pages, read back page by page."""
    folder = work_folder(spark)
    P.write_files(_files(spark, sf_dir), f"{folder}/in")
    spark.dataSource.register(P.PageSource)
    return _pages(spark.read.format("pages").options(path=f"{folder}/in", **_OPTIONS).load())


@query(_PAGES)
def page_intake_stream(spark, sf_dir):
    """The same as a stream, while the folder grows between two runs."""
    folder = work_folder(spark)
    spark.dataSource.register(P.PageSource)
    out = None
    for odd in (True, False):
        P.write_files(_files(spark, sf_dir, odd), f"{folder}/in")
        pages = spark.readStream.format("pages").options(path=f"{folder}/in", log=f"{folder}/log", **_OPTIONS).load()
        out = to_end(pages, "append", folder)
    return _pages(out)


@query(
    """WITH h AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_orderkey % 2 ORDER BY o_orderkey) AS k, o_orderkey % 2 AS later FROM orders),
    n AS (SELECT count(*) AS n FROM orders WHERE o_orderkey % 2 = 0)
    SELECT o_orderkey, o_custkey, k + CASE WHEN later = 1 THEN n ELSE 0 END AS pk FROM h, n"""
)
def transactional_insert(spark, sf_dir):
    """Orders in two transactions, each run twice; keys go on from one to the next."""
    tables = Tables(spark, work_folder(spark))
    for name, rest in (("even", 0), ("odd", 1), ("even", 0), ("odd", 1)):
        with tables.transaction(name) as t:
            t.insert("orders", read(spark, sf_dir, "orders").where(F.col("o_orderkey") % 2 == rest).select("o_orderkey", "o_custkey"), key="pk", order=["o_orderkey"])
    return tables.read("orders")


@query(
    """WITH p AS (SELECT s_nationkey AS doc, count(*) AS n FROM supplier GROUP BY s_nationkey), d AS (SELECT n_nationkey AS doc, CASE WHEN n_nationkey % 4 > 0 THEN n_regionkey END AS class, n_name FROM nation WHERE n_nationkey % 5 > 0)
    SELECT row_number() OVER (ORDER BY d.doc) AS complete_id, d.doc AS doc_id, coalesce(class::VARCHAR, '0') || '_' || d.doc || '/' || n_name || '.pdf' AS path, coalesce(n, 0)::INT AS pages, 2 AS files FROM d LEFT JOIN p ON p.doc = d.doc
    UNION ALL SELECT NULL, n_nationkey, n_nationkey || '/' || n_name || '.pdf', 0, 2 FROM nation WHERE n_nationkey % 5 = 0"""
)
def archived_documents(spark, sf_dir):
    """Nations as documents with a page per supplier: done ones with their pages and rows, every fifth as failed; run twice. What lies in
    the folders is counted, but for page images: their names begin with `_`, which listings leave out."""
    work, day = work_folder(spark), datetime.date(2024, 5, 6)
    n = read(spark, sf_dir, "nation").withColumn("doc_id", F.col("n_nationkey"))
    P.write_files(n.select(F.concat("n_name", F.lit(".pdf")).alias("name"), F.encode("n_name", "UTF-8").alias("content")), f"{work}/in")
    origin = F.concat(F.lit(f"{work}/in/"), "n_name", F.lit(".pdf"))
    docs = n.select("doc_id", F.when(F.col("n_nationkey") % 4 > 0, F.col("n_regionkey")).alias("doc_class_id"), origin.alias("origin"), F.to_json(F.struct("n_name")).alias("info"))
    s = read(spark, sf_dir, "supplier")
    number = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey"))
    pages = s.select(F.col("s_nationkey").alias("doc_id"), number.alias("page_num"), F.encode("s_name", "UTF-8").alias("image"))
    tables, good = Tables(spark, f"{work}/tables"), docs.where("doc_id % 5 > 0")
    done = None
    for _ in range(2):
        done = A.complete(tables, good, pages, f"{work}/done", day, "run-1")
        A.fail(docs.where("doc_id % 5 = 0"), f"{work}/failed", day)
    spark.dataSource.register(P.PageSource)
    found = spark.read.format("pages").option("path", work).load().where("path LIKE '%/2024/05/06/%'")
    counts = found.groupBy(F.regexp_extract("path", "/2024/05/06/([^/]*)/", 1).alias("folder")).agg(F.count("*").alias("files"))
    path = lambda c: F.regexp_extract(F.get_json_object(c, "$.doc_path._originfile"), "/2024/05/06/(.*)$", 1)
    rows = done.select("complete_id", "doc_id", path("content").alias("path"), F.size(F.from_json(F.get_json_object("content", "$.page_infos"), "array<map<string,string>>")).alias("pages"))
    failed = found.where("path LIKE '%.json' AND path LIKE '%/failed/%'").select(F.decode("image", "UTF-8").alias("c"))
    rows = rows.unionByName(failed.select(F.lit(None).cast("bigint").alias("complete_id"), F.get_json_object("c", "$.file_id").cast(n.schema["doc_id"].dataType).alias("doc_id"), path("c").alias("path"), F.lit(0).alias("pages")))
    return rows.join(counts, F.regexp_extract("path", "^([^/]*)/", 1) == F.col("folder")).select("complete_id", "doc_id", "path", "pages", "files")
