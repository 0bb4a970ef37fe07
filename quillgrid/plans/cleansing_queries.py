"""Queries on recognised text: cleansing, dictionaries, patterns, similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillgrid.functions import text as T
from quillgrid.functions.containment import all_scores
from quillgrid.operators.grid import template_row
from quillgrid.operators.load import dictionary_hits
from quillgrid.plans.catalogue import query, read

#: Dictionary of the example: error and correction, longest error first, then by text.
COMMON = [("tion", "TION"), ("the", "THE"), ("an", "AN"), ("re", "RE")]
#: Correction of a whole line at a template row.
BLOCK = [(1, "THE", "the (article)"), (2, "of", "OF"), (3, "is.", "IS")]
TEMPLATE_FIRST, TEMPLATE_ROWS = 1, 3

_LINES = """lines AS (SELECT doc_id, row, line FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS row FROM documents))"""
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_CLEAN = rf"regexp_replace(line, '{_SPACE}+', '', 'g')"
_SANE = rf"regexp_replace(regexp_replace({_CLEAN}, '[^\p{{L}}\p{{N}}_:().]', '', 'g'), '[_ㆍ]', '', 'g')"
_COMMON = "".join("replace(" for _ in COMMON) + "{0}" + "".join(f", '{a}', '{b}')" for a, b in COMMON)


def lines(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("row", "line")).withColumn("row", F.col("row") + 1)


def dictionary():
    return F.array(*(F.struct(F.lit(a).alias("err"), F.lit(b).alias("fix")) for a, b in COMMON))


@query(f"WITH {_LINES} SELECT doc_id, row::INT AS row, {_CLEAN} AS clean FROM lines")
def whitespace_removed(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "row", T.remove_whitespace(F.col("line")).alias("clean"))


@query(f"WITH {_LINES} SELECT doc_id, row::INT AS row, {_SANE} AS clean FROM lines")
def sanitize_text(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "row", T.sanitize_text(T.remove_whitespace(F.col("line"))).alias("clean"))


@query(f"WITH {_LINES} SELECT doc_id, row::INT AS row, {_COMMON.format('line')} AS fixed FROM lines")
def common_dict_cumulative(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "row", T.apply_dictionary(F.col("line"), dictionary()).alias("fixed"))


@query(f"WITH {_LINES} SELECT doc_id, row::INT AS row, replace(line, '{COMMON[-1][0]}', '{COMMON[-1][1]}') AS fixed FROM lines")
def common_dict_compat(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "row", T.apply_dictionary_last(F.col("line"), dictionary()).alias("fixed"))


def corrected(spark, sf_dir):
    clean = lines(spark, sf_dir).select("doc_id", "row", T.sanitize_text(T.remove_whitespace(F.col("line"))).alias("clean"))
    fixed = clean.withColumn("common", T.apply_dictionary(F.col("clean"), dictionary()))
    fixed = fixed.withColumn("template_row", template_row(F.col("row"), F.lit(TEMPLATE_FIRST), F.lit(TEMPLATE_ROWS)))
    block = spark.createDataFrame(BLOCK, "template_row int, common string, correct string")
    joined = fixed.join(F.broadcast(block), ["template_row", "common"], "left")  # a literal table of three rows
    return joined.select("doc_id", "row", "template_row", F.coalesce("correct", "common").alias("corrected"))


@query(
    f"""WITH {_LINES}, c AS (SELECT doc_id, row::INT AS row, ((row - {TEMPLATE_FIRST}) % {TEMPLATE_ROWS} + {TEMPLATE_FIRST})::INT AS template_row, {_COMMON.format(_SANE)} AS common FROM lines)
    SELECT doc_id, row, c.template_row, coalesce(b.correct, c.common) AS corrected FROM c
    LEFT JOIN (VALUES {', '.join(f"({r}, '{a}', '{b}')" for r, a, b in BLOCK)}) AS b(template_row, common, correct) ON b.template_row = c.template_row AND b.common = c.common"""
)
def common_and_block_correction(spark, sf_dir):
    """Lines as blocks: white space, characters, common dictionary, then the dictionary of the block that the row repeats."""
    return corrected(spark, sf_dir)


@query(
    f"""WITH {_LINES}, w AS (SELECT doc_id, row, string_split(line, ' ')[1] AS word FROM lines)
    SELECT doc_id, row::INT AS row, word, CASE word WHEN 'The' THEN 'the' WHEN 'Of' THEN 'of' ELSE word END AS corrected FROM w WHERE word <> ''"""
)
def block_correction_match(spark, sf_dir):
    words = lines(spark, sf_dir).select("doc_id", "row", F.split("line", " ")[0].alias("word")).where("word <> ''")
    fix = spark.createDataFrame([("The", "the", 1), ("The", "THE", 0), ("Of", "of", 0)], "word string, correct string, ordr int")
    best = fix.groupBy("word").agg(F.max_by("correct", "ordr").alias("correct"))
    return words.join(F.broadcast(best), "word", "left").select("doc_id", "row", "word", F.coalesce("correct", "word").alias("corrected"))


@query(
    r"""WITH t AS (SELECT l_orderkey, l_linenumber, replace(replace(' ' || CAST(CAST(round(l_extendedprice) AS BIGINT) AS VARCHAR) || ',5.' || CAST(l_linenumber AS VARCHAR), ',', ''), ' ', '') AS plain FROM lineitem)
    SELECT l_orderkey, l_linenumber, CASE WHEN regexp_matches(plain, '^(?:[0-9]+$)') THEN plain ELSE regexp_replace(plain, '[^0-9.]', '', 'g') END AS value FROM t"""
)
def decimal_normalise(spark, sf_dir):
    raw = F.concat(F.lit(" "), F.round("l_extendedprice").cast("bigint").cast("string"), F.lit(",5."), F.col("l_linenumber").cast("string"))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", T.decimal_text(raw, "[0-9]+$").alias("value"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN 'no date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS value,
      CASE WHEN o_orderkey % 3 = 2 THEN 'no date like yyyy-MM-dd' END AS error FROM orders"""
)
def date_normalise(spark, sf_dir):
    raw = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy.MM.dd")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise("no date")
    formats = ["yyyy.MM.dd", "yyyy/MM/dd"]
    return read(spark, sf_dir, "orders").select("o_orderkey", T.date_text(raw, "yyyy-MM-dd", formats).alias("value"), T.date_error(raw, "yyyy-MM-dd", formats).alias("error"))


@query(
    r"""WITH t AS (SELECT c_custkey, regexp_replace('KRW ' || CAST(c_custkey AS VARCHAR) || CASE WHEN c_custkey % 4 = 0 THEN '-1-2' ELSE '.5 won' END, '[^0-9.-]', '', 'g') AS k FROM customer)
    SELECT c_custkey, CASE WHEN length(k) - length(replace(k, '-', '')) <= 1 AND length(k) - length(replace(k, '.', '')) <= 1 THEN try_cast(k AS DOUBLE) END AS value FROM t"""
)
def numeric_clean(spark, sf_dir):
    raw = F.concat(F.lit("KRW "), F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 4 == 0, "-1-2").otherwise(".5 won"))
    return read(spark, sf_dir, "customer").select("c_custkey", T.numeric(raw).alias("value"))


@query("SELECT l_orderkey, l_linenumber, ((l_linenumber - 2 + 300) % 3 + 2)::INT AS template_row FROM lineitem")
def modulo_template_row(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", template_row(F.col("l_linenumber"), F.lit(2), F.lit(3)).cast("int").alias("template_row"))


@query(
    """SELECT doc_id, CASE WHEN regexp_matches(text, '[A-Za-zÀ-ÿ]') THEN 'en' ELSE '' END AS script, lang = 'en' AS is_en FROM documents"""
)
def language_by_script(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", T.script_language(F.col("text")).alias("script"), (F.col("lang") == "en").alias("is_en"))


@query("SELECT event_id, json_extract_string(props, '$.page') AS page, json_extract_string(props, '$.k') AS k FROM events")
def json_props_extract(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.page").alias("page"), F.get_json_object("props", "$.k").alias("k"))


@query(
    """SELECT event_id, json_merge_patch(props, '{"status":"done"}')::VARCHAR AS props, json_merge_patch('{"n":[1,2.5],"o":' || props || '}', '{"o":{"status":7}}')::VARCHAR AS nested FROM events"""
)
def json_set_update(spark, sf_dir):
    """A value set at the top and one level down; all the rest of both objects is compared, too."""
    nested = T.json_set(F.concat(F.lit('{"n":[1,2.5],"o":'), F.col("props"), F.lit("}")), "o.status", F.lit(7))
    return read(spark, sf_dir, "events").select("event_id", T.json_set(F.col("props"), "status", F.lit("done")).alias("props"), nested.alias("nested"))


@query("SELECT c_custkey, replace(c_name, '#', ' ') AS shown, replace(c_mktsegment, ' ', '') = replace(c_mktsegment || ' ', ' ', '') AS same FROM customer")
def key_text_match(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    return c.select("c_custkey", F.replace("c_name", F.lit("#"), F.lit(" ")).alias("shown"), T.same_key(F.col("c_mktsegment"), F.concat("c_mktsegment", F.lit(" "))).alias("same"))


@query()
def contain_check_score(spark, sf_dir):
    """Every document against every key text (benchmark item), by Arrow batches."""
    keys = read(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("key"))
    scores = all_scores(read(spark, sf_dir, "documents").select("doc_id", "text"), keys)
    return scores.select("doc_id", "item_id", F.round("score", 6).alias("score"))


@query(
    "SELECT word, coalesce(sum((length(text) - length(replace(text, word, ''))) // length(word)), 0)::BIGINT AS hits FROM documents, (VALUES ('tion'), ('the'), ('an')) AS w(word) GROUP BY word"
)
def dictionary_hit_counts(spark, sf_dir):
    return dictionary_hits(read(spark, sf_dir, "documents"), "text", ["tion", "the", "an"])


@query("SELECT event_id, coalesce(try_cast(value AS DOUBLE), 0) AS v, lower(event_type) IN ('click', 'view') AS flag FROM events")
def safe_cells(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.select("event_id", T.safe_float(F.col("value").cast("string")).alias("v"), F.lower("event_type").isin("click", "view").alias("flag"))
