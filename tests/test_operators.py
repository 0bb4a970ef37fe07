"""Operators against plain Python definitions, and edge cases."""

import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgrid.functions import boxes, containment, imaging, text
from quillgrid.operators import blocks, checks, grid, learning, listing, load, mapping, relational, structuring
from quillgrid.plans.steps import PRESETS, Registry, Step, CLEANSING
from quillgrid.sources import files, sinks, sql


def test_grid_against_loop(spark):
    rng = random.Random(1)
    rows = [(s, i, float(rng.randrange(9)), float(rng.choice([0, 0, 3, 30, 31, 60]))) for s in range(12) for i in range(rng.choice([1, 2, 9]))]
    for gap in (25, None):
        want = {}
        for s in range(12):
            b = sorted([r for r in rows if r[0] == s], key=lambda r: (r[3], r[1]))
            d = [y[3] - x[3] for x, y in zip(b, b[1:])]
            limit = gap if gap is not None else (np.mean(d) + np.std(d) if d else 100)
            row, lines = 0, {}
            for k, r in enumerate(b):
                row += (r[3] > 0) if k == 0 else (r[3] - b[k - 1][3] > limit)
                lines.setdefault(int(row), []).append((r[2], k, r[1]))
            for n, line in lines.items():
                for c, (_, _, i) in enumerate(sorted(line), 1):
                    want[s, i] = (1 if len(b) == 1 else n, c)
        df = grid.grid(spark.createDataFrame(rows, "s int, i int, x double, y double"), ["s"], "x", "y", "i", gap)
        assert {(r.s, r.i): (r.row, r.col) for r in df.collect()} == want


def test_cleansing(spark):
    rows = [None, "", " a　b\x85c ", "가_나ㆍ:(1).%", "1,234.5", "3.053.27x"]
    df = spark.createDataFrame([(t,) for t in rows], "t string")
    got = df.select("t", text.remove_whitespace(F.col("t")).alias("w"), text.sanitize_text(F.col("t")).alias("s"), text.decimal_text(F.col("t"), r"[0-9]+\.[0-9]$").alias("d")).collect()
    for r in got:
        assert r.w == re.sub(r"\s+", "", r.t or "")
        assert r.s == re.sub("[_ㆍ]", "", re.sub(r"[^\w:().]", "", r.t or ""))
    assert [r.d for r in got][-2:] == ["1234.5", "305327".replace("305327", "3053.27")]
    fixes = F.array(*(F.struct(F.lit(a).alias("err"), F.lit(b).alias("fix")) for a, b in (("ab", "b"), ("bb", "c"))))
    one = spark.createDataFrame([("abb",)], "t string")
    assert one.select(text.apply_dictionary(F.col("t"), fixes)).first()[0] == "c"
    assert one.select(text.apply_dictionary_last(F.col("t"), fixes)).first()[0] == "ac"
    assert one.select(text.apply_dictionary(F.col("t"), F.filter(fixes, lambda x: F.lit(False)))).first()[0] == "abb"


def test_contain_score():
    assert text.contain_score("abcd", "abcd") == 1.0
    assert text.contain_score("", "abcd") == 0.0 and text.contain_score("abcd", "a") == 0.0 and text.contain_score(None, None) == 0.0
    assert 0 < text.contain_score("xxabxx", "abcd") < text.contain_score("xxabcdxx", "ab cd") <= 1
    assert text.contain_score("dcba", "abcd") < text.contain_score("abcd", "abcd")


@pytest.mark.parametrize("per_range", [1_000_000, 10])
def test_nulls_last_places(spark, per_range):
    """Every row has its place, and the rows without a key have the last ones, in one range or in many."""
    rng = random.Random(per_range)
    rows = [(i, rng.choice([None, 1.5, -2.0, float(rng.randrange(50))])) for i in range(120)]
    got = listing.nulls_last_places(spark.createDataFrame(rows, "id bigint, v double"), "place", ["v", "id"], per_range)
    want = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0]))
    assert [r.id for r in sorted(got.collect(), key=lambda r: r.place)] == [i for i, _ in want]
    assert sorted(r.place for r in got.collect()) == list(range(1, 121))


def test_every_order_has_a_place(spark):
    from quillgrid.plans.catalogue import QUERIES, read

    got = QUERIES["nulls_last_sort_all"](spark, "/root/testdata/sf0.001")
    assert got.count() == read(spark, "/root/testdata/sf0.001", "orders").count() and got.where("shown is null").count() > 0


@pytest.mark.parametrize("cells", [1, 60, 4_000_000])
def test_all_scores_of_a_block(monkeypatch, cells):
    """Tables, lists and cut blocks give what each pair gives on its own; copies that overlap count once."""
    monkeypatch.setattr(containment, "CELLS", cells)
    rng = random.Random(cells)
    for chars in ("ab", "abc ", "abcdefgh é😀"):
        keys = ["".join(rng.choice(chars) for _ in range(n)) for n in (1, 2, 3, 8, 16, 31, 32, 40)] + [None, ""]
        block = containment.Keys(keys)
        for t in [None, "", "aaaaaaaaa", "zz", keys[6] + "zz" + keys[6] * 3, *("".join(rng.choice(chars) for _ in range(rng.randrange(80))) for _ in range(12))]:
            assert block.scores(t) == pytest.approx([text.contain_score(t, k) for k in keys], abs=1e-12)


def test_contain_check_score_is_documents_by_benchmark(spark, tmp_path, monkeypatch):
    """Null and repeated ids, ids with gaps and several blocks of items: every row meets every item."""
    from quillgrid.plans.catalogue import QUERIES

    docs = [(1, "the key text and more"), (None, "no id: the key text"), (4, None), (9, "another item"), (9, "another item")]
    items = [(7, "the key text"), (100, "another item"), (None, "and more"), (7, "")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    monkeypatch.setattr(containment, "KEYS", 3)
    got = sorted(QUERIES["contain_check_score"](spark, str(tmp_path)).collect(), key=str)
    want = sorted([(d, i, round(text.contain_score(t, k), 6)) for d, t in docs for i, k in items], key=lambda r: str(r))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_language_and_numbers(spark):
    df = spark.createDataFrame([("안녕 a",), ("abc",), ("12",), ("かな",), ("Привет",)], "t string")
    assert [r[0] for r in df.select(text.script_language(F.col("t"))).collect()] == ["ko", "en", "", "ja", "ru"]
    df = spark.createDataFrame([("-1.5kg",), ("1.2.3",), ("1-2-3",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(text.numeric(F.col("t"))).collect()] == [-1.5, None, None, None, None]
    assert spark.range(1).select(text.date_text(F.lit("2024.01.02."), "yyyy", ["yyyy.MM.dd", "yyyy.MM.dd."])).first()[0] == "2024"


def test_boxes(spark):
    one = spark.range(1)
    lit = F.lit
    crop = lambda *a: one.select(boxes.anchored_crop(a[0], *map(lit, a[1:]))).first()[0]
    assert crop("top_right", 100, 80, -30, 5, 20, 10) == [70, 5, 20, 10]
    assert crop("center", 101, 51, 0, 0, 20, 10) == [50, 25, 20, 10]
    assert crop("bottom_left", 100, 80, 5, -30, -1, -1) == [5, 50, 95, 30]
    assert crop("no such anchor", 100, 80, -5, 70, 20, 30) == [0, 70, 15, 10]
    assert crop("top_left", 100, 50, 200, 0, 20, 10) == [0, 0, 100, 50]
    assert one.select(boxes.ratio_crop("top_left", lit(101), lit(51), 0.5, 0.1, 0.25, -1)).first()[0] == [50, 5, 25, 46]
    turned = lambda angle: one.select(boxes.reorient(*(lit(v) for v in (1, 2, 3, 4, 10, 20, 100, 200, angle)))).first()[0]
    assert turned(90) == [104.0, 21.0, 4.0, 3.0] and turned(180) == [11.0, 214.0, 3.0, 4.0] and turned(-90) == [12.0, 21.0, 4.0, 3.0] and turned(45) == [11.0, 22.0, 3.0, 4.0]
    points = spark.createDataFrame([([30, 5, 30, 41],)], "e array<int>").select(boxes.split_points(F.col("e"), lit(60), 10)).first()[0]
    assert [tuple(p) for p in points] == [(5, 25), (30, 11), (41, 19)]
    assert one.select(boxes.reorient(*(lit(v) for v in (1, 2, 3, 4, 10, 20, 100, 200, 0)))).first()[0] == [11.0, 22.0, 3.0, 4.0]


def test_page_merge(spark):
    pages = [(1, 1, [{"a": "1"}, {"a": "2"}]), (1, 2, [{"b": "3"}, {"b": "4"}]), (1, 3, [{"a": "5"}]), (2, 2, [{"a": "y"}]), (2, 1, [{"a": "x"}])]
    df = spark.createDataFrame(pages, "d int, p int, rows array<map<string,string>>")
    got = {r.d: r.rows for r in relational.page_merge(df, ["d"], "p", "rows").collect()}
    assert got == {1: [{"a": "1", "b": "3"}, {"a": "2", "b": "4"}, {"a": "5"}], 2: [{"a": "x"}, {"a": "y"}]}


def test_choose_and_queue(spark):
    df = spark.createDataFrame([(1, True, 0.5, 0, "a"), (2, True, 0.9, 1, "b"), (2, True, 0.9, 0, "c"), (3, False, 1.0, 0, "d")], "k int, ok boolean, s double, o int, v string")
    got = {r.k: (r.confidence, r.v) for r in relational.choose(df, ["k"], F.col("ok"), "s", "o", ["v"]).collect()}
    assert got == {1: (0.5, None), 2: (0.9, "c"), 3: (-1.0, None)}
    q = spark.createDataFrame([(1, "X", 1), (2, "W", 1), (3, "H", 9), (4, "H", 9)], "id int, st string, t int")
    assert relational.queue_head(q, "st", "t", "id", {"H": 1, "W": 2}, 3).first().id == 3


def test_checks_edges(spark):
    none = spark.createDataFrame([], "a int")
    assert [r.passed for r in checks.column_checks(none, {"a": {"max": {"equal_to": 1}}}).collect()] == [False]
    assert [r.passed for r in checks.column_checks(none, {"a": {"max": {"equal_to": 1}}}, accept_none=True).collect()] == [True]
    assert checks.all_truthy(none).first().passed is False
    df = spark.createDataFrame([(90,), (110,)], "a int")
    rules = {"a": {"min": {"equal_to": 100, "tolerance": 0.1}, "max": {"less_than": 100}}}
    assert [r.passed for r in checks.column_checks(df, rules).collect()] == [True, False]


def test_listing(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "B_c")], "id int, t string")
    assert [r.id for r in listing.search(df, {"t_like": "b", "x_gt": 1, "id_in": [1, 3]}, ["t", "id"]).collect()] == [1]
    assert [r.id for r in df.where(listing.ilike(F.col("t"), "contains", "b_")).collect()] == [3]
    assert [r.id for r in df.where(listing.all_tokens(F.col("t"), "B a")).collect()] == [1]
    with pytest.raises(ValueError):
        listing.order_by(df, ["-secret"], ["id"])


def test_trigger_rules(spark):
    df = spark.createDataFrame([(1, "success"), (1, "skipped"), (2, "failed"), (3, "running"), (3, "success")], "g int, st string")
    got = {(r.g, r.rule): r.ready for r in mapping.trigger(df, ["g"], "st").collect()}
    assert got[1, "none_failed"] and not got[1, "all_success"] and got[2, "one_failed"] and got[2, "all_failed"] and not got[3, "all_done"] and got[3, "one_success"] and got[3, "always"]


def test_dense_keys(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v")).repartition(5)
    got = sorted((r.v, r.k) for r in load.assign_keys(df, "k", ["v"], 10).collect())
    assert got == [(i, i + 11) for i in range(1000)]
    got = sorted((r.v, r.k) for r in load.assign_keys(df, "k", ["v"], 10, rows_per_range=90).collect())
    assert got == [(i, i + 11) for i in range(1000)]
    nulls = spark.createDataFrame([(None,), ("b",), ("a",), (None,)], "v string")
    assert sorted(r.k for r in load.assign_keys(nulls, "k", ["v"], rows_per_range=2).collect()) == [1, 2, 3, 4]


def test_record_ids(spark):
    rows = [(1, 1, "child", 1), (1, 2, "p", 1), (1, 2, "child", 1), (1, 3, "child", 1), (1, 4, "p", 1), (1, 4, "child", 1)]
    df = spark.createDataFrame(rows, "doc_id int, page_num int, table_name string, record_no int")
    got = sorted((r.table_name, r._id, r._par_id) for r in structuring.record_ids(df, {"child": "p"}).collect())
    assert got == [("child", 1, 0), ("child", 2, 1), ("child", 3, 1), ("child", 4, 2), ("p", 1, 0), ("p", 2, 0)]


def test_steps(spark):
    df = spark.createDataFrame([(" a b%_ ",)], "text string")
    assert CLEANSING.run(df, PRESETS["cleansing"]).first().text == "ab"
    with pytest.warns(UserWarning, match="unknown step"):
        assert Registry().run(df, [Step("cache", {"key": "k"}), Step("nothing"), Step("load", {"key": "k"})]).first().text == " a b%_ "


def test_files_and_sinks(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    (tmp_path / "in/a.PNG").write_bytes(b"img")
    (tmp_path / "in/sub/b.pdf").write_bytes(b"pdf")
    (tmp_path / "in/c.json").write_text('{"a": "가"}', encoding="cp949")
    (tmp_path / "in/d.csv").write_text('e,f\n"ab",x\n,y\nabc,z\n', encoding="cp949")
    folder = f"{tmp_path}/in"
    assert files.image_paths(spark, folder, True).count() == 1
    pages = files.pages(files.scan(spark, folder, pattern=r"\.(png|pdf)$"), lambda raw: [raw, raw]).collect()
    assert sorted((r.page_num, r.layout_id is None) for r in pages) == [(1, False), (1, True), (2, False)]
    assert files.read_json(spark, folder, "a string").first().data.a == "가"
    assert [(r.err, r.fix) for r in files.correction_dictionary(spark, f"{folder}/d.csv").collect()] == [("abc", "z"), ("ab", "x")]
    with pytest.raises(FileNotFoundError):
        files.require_rows(files.scan(spark, folder, pattern="nothing"))
    df, out = spark.range(3), f"{tmp_path}/out"
    for policy in ("overwrite", "skip", "exists_backup"):
        sinks.save_json(df, out, policy)
    assert sinks.exists(spark, f"{out}.bak1") and spark.read.json(out).count() == 3
    assert sinks.copy_file(spark, f"{folder}/d.csv", f"{folder}/a.PNG").endswith("a_1.PNG")
    table = f"{tmp_path}/t"
    for _ in range(2):
        sinks.insert(spark.createDataFrame([("x",), ("y",)], "v string"), table, "id", ["v"])
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == [1, 2, 3, 4]
    new = sinks.replace_rows(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c")], "k int, v string"), ["k"])
    assert sorted(map(tuple, new.collect())) == [(1, "a"), (2, "c")]
    gone, rest = sinks.split_archive(spark.createDataFrame([(1,), (None,), (5,)], "a int"), F.col("a") > 3)
    assert (gone.count(), rest.count()) == (1, 2)
    sinks.transfer(spark.createDataFrame([(0, None)], "a int, b string"), f"{tmp_path}/csv", "csv", rename={"a": "z"})
    assert spark.read.csv(f"{tmp_path}/csv", header=True).first().z == "0"


def test_named_queries(spark):
    spark.range(5).createOrReplaceTempView("five")
    q = sql.NamedQueries(spark)
    q.add("above", "SELECT id FROM five WHERE id > :low ORDER BY id")
    assert q.one("above", low=2) == 3 and q.check("above", low=2) and not q.check("above", low=9) and q.row("above", low=9) is None
    assert sql.statements("SELECT ';' ; SELECT 2;") == ["SELECT ';'", "SELECT 2"]
    assert sql.run_all(spark, "SELECT 1; SELECT 2").first()[0] == 2
    assert sql.in_list("a", []) is None and sql.in_list("a", ["x'", 1]) == "a IN ('x\\'', 1)"
    with pytest.raises(ValueError):
        sql.named(spark.range(1), ["a", "b"])


def test_spark_ml_classify_uses_every_component(spark, tmp_path):
    """The label is in the last component only."""
    from quillgrid.plans.catalogue import QUERIES

    rng = random.Random(3)
    rows = [(i, i % 2, [rng.random() for _ in range(9)] + [float(i % 2)]) for i in range(300)]
    spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["spark_ml_classify"](spark, str(tmp_path)).collect()
    assert len(got) > 50 and all(r.y == r.pred for r in got)


def test_image_steps_of_the_registry(spark):
    page = np.full((90, 120), 255, np.uint8)
    page[20:22, 15:100] = page[20:70, 15:17] = 0
    assert imaging.line_components(page) == [(15, 20, 86, 50, 268)]  # strokes of an even length move by one, as in the reference
    corner = np.zeros((4, 4), np.uint8)
    corner[0, 0] = corner[1, 1] = 255
    assert len(imaging.components(corner)) == 2 and imaging.components(corner, corners=True) == [(0, 0, 2, 2, 2)]
    area = imaging.STEPS["separate_areas_set1"]
    assert (area(page, area_type="center", offset=[-5, 2], width=10, height=-1) == page[47:, 55:65]).all()
    assert (area(page, area_type="bottom_right", offset=[-30, -20], width=99, height=10) == page[70:80, 90:]).all()
    assert area(page, area_type="top_right", width=5, height=5) is page and area(page) is page
    assert (area(page, area_type="nowhere", width=7, height=6) == page[:6, :7]).all()
    trimmed = imaging.STEPS["del_blank_set2"](page, padding_ratios=[0, 0, 0, 0])
    assert abs(trimmed.shape[0] - 50) <= 5 and abs(trimmed.shape[1] - 85) <= 5 and (trimmed == 0).sum() == (page == 0).sum()
    padded = imaging.trim_to_lines(page, padding_ratios=[1, 0, 0, 0])
    assert padded.shape[0] == 2 * trimmed.shape[0] and (padded[: trimmed.shape[0]] == 255).all()
    assert imaging.trim_to_lines(np.full((50, 60), 9, np.uint8), [0, 0], [0, 0, 0, 0]).shape == (51, 61)
    mask = np.full((31, 41), 255, np.uint8)
    mask[15, 20] = 0
    kept = imaging.keep_under_mask(np.zeros((51, 61, 3), np.uint8), mask)
    assert (kept[20:31, 25:36] == 0).all() and (kept == 0).sum() == 3 * 121
    assert (imaging.keep_under_mask(np.zeros((11, 11), np.uint8), mask) == 0).all()
    df = spark.createDataFrame([(2, 2, 1, bytearray(4))], imaging.IMAGE)
    with pytest.warns(UserWarning, match="unknown step text_orientation_set"):
        imaging.apply_steps(df, [("text_orientation_set", {})])


def test_imaging():
    img = np.full((60, 80), 255, np.uint8)
    img[20, 5:75] = 0
    img[40, 5:75] = 0
    assert imaging.trim_blank(img, 2).shape == (25, 74)
    assert imaging.letterbox(img, 40, 40).shape == (40, 40) and imaging.fit(img, "long", 160).shape == (120, 160)
    assert (imaging.rotate(imaging.rotate(img, 90), -90) == img).all()
    assert (imaging.resize(img, 80, 60) == img).all()
    big = np.kron(img, np.ones((4, 4), np.uint8))
    assert abs(imaging.skew(imaging.rotate(big, 3.0)) + 3.0) <= 0.5
    assert len(imaging.components(imaging.lines(img))) == 2
    assert imaging.otsu(np.array([[10, 12, 200, 210]], np.uint8)) in range(12, 200)
    noise = np.zeros((5, 5), np.uint8)
    noise[2, 2] = 255
    assert imaging.median3(noise).max() == 0 and imaging.dilate(noise).sum() == 9 * 255 and imaging.erode(imaging.dilate(noise)).sum() == 255
    assert imaging.union_mask([img, img]) is not None and imaging.union_mask([np.full((50, 50), 255, np.uint8)]) is None
    assert imaging.adaptive_threshold(img).shape == img.shape


def test_learning(spark):
    rows = [(float(i % 10), float(i) if i % 7 else None, int(i % 10 > 4)) for i in range(300)]
    _, scored = learning.train(spark.createDataFrame(rows, "a double, b double, y int"), ["a", "b"], model="dt")
    assert scored.where("pred = y").count() == scored.count() > 0
    assert 10 <= learning.balanced(spark.createDataFrame(rows, "a double, b double, y int"), "y", 30).count() <= 120


def test_dates_codes_and_relations(spark):
    from quillgrid.functions import dates

    one = spark.createDataFrame([("2024-02-28", 7300.0)], "d string, s double")
    r = one.select(dates.ds_add(F.col("d"), 2).alias("a"), dates.ds_format(F.col("d"), "yyyy-MM-dd", "dd.MM.yyyy").alias("b"), dates.for_humans(F.col("s")).alias("c"), dates.ds_nodash(F.to_timestamp("d")).alias("e")).first()
    assert tuple(r) == ("2024-03-01", "28.02.2024", "2 hours", "20240228")
    codes = spark.createDataFrame([("KOR",), ("영어",), ("zh-cn",), (None,)], "t string").select(text.language_code(F.col("t")))
    assert [x[0] for x in codes.collect()] == ["", "en", "", ""]
    a, b = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k int, v string"), spark.createDataFrame([(2, "x"), (1, None)], "k int, v string")
    assert [r.k for r in listing.related(a, b, "k", "k", negate=True).collect()] == [3]
    assert [r.k for r in listing.excluding(a, b, ["k", "v"]).collect()] == [3]


def test_structuring_with_header_and_gaps(spark):
    """Only value rows repeat, a missing cell moves nothing into another record, and the template reaches as many rows as there are blocks in."""
    template = [("s", "MULTI_ROW", 1, 1, "key", None, None, "No"), ("s", "MULTI_ROW", 1, 2, "key", None, None, "Name"), ("s", "MULTI_ROW", 2, 1, "val", "t", "a", None), ("s", "MULTI_ROW", 2, 2, "val", "t", "b", None)]
    cells = [(1, "s", 1, 1, "N o"), (1, "s", 1, 2, "Nane")] + [(1, "s", r, c, f"{'ab'[c - 1]}{r}") for r in (2, 3, 4) for c in (1, 2) if (r, c) != (3, 2)] + [(2, "s", 1, 1, "No"), (2, "s", 1, 2, None)]
    matched = structuring.match_template(
        spark.createDataFrame(cells, "doc_id int, section string, row int, col int, text string"),
        spark.createDataFrame(template, "section string, kind string, row int, col int, cell_type string, table_name string, column_name string, default_text string"),
    )
    got = {(r.doc_id, r.record_no, r.column_name): r.text for r in structuring.records(matched).collect()}
    assert got == {(1, 1, "a"): "a2", (1, 1, "b"): "b2", (1, 2, "a"): "a3", (1, 3, "a"): "a4", (1, 3, "b"): "b4"}
    assert sorted((r.doc_id, r.row, r.col, r.text) for r in structuring.key_mismatches(matched).collect()) == [(1, 1, 2, "Nane"), (2, 1, 2, None)]
    assert sorted((r.doc_id, r.row, r.col) for r in structuring.missing_blocks(matched).collect()) == [(1, 3, 2), (2, 2, 1), (2, 2, 2)]


def test_record_numbers_fold(spark):
    """Against reading one cell after the other."""
    rng = random.Random(3)
    rows = [(g, i, rng.choice("abc")) for g in range(30) for i in range(rng.randrange(1, 40))]
    got = {(r.g, r.i): r.record_no for r in grid.record_numbers(spark.createDataFrame(rows, "g int, i int, c string"), ["g"], "c", ["i"]).collect()}
    for g in range(30):
        have, n = set(), 1
        for _, i, c in (r for r in rows if r[0] == g):
            if c in have:
                have, n = set(), n + 1
            have.add(c)
            assert got[g, i] == n


def test_words_at_the_limit_and_without_height(spark):
    rows = [(1, "a", 0.0, 10.0, 10.0), (1, "b", 15.5, 4.0, 0.0), (1, "c", 24.9, 4.0, 10.0), (2, "x", 0.0, 1.0, 0.0), (2, "y", 1.0, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "l int, t string, x double, w double, h double")
    assert {r.l: r.text for r in grid.join_words(df, ["l"], "t", "x", "w", "h").collect()} == {1: "a bc", 2: "x y"}


def test_json_set_keeps_the_rest(spark):
    rows = ['{"n":1,"a":[1,2],"t":"x","z":null}', "{}", None, "no json", '{"o":{"p":{"q":true},"r":1.50},"status":3}']
    df = spark.createDataFrame([(r,) for r in rows], "p string")
    top = [r[0] for r in df.select(text.json_set(F.col("p"), "status", F.lit("done"))).collect()]
    want = [{"n": 1, "a": [1, 2], "t": "x", "z": None, "status": "done"}, {"status": "done"}, None, None, {"o": {"p": {"q": True}, "r": 1.5}, "status": "done"}]
    assert [t and json.loads(t) for t in top] == want
    deep = [r[0] for r in df.select(text.json_set(F.col("p"), "o.p.q", F.lit(5))).collect()]
    assert json.loads(deep[4]) == {"o": {"p": {"q": 5}, "r": 1.5}, "status": 3} and json.loads(deep[0]) == json.loads(rows[0]) and deep[2] is None


def test_truth_by_type(spark):
    row = lambda sql: checks.all_truthy(spark.sql(f"SELECT {sql}")).first().passed
    assert row("'0' AS a, 0.01BD AS b, true AS c, date'1970-01-01' AS d, array(0) AS e, -1 AS f")
    for bad in ("''", "0", "0.00BD", "0.0D", "false", "cast(null as string)", "array()"):
        assert not row(f"1 AS ok, {bad} AS a")
    df = spark.createDataFrame([([1, 3], "x")], "v array<int>, s string")
    assert [r.passed for r in checks.table_checks(df, {"row": "array_max(v) > 1", "agg": "max(v[0]) = 1"}).collect()] == [True, True]
    assert checks.value_check(df.select("s"), "x").first().passed and not checks.value_check(df.select("s"), "y").first().passed


def test_caps_raise_or_are_gone(spark, monkeypatch):
    lists = {"a": F.sequence(F.lit(1), F.lit(40)), "b": F.sequence(F.lit(1), F.lit(40))}
    with pytest.raises(Exception, match="1024 may be mapped: 1600"):
        mapping.cartesian(lists, spark.range(1), ["id"]).collect()
    assert mapping.cartesian({"a": lists["a"], "b": F.sequence(F.lit(1), F.lit(25))}, spark.range(1), ["id"]).agg(F.max("map_index")).first()[0] == 999
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(200, None), (500, 200)], "n int, p int")
    up = relational.hierarchy(chain, "n", "p")
    assert up.count() == 200 * 201 // 2 + 1 and up.where("node = 0").agg(F.max("level")).first()[0] == 200
    with pytest.raises(ValueError, match="circle"):
        relational.hierarchy(spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "n int, p int"), "n", "p")
    monkeypatch.setattr(load, "MOST_COLUMNS", 2)
    with pytest.raises(ValueError, match="more than 2 columns"):
        load.wide(spark.createDataFrame([(1, c, "v") for c in "abc"], "k int, n string, v string"), ["k"], "n", "v")


def test_dates_that_do_not_parse_stay(spark):
    df = spark.createDataFrame([("2024.01.02",), ("soon",), ("",), (None,)], "t string")
    got = df.select(text.date_text(F.col("t"), "yyyy", ["yyyy.MM.dd"]).alias("v"), text.date_error(F.col("t"), "yyyy", ["yyyy.MM.dd"]).alias("e")).collect()
    assert [(r.v, r.e is not None) for r in got] == [("2024", False), ("soon", True), ("", True), (None, True)]


def test_insert_plan_at_three_levels(spark):
    s = "doc_id int, _id int, _par_id int"
    tables = {
        "leaf": (spark.createDataFrame([(1, 1, 2), (1, 2, 9), (2, 1, 1)], s), "mid"), "mid": (spark.createDataFrame([(1, 1, 1), (1, 2, 1), (2, 1, 1)], s), "root"),
        "root": (spark.createDataFrame([(1, 1, 0), (2, 1, 0), (2, 2, 0)], s), None),
    }
    rows, kept, failed = load.insert_plan(tables, {"root": 10})
    assert [(r.doc_id, r.pk, r.parent_pk) for r in rows["root"].collect()] == [(1, 11, None)]
    assert sorted((r._id, r.pk, r.parent_pk) for r in rows["mid"].collect()) == [(1, 1, 11), (2, 2, 11)]
    assert [(r._id, r.parent_pk) for r in rows["leaf"].collect()] == [(1, 2)]
    assert kept.count() == 4 and sorted((r.doc_id, r.table_name, r._id, r.reason) for r in failed.collect()) == [
        (1, "leaf", 2, "parent missing"), (2, "leaf", 1, "parent missing"), (2, "mid", 1, "parent missing"), (2, "root", 1, "several roots"), (2, "root", 2, "several roots"),
    ]
    with pytest.raises(ValueError, match="way to a root"):
        load.insert_plan({"a": (tables["leaf"][0], "b")})


def _table(rows, columns, w=300, h=200):
    """A ruled table: lines of two pixels at the given places, with some ink in every cell."""
    img = np.full((h, w), 255, np.uint8)
    for y in rows:
        img[y : y + 2] = 0
    for x in columns:
        img[:, x : x + 2] = 0
    for y in [*(a + 10 for a in rows)]:
        img[y : y + 3, 8:12] = 0
    return img


def test_blocks_of_a_ruled_table(spark):
    root = blocks.Block("p", (100, 50, 300, 200), _table([60, 120], [150]))
    out = {b.name: b for b in blocks.separate_block_by_line(root)}
    # three rows, each cut at the column; a line's own height is too low for a block
    assert out["p"].child == 3 and {n for n in out if n.count("_") == 1} == {"p_h1", "p_h2", "p_h3"}
    assert all(out[f"p_h{i}"].child == 2 for i in (1, 2, 3)) and sum(b.child == 0 for b in out.values()) == 6
    assert out["p_h1"].box == (100, 50, 300, 59) and out["p_h2"].box == (100, 113, 300, 56)
    # children lie in their parents' rows, and pixels are the box's size
    for name, b in out.items():
        assert b.img.shape == (b.box[3], b.box[2])
        if name != "p":
            parent = out[name.rsplit("_", 1)[0]]
            assert parent.box[1] <= b.box[1] and b.box[1] + b.box[3] <= parent.box[1] + parent.box[3]
    # no horizontal line: the other direction begins; no line at all: one leaf
    assert blocks.separate_block_by_line(blocks.Block("q", (0, 0, 300, 200), _table([], [150])))[0].child == 2
    plain = blocks.separate_block_by_line(blocks.Block("q", (0, 0, 300, 200), np.full((200, 300), 255, np.uint8)))
    assert [(b.name, b.child) for b in plain] == [("q", 0)]


def test_blocks_split_at_gaps_and_ratios(spark):
    img = np.full((40, 200), 255, np.uint8)
    img[10:30, 20:60] = 0
    img[10:30, 120:180] = 0
    gap = blocks.split_image_by_vertical_gaps(blocks.Block("b", (3, 4, 200, 40), img.copy()))
    assert [(b.name, b.box, b.child) for b in gap] == [("b", (3, 4, 200, 40), 2), ("b_g1", (3, 4, 70, 40), 0), ("b_g2", (73, 4, 130, 40), 0)]
    assert len(blocks.split_image_by_vertical_gaps(blocks.Block("b", (0, 0, 200, 40), img.copy()), min_gap_width=90)) == 1
    assert len(blocks.split_image_by_vertical_gaps(blocks.Block("b", (0, 0, 200, 40), img.copy()), min_start_ratio=0.35)) == 1
    turned = blocks.split_image_by_left_ratio(blocks.Block("b", (0, 0, 200, 40), img), 0.25, angle=-90)
    assert [b.box for b in turned[1:]] == [blocks.turned_box((0, 0, 200, 40), (a, 0, n, 200), -90) for a, n in ((0, 10), (10, 30))]
    assert [b.img.shape for b in turned[1:]] == [(10, 200), (30, 200)]
    done = blocks.cut(blocks.Block("b", (0, 0, 200, 40), img.copy()), [("split_image_by_vertical_gaps", {}), ("no such step", {}), ("split_image_by_left_ratio", {"split_ratio": 0.5})])
    assert [b.name for b in done] == ["b", "b_g1", "b_g1_r1", "b_g1_r2", "b_g2", "b_g2_r1", "b_g2_r2"]
