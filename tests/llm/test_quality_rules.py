import re
from collections import Counter

from quillgrid.llm import quality_rules as Q


def spec(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def texts():
    base = "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3
    return [None, "", "a b c", "a b c a b c", "x x x x", "a\nb\na\n\n a\nb", "#*|<> & %", base, base + "### " * 60, "é\u3000ü ö\u00a0ä " * 30, "z " * 70_000, "w1\x0bw2\x0cw3\rw4"]


def test_measures_and_verdicts(spark):
    rows = list(enumerate(texts())) + [(None, "a b"), (1, "")]
    df = spark.createDataFrame([(*r, [1], 2) for r in rows], "doc_id bigint, text string, words array<int>, lines int")
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in Q.quality_verdicts(df).collect())
    assert got == sorted((str(k), *spec(t)) for k, t in rows)
    for r in Q.quality_verdicts(df).collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert Q.quality_verdicts(df.limit(0)).count() == 0
    # the filter keeps the same rows, with all their columns, in any order of rules
    kept = sorted(str(r.doc_id) for r in Q.quality_verdicts(df).collect() if r.kept)
    for rules in (Q.BASE + Q.RULES, tuple(reversed(Q.BASE + Q.RULES))):
        out = Q.quality_filter(df, rules)
        assert out.columns == df.columns and sorted(str(r.doc_id) for r in out.collect()) == kept


def test_hash_that_lies_is_noticed(spark, monkeypatch):
    """With all hash bits gone every window meets every other; the string form must step in."""
    sql = Q._repeat_words("cast(n_words as int)")
    sql = sql.replace("xxhash64(words[i], words[i + 1], words[i + 2])", "0L * length(words[i])")
    assert "xxhash64" not in sql
    monkeypatch.setattr(Q, "_REPEAT_SQL", sql)
    df = spark.createDataFrame(list(enumerate(texts()[:10])), "doc_id bigint, text string")
    assert sorted((r.doc_id, r.n_repeat_words) for r in Q.quality_measures(df).collect()) == [(i, spec(t)[4]) for i, t in enumerate(texts()[:10])]


def test_rules_that_reject_much_for_little_come_first(spark):
    df = spark.createDataFrame([(i, "a b c") for i in range(40)], "doc_id bigint, text string")
    assert Q.order_rules(df)[0].name == "few_words"
    assert Q.order_rules(df.limit(0)) == list(Q.BASE + Q.RULES)


def test_order_follows_what_is_left_for_each_rule(spark):
    """A rule that rejects most rows, but none that an earlier rule leaves, comes after one that rejects few of them."""
    rows = [(i, "# a b ") for i in range(60)] + [(i, "x " * 80 + "# " * 30) for i in range(60, 70)] + [(i, "word " * 80) for i in range(70, 100)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    rules = (Q.Rule("symbols_60", "n_symbols > 0 and n_words < 50"), Q.Rule("few_words", "n_words < 50"), Q.Rule("symbols", "n_symbols > 20"))
    assert [r.name for r in Q.order_rules(df, rules)] == ["symbols_60", "symbols", "few_words"]


def test_order_counts_rows_that_reach_a_rule(spark):
    """What the base rejects counts for no rule; equal work and rejection keep the given order; the same order in every call."""
    words = " ".join(f"word{i}" for i in range(60))
    rows = [(i, "x\nx\nx\nx") for i in range(80)] + [(i, f"{words} " + "# " * 20) for i in range(80, 90)] + [(i, words) for i in range(90, 200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    orders = {tuple(r.name for r in Q.order_rules(df, Q.RULES, given=Q.BASE)) for _ in range(3)}
    assert len(orders) == 1
    names = orders.pop()
    assert names[0] == "symbols" and names.index("short_words") < names.index("long_words") < names.index("dup_lines") < names.index("letters")
    assert [r.name for r in Q.order_rules(df, Q.RULES)][0] in ("dup_lines", "short_words")


def test_costly_rules_come_later_though_they_reject_more(spark):
    rows = [(i, " ".join(str(k) for k in range(100, 160)) + (" #" * 8 if i % 10 else "")) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    rules = (Q.RULES[4], Q.RULES[0])  # letters rejects all, symbols nine of ten, for far less
    assert [r.name for r in Q.order_rules(df, rules)] == ["symbols", "letters"]


def test_what_later_rules_need_is_skipped(spark, monkeypatch):
    """A measure that fails when it is computed proves for which rows it is: all but those that the base or an earlier rule rejects."""
    monkeypatch.setitem(Q.LAZY, "n_trap", "if(n_words < 50 or n_symbols > 0, raise_error('computed'), 0)")
    rules = (Q.Rule("symbols", "n_symbols > 0"), Q.Rule("trap", "n_trap > 1"))
    monkeypatch.setattr(Q, "order_rules", lambda docs, rules, **k: list(rules))
    words = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, "a b"), (2, words + " #"), (3, words)], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.kept) for r in Q.quality_verdicts(df, rules).collect()) == [(1, False), (2, False), (3, True)]
    kept = Q.quality_filter(df, (Q.BASE[0], *rules)).collect()
    assert [r.doc_id for r in kept] == [3]


def test_rules_on_letters_ellipses_and_bullets(spark):
    words = " ".join(f"word{i}" for i in range(60))
    lines = lambda head, tail, n: "\n".join(f"{head}{words[i * 9 : i * 9 + 9]} {i}{tail}" for i in range(n))
    texts = [" ".join(str(i) for i in range(60)), lines("", " ...", 20), lines("", "…\r", 20), lines("- ", "", 20), lines(" • ", "", 18) + "\nplain\nplain too", lines("", ".", 20), words]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.doc_id for r in Q.quality_verdicts(df).where("kept").collect()} == {4, 5, 6}
