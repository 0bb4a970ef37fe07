"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a condition on measures of one text. On a sample, the work of each rule (values and characters that it looks at) and the sets of rules that
reject each row are counted; the cascade is then put together greedily: next comes the rule that rejects most of the rows which still reach it, for the work on
those. A CASE expression stops at the first rule that rejects, and the measures that a rule alone needs are inside its branch, so they aren't computed
for rows that are already rejected. The order changes only the cost: the verdict is the same in any order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.llm.common import words

SYMBOLS = "[#*$%&|<>]"
#: Rows of the sample that orders the rules. It has no influence on any verdict.
SAMPLE_ROWS = 2000
#: Window positions are packed into so many bits beside the window's hash.
POSITION_BITS = 24


@dataclass(frozen=True)
class Rule:
    """Rejects where `rejects` holds: SQL on measures, and on names in LAZY, which stand for what is computed only where the rule is reached."""

    name: str
    rejects: str


#: Words with a letter; lines that end in an ellipsis; lines that begin with a bullet.
LAZY = {
    "n_letter_words": r"size(filter(words, w -> w rlike '\\p{L}'))",
    "n_ellipsis_lines": r"size(filter(lines, x -> x rlike '(\\.\\.\\.|\u2026)[ \\t-\\r]*\\z'))",
    "n_bullet_lines": r"size(filter(lines, x -> x rlike '^[ \\t-\\r]*[-*\u2022]'))",
}
#: What such a part goes through: words, lines and their characters; windows are hashed, and sorted.
WORK = {
    "n_letter_words": "n_words + word_chars",
    "n_ellipsis_lines": "n_lines + length(text)",
    "n_bullet_lines": "2 * n_lines",
    "n_repeat_words": "n_words * (4 + log2(n_words + 1))",
}
BASE = (
    Rule("few_words", "n_words < 50"),
    Rule("repeats", "100 * n_repeat_words > 50 * n_words"),
)
RULES = (
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("dup_lines", "2 * n_dup_lines > n_lines"),
    Rule("letters", "10 * n_letter_words < 3 * n_words"),
    Rule("ellipses", "10 * n_ellipsis_lines > 6 * n_lines"),
    Rule("bullets", "10 * n_bullet_lines > 9 * n_lines"),
)


def _repeat_words(n: str, w: str = "words") -> str:
    """Words in 3-word windows that occur twice or more.

    One sort of longs (window hash above, position below) brings equal windows together. Neighbours with equal hashes are compared
    word by word; where a hash lied, or the positions don't fit, the text's windows are sorted as strings instead.
    """
    low = (1 << POSITION_BITS) - 1
    packed = f"sort_array(transform(sequence(0, {n} - 3), i -> (xxhash64({w}[i], {w}[i + 1], {w}[i + 2]) & {~low}L) | i))"
    spans = lambda p: f"if(size({p}) = 0, 0, aggregate(sequence(1, greatest(size({p}) - 1, 1)), 3, (a, j) -> a + if(j < size({p}), least(3, {p}[j] - {p}[j - 1]), 0)))"
    at = lambda j: f"cast(s[{j}] & {low} as int)"
    same = " and ".join(f"{w}[{at('j')} + {k}] = {w}[{at('j - 1')} + {k}]" for k in range(3))
    one = lambda value, name, body: f"element_at(transform(array({value}), {name} -> {body}), 1)"
    positions = "array_sort(array_distinct(concat(transform(e, j -> {0}), transform(e, j -> {1}))))"
    hashed = one(
        packed,
        "s",
        one(
            f"filter(sequence(1, size(s) - 1), j -> shiftright(s[j] ^ s[j - 1], {POSITION_BITS}) = 0)",
            "e",
            f"case when size(e) = 0 then 0 when forall(e, j -> {same}) then " + one(positions.format(at("j"), at("j - 1")), "p", spans("p")) + " end",
        ),
    )
    exact = one(
        f"array_sort(transform(sequence(0, {n} - 3), i -> struct(concat_ws(' ', {w}[i], {w}[i + 1], {w}[i + 2]) as g, i as i)))",
        "s",
        one("filter(sequence(1, size(s) - 1), j -> s[j].g = s[j - 1].g)", "e", one(positions.format("s[j].i", "s[j - 1].i"), "p", spans("p"))),
    )
    return f"cast(case when {n} < 4 then 0 else coalesce(case when {n} <= {low} then {hashed} end, {exact}) end as bigint)"


_REPEAT_SQL = _repeat_words("cast(n_words as int)")


def _measures(df: DataFrame) -> DataFrame:
    """Adds words, lines, n_words, word_chars, n_symbols, n_lines and n_dup_lines (all cheap) to doc_id and text."""
    df = df.withColumn("words", words(F.col("text"))).withColumn("lines", F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: x.rlike("[^ \\t-\\r]")))
    return df.select(
        "*",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
    )


def quality_measures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and all measures of every whole text (null: no words)."""
    return _measured(docs, key, text).drop("text", "words", "lines")


def _measured(docs: DataFrame, key: str, text: str) -> DataFrame:
    df = _measures(docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")))
    return df.withColumn("n_repeat_words", F.expr(_REPEAT_SQL))


def _condition(rule: Rule, known: Sequence[str]) -> str:
    """The rule as SQL, with everything spelt out that isn't a column yet."""
    sql = f"({rule.rejects})"
    for name, body in {"n_repeat_words": _REPEAT_SQL, **LAZY}.items():
        if name not in known:
            sql = sql.replace(name, body)
    return sql


def _work(rule: Rule, known: Sequence[str]) -> str:
    """What judging one row takes, in values and characters looked at: one comparison, and what LAZY parts go through."""
    return " + ".join(["1", *(f"({work})" for name, work in WORK.items() if name in rule.rejects and name not in known)])


def order_rules(docs: DataFrame, rules: Sequence[Rule] = BASE + RULES, sample_rows: int = SAMPLE_ROWS, text: str = "text", given: Sequence[Rule] = ()) -> list[Rule]:
    """rules, by rejection per cost on a sample of about sample_rows rows: next the one that rejects most of the rows that reach it for the work on those rows.

    Rows that a rule of `given` rejects reach none. Work is counted, not timed, so the order is the same in every call. Rules that reject nothing more come
    last, cheap ones first; ties and an empty sample keep the given order.
    """
    total = docs.count()
    sample = docs.sample(False, min(1.0, sample_rows / max(total, 1)), 7).select(F.lit(0).alias("doc_id"), F.col(text).cast("string").alias("text"))
    measured = _measures(sample)  # judged in projections, not in filters: those would be pushed below the words, to split them anew at each mention
    known = measured.columns
    bits = F.array(*(F.coalesce(F.expr(_condition(r, known)), F.lit(False)) for r in (*given, *rules)))
    judged = measured.select(F.explode(F.array(F.struct(bits.alias("b"), *(F.expr(_work(r, known)).cast("double").alias(f"w{i}") for i, r in enumerate(rules))))).alias("j"))
    # one row for each set of rules that reject together
    sets = judged.groupBy("j.b").agg(F.count("*").alias("n"), *(F.sum(f"j.w{i}").alias(f"w{i}") for i in range(len(rules)))).collect()
    sets = [r for r in sets if not any(r["b"][: len(given)])]
    if not sets:
        return list(rules)
    left, out = list(range(len(rules))), []
    while left:
        reach = [r for r in sets if not any(r["b"][len(given) + i] for i in out)]
        cost = {i: sum(r[f"w{i}"] for r in reach) for i in left}
        gain = {i: sum(r["n"] for r in reach if r["b"][len(given) + i]) for i in left}
        out.append(min(left, key=lambda i: (-gain[i] / max(cost[i], 1.0), cost[i], i)))
        left.remove(out[-1])
    return [rules[i] for i in out]


def cascade(df: DataFrame, rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, else null. df must have the cheap measures; what else a rule needs is computed where the rule is reached."""
    verdict = None
    for r in rules:
        rejects = F.expr(_condition(r, df.columns))
        verdict = F.when(rejects, r.name) if verdict is None else verdict.when(rejects, r.name)
    return verdict


def quality_filter(docs: DataFrame, rules: Sequence[Rule] = BASE + RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that no rule rejects, with all their columns; rows are judged one by one, so ties, repeated rows and null ids stay or go alike.

    A null or empty text has no words and is rejected; very long texts are judged whole. Columns of docs may have any names. An empty table gives an empty
    result. Skipped: for a row that a rule rejects, all measures that only later rules need, the repeated windows among them.
    """
    ordered = order_rules(docs, rules, text=text)
    packed = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), F.lit(0).alias("doc_id"), docs[text].cast("string").alias("text"))
    measured = _measures(packed)
    judged = measured.select("row", cascade(measured, ordered).alias("rejected"))
    # an explode instead of a filter: a filter would be pushed below the measures, with the words split anew at each mention
    return judged.select(F.explode(F.when(F.col("rejected").isNull(), F.array("row"))).alias("row")).select("row.*")


def quality_verdicts(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the base measures, base_failed and kept for every document.

    Null or empty text: no words, so base_failed; very long texts are judged whole. Null ids, ties and repeated rows are kept; an empty table gives an empty
    result; other columns are ignored, whatever their names. The base measures are asked for and computed for every row. Skipped: for a row that fails
    the base all of the cascade, and for one that a rule rejects the letters, ellipses and bullets that later rules count.
    """
    measured = _measured(docs, key, text)
    failed = F.expr(" or ".join(f"({r.rejects})" for r in BASE))
    rejected = cascade(measured, order_rules(docs, rules, text=text, given=BASE))
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), F.when(failed, F.lit(False)).otherwise(rejected.isNull()).alias("kept"),
    )
