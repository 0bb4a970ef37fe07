"""Text cleansing, normalising and matching, as Column functions (no Python at run time)."""

from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode sees it: the separators Z*, the ASCII and C1 controls among them. Fixed values.
SPACE_CLASS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
WORD_CLASS = r"\p{L}\p{N}_"
KEEP, EXTRA = ":().", "_ㆍ"


def remove_whitespace(text: Column) -> Column:
    """All white space removed; null becomes the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", "")


def _class(chars: str) -> str:
    return "".join("\\" + c if c in r"\]^[-" else c for c in chars)


def sanitize_text(text: Column, keep: str = KEEP, extra: str = EXTRA) -> Column:
    """Word characters and `keep` stay; afterwards the characters of `extra` go."""
    kept = F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{WORD_CLASS}{_class(keep)}]", "")
    return F.regexp_replace(kept, f"[{_class(extra)}]", "") if extra else kept


def apply_dictionary(text: Column, entries: Column) -> Column:
    """Every entry (err, fix) of an ordered array replaced in turn, on the result of the ones before."""
    return F.aggregate(entries, F.coalesce(text, F.lit("")), lambda acc, e: F.replace(acc, e["err"], e["fix"]))


def apply_dictionary_last(text: Column, entries: Column) -> Column:
    """Compatibility form: every replacement starts from the original text, so only the last entry shows."""
    last = F.element_at(entries, -1)
    return F.when(F.size(entries) > 0, F.replace(F.coalesce(text, F.lit("")), last["err"], last["fix"])).otherwise(F.coalesce(text, F.lit("")))


def decimal_text(text: Column, pattern: str) -> Column:
    """Commas and spaces go; if the pattern doesn't match from the start, digits and the last dot are what is kept."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), "[, ]", "")
    if not pattern:
        return plain
    digits = F.regexp_replace(F.regexp_replace(plain, "[^0-9.]", ""), r"\.(?=.*\.)", "")
    return F.when(plain.rlike(f"^(?:{pattern})"), plain).otherwise(digits)


def _parsed(text: Column, formats: list[str]) -> Column:
    return F.coalesce(*(F.try_to_timestamp(F.trim(F.coalesce(text, F.lit(""))), F.lit(f)) for f in formats))


def date_text(text: Column, out: str, formats: list[str]) -> Column:
    """The first format that parses, written as `out`; a text that none parses stays as it is (date_error() names it)."""
    return F.coalesce(F.date_format(_parsed(text, formats), out), text)


def date_error(text: Column, out: str, formats: list[str]) -> Column:
    """The error of a text that no format parses; else null."""
    return F.when(_parsed(text, formats).isNull(), F.lit(f"no date like {out}"))


def numeric(text: Column) -> Column:
    """Digits, dot and minus as a number; null with two dots, two minuses or no number."""
    kept = F.regexp_replace(F.coalesce(text, F.lit("")), "[^0-9.-]", "")
    good = (F.regexp_count(kept, F.lit(r"\.")) <= 1) & (F.regexp_count(kept, F.lit("-")) <= 1)
    return F.when(good, kept.try_cast("double"))


def same_key(a: Column, b: Column) -> Column:
    """Equal but for spaces."""
    return F.replace(a, F.lit(" "), F.lit("")) == F.replace(b, F.lit(" "), F.lit(""))


def is_korean(text: Column, share: float = 0.3) -> Column:
    """Whether so large a share of the letters is Hangul."""
    letters = F.regexp_count(text, F.lit(r"\p{L}"))
    return (letters > 0) & (F.regexp_count(text, F.lit(r"[가-힣ᄀ-ᇿ㄰-㆏]")) >= F.lit(share) * letters)


def script_language(text: Column) -> Column:
    """A language code from the script: ko, ja, zh, ru, en; empty without letters."""
    has = lambda cls: F.regexp_count(text, F.lit(cls)) > 0
    return (
        F.when(is_korean(text), "ko").when(has(r"[぀-ヿ]"), "ja").when(has(r"[一-鿿]"), "zh")
        .when(has(r"[Ѐ-ӿ]"), "ru").when(has(r"[A-Za-zÀ-ÿ]"), "en").otherwise("")
    )


def json_set(props: Column, path: str, value: Column) -> Column:
    """A JSON object with the value at `path` (keys joined by dots) set or added; null for null or for text that is no object.

    Everything else keeps its type; where a key on the way is missing, or no object, nothing changes.
    """
    key, _, rest = path.partition(".")
    fields = F.from_json(props, "map<string,variant>")
    if not rest:
        new = F.parse_json(F.regexp_extract(F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"}), r'^\{"v":(.*)\}$', 1))
        return F.to_json(F.map_concat(F.map_filter(fields, lambda k, _: k != key), F.create_map(F.lit(key), new)))
    inner = json_set(F.to_json(F.element_at(fields, key)), rest, value)
    changed = F.to_json(F.transform_values(fields, lambda k, v: F.when((k == key) & inner.isNotNull(), F.try_parse_json(inner)).otherwise(v)))
    return F.when(F.map_contains_key(fields, key) & inner.isNotNull(), changed).otherwise(F.when(fields.isNotNull(), props))


def safe_float(text: Column) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def truthy(text: Column) -> Column:
    """y, yes, t, true, on, 1 in any case."""
    return F.lower(F.trim(text)).isin("y", "yes", "t", "true", "on", "1")


@lru_cache(maxsize=4096)
def _patterns(full: str) -> dict[int, tuple[str, ...]]:
    """Distinct substrings of `full` by power-of-two length."""
    n, out, size = len(full), {}, 1
    while size <= n:
        out[size] = tuple({full[i : i + size] for i in range(n - size + 1)})
        size *= 2
    return out


def contain_score(target: str | None, full: str | None) -> float:
    """How much of `full` lies in `target`, spaces ignored; keys of fewer than two characters score 0.

    Substrings of power-of-two lengths are looked for without overlap. Starting points are grouped by how many substrings start there; each group of
    g adds g * (1 - (1 - g / P) ** (count + 1)), at most g, and the density is the best window as wide as the key.
    """
    full, target = (full or "").replace(" ", ""), (target or "").replace(" ", "")
    n = len(full)
    if n < 2:
        return 0.0
    p = (n - 1).bit_length()
    top = p * (p + 1) / 2
    seen, weight = Counter(), Counter()
    for size, patterns in _patterns(full).items():
        wanted, last = set(patterns), {}
        for at in range(len(target) - size + 1):
            part = target[at : at + size]
            if part in wanted and last.get(part, -size) + size <= at:
                last[part] = at
                seen[at] += 1
                weight[at] += p - (size.bit_length() - 1)
    match = sum(min(g * (1 - (1 - g / p) ** (count + 1)), g) / top for g, count in Counter(seen.values()).items())
    density, scale = 0.0, n * top - (top - p - 1) * (p - 1)
    if len(target) >= n and scale:
        run = best = sum(weight[i] for i in range(n))
        for i in range(n, len(target)):
            run += weight[i] - weight[i - n]
            best = max(best, run)
        density = best / scale
    both = 0.6 * match + 0.6 * density
    return min(0.6 * match + 0.4 * density, 1.0) if both > 1 else both


def contain_check(target: Column, full: Column) -> Column:
    """contain_score() by Arrow batches: counting groups of overlapping positions has no built-in form."""

    def score(target: pd.Series, full: pd.Series) -> pd.Series:
        return pd.Series([contain_score(t, f) for t, f in zip(target, full)], dtype="float64")

    return F.pandas_udf(score, "double")(target, full)


#: Codes by the names that documents and detectors use; empty where translators don't know the language. Fixed values.
LANGUAGE_CODES = {
    "en": "en", "ko": "ko", "zh_sim": "zh", "zh_tra": "zh-TW", "ja": "ja", "es": "es", "fr": "fr", "de": "de", "ru": "ru", "ar": "ar", "pt": "pt", "bo": "", "mn": "",
    "vi": "vi", "ug": "", "th": "th", "tl": "fil", "hi": "hi", "bn": "bn", "ur": "ur",
    "eng": "en", "kor": "ko", "zho": "zh", "chi": "zh", "jpn": "ja", "spa": "es", "fra": "fr", "fre": "fr", "deu": "de", "ger": "de", "rus": "ru", "ara": "ar", "por": "pt",
    "bod": "", "tib": "", "mon": "", "vie": "vi", "uig": "", "tha": "th", "tgl": "fil", "fil": "fil", "hin": "hi", "ben": "bn", "urd": "ur",
    "영어": "en", "한국어": "ko", "중국어": "zh", "중국어 번체": "zh-TW", "일본어": "ja", "스페인어": "es", "프랑스어": "fr", "독일어": "de", "러시아어": "ru", "아랍어": "ar",
    "포르투갈어": "pt", "티베트어": "", "몽골어": "", "베트남어": "vi", "위구르어": "", "태국어": "th", "타갈로그어": "fil", "필리핀어": "fil", "힌디어": "hi", "벵골어": "bn", "우르두어": "ur",
}


def language_code(name: Column) -> Column:
    """The translator's code for the name as it is; empty for one that isn't listed."""
    codes = F.create_map(*(F.lit(x) for kv in LANGUAGE_CODES.items() for x in kv))
    return F.coalesce(F.try_element_at(codes, name), F.lit(""))
