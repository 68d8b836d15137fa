"""Text as Column functions: folding, cleaning, tokens, shingles, fingerprints, scripts, edit distances.

Built-in expressions where Spark has them. Exact Unicode normalisation has no built-in form; it is an Arrow-batched function.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType

# Accented Latin letters and what they fold to.
ACCENTED = "áàâäãéèêëíìîïóòôöõúùûüçñ"
FOLDED = "aaaaaeeeeiiiiooooouuuucn"

# Scripts and the ranges of their letters, as used in character classes.
SCRIPTS = {
    "latin": "A-Za-zÀ-ÖØ-öø-ÿĀ-ſ",
    "greek": "Ͱ-Ͽἀ-῿",
    "cyrillic": "Ѐ-ӿ",
    "hebrew": "֐-׿",
    "arabic": "؀-ۿ",
    "syriac": "܀-ݏ",
    "coptic": "Ⲁ-⳿",
}


def fold_latin(text: Column) -> Column:
    """Lower case, with the accents of common Latin letters taken off (X13, X26: the built-in subset)."""
    return F.translate(F.lower(text), ACCENTED, FOLDED)


def _fold(text: str) -> str:
    text = unicodedata.normalize("NFKD", text.replace("æ", "ae").replace("œ", "oe").replace("Æ", "AE").replace("Œ", "OE")).casefold()
    return "".join(c for c in text if not unicodedata.combining(c))


@F.pandas_udf(StringType())
def fold_unicode(text: pd.Series) -> pd.Series:
    """Compatibility decomposition, case folding, ligatures spelt out, combining marks dropped; null stays null."""
    return text.map(_fold, na_action="ignore")


@F.pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Canonical composition."""
    return text.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def visible(text: Column) -> Column:
    """Line ends as \\n and every kind of blank as a space (X01 without composition)."""
    return F.regexp_replace(F.regexp_replace(text, "\r\n?", "\n"), "[   -   　\t]", " ")


def join_hyphenation(text: Column) -> Column:
    """A word broken by a hyphen at a line's end is joined."""
    return F.regexp_replace(text, r"([\p{L}\p{N}])[-‐][ \t]*\n[ \t]*([\p{L}\p{N}])", "$1$2")


def clean_markup(text: Column) -> Column:
    """Tags to blanks, hyphenation joined, blanks within lines collapsed."""
    joined = join_hyphenation(F.regexp_replace(visible(text), "<[^>]*>", " "))
    return F.trim(F.regexp_replace(F.regexp_replace(joined, " +", " "), " ?\n ?", "\n"))


def compact(text: Column) -> Column:
    """Runs of blanks to one, none before punctuation."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, "[ \t]+", " "), " +([,.;:!?])", "$1"))


def strip_markdown(text: Column) -> Column:
    """Fences, emphasis, heading marks and bullets taken off."""
    for pattern, new in ((r"(?m)^```[a-zA-Z]*$", ""), (r"\*\*([^*\n]+)\*\*", "$1"), (r"(?m)^#{1,6} +", ""), (r"(?m)^[-*•] +", ""), (r"`([^`\n]+)`", "$1")):
        text = F.regexp_replace(text, pattern, new)
    return F.trim(text)


def strip_boilerplate(text: Column, phrases: list[str], min_line: int = 3) -> Column:
    """In this order: the phrases, web addresses, lines of fewer than ``min_line`` characters."""
    for phrase in phrases:
        text = F.replace(text, F.lit(phrase), F.lit(""))
    text = F.regexp_replace(text, r"https?://[^\s]+", "")
    return F.array_join(F.filter(F.split(text, "\n"), lambda line: F.length(F.trim(line)) >= min_line), "\n")


def words(text: Column, least: int = 3) -> Column:
    """Lower-case words of at least so many Latin letters, hyphenation joined and tags dropped."""
    plain = F.regexp_replace(join_hyphenation(text), "<[^>]*>", " ")
    return F.transform(F.regexp_extract_all(plain, F.lit("[a-zA-ZÀ-öø-ÿ]{%d,}" % least), F.lit(0)), F.lower)


def letters(text: Column, least: int = 3) -> Column:
    """Folded runs of at least so many letters of any script."""
    return F.regexp_extract_all(fold_latin(text), F.lit(r"\p{L}{%d,}" % least), F.lit(0))


def shingles(tokens: Column, width: int) -> Column:
    """The distinct runs of ``width`` tokens, joined by blanks; none for fewer tokens."""
    at = F.sequence(F.lit(1), F.greatest(F.size(tokens) - width + 1, F.lit(1)))
    made = F.transform(at, lambda i: F.array_join(F.slice(tokens, i, width), " "))
    return F.when(F.size(tokens) >= width, F.array_distinct(made)).otherwise(F.array().cast("array<string>"))


# Roman numerals.
ROMAN = (("M", 1000), ("CM", 900), ("D", 500), ("CD", 400), ("C", 100), ("XC", 90), ("L", 50), ("XL", 40), ("X", 10), ("IX", 9), ("V", 5), ("IV", 4), ("I", 1))
ROMAN_FORM = "^M{0,3}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$"


def roman_value(text: Column) -> Column:
    """The sum of Roman digits in any order, those before a larger one subtracted; null if another character is there."""
    digits = F.create_map(*[F.lit(x) for s, n in ROMAN if len(s) == 1 for x in (s, n)])
    values = F.transform(F.reverse(F.split(F.upper(text), "")), lambda c: digits[c])
    step = lambda s, v: F.struct((s["sum"] + F.when(v < s["top"], -v).otherwise(v)).alias("sum"), F.greatest(s["top"], v).alias("top"))
    total = F.aggregate(values, F.struct(F.lit(0).alias("sum"), F.lit(0).alias("top")), step, lambda s: s["sum"])
    return F.when(F.upper(text).rlike("^[MDCLXVI]+$"), total)


def roman_strict(text: Column, most: int = 1999) -> Column:
    """The value of a well-formed Roman numeral of 1 to ``most``; else null."""
    value = F.when(F.upper(text).rlike(ROMAN_FORM) & (F.length(text) > 0), roman_value(text))
    return F.when(value.between(1, most), value)


def to_roman(value: Column) -> Column:
    """Of 1 to 3999; else null."""
    rows = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(n).alias("n")) for s, n in ROMAN])
    step = lambda a, r: F.struct((a["left"] % r["n"]).alias("left"), F.concat(a["out"], F.repeat(r["s"], F.floor(a["left"] / r["n"]).cast("int"))).alias("out"))
    made = F.aggregate(rows, F.struct(value.cast("int").alias("left"), F.lit("").alias("out")), step, lambda a: a["out"])
    return F.when(value.between(1, 3999), made)


def declared_volumes(text: Column, word: str = "tomus") -> Column:
    """The sorted distinct values of Roman numerals after the word."""
    found = F.regexp_extract_all(F.upper(text), F.lit(word.upper() + r"\s+([MDCLXVI]+)\b"), F.lit(1))
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(found, lambda x: roman_value(x)))))


def agreement(a: Column, b: Column) -> Column:
    """1 - edit distance over the longer length, 4 places; 1 if both are empty, 0 if one is."""
    a, b = F.trim(F.coalesce(a, F.lit(""))), F.trim(F.coalesce(b, F.lit("")))
    score = F.round(1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)), 4)
    return F.when((a == "") & (b == ""), 1.0).when((a == "") | (b == ""), 0.0).otherwise(score)


def differing_characters(a: Column, b: Column, ranges: str = SCRIPTS["greek"]) -> Column:
    """Places at which either text has a character of the ranges and the texts differ, plus the difference in length."""
    both = F.arrays_zip(F.split(a, "").alias("a"), F.split(b, "").alias("b"))
    shared = F.slice(both, F.lit(1), F.least(F.length(a), F.length(b)))
    differ = F.filter(shared, lambda x: (x["a"] != x["b"]) & (x["a"].rlike(f"[{ranges}]") | x["b"].rlike(f"[{ranges}]")))
    return F.size(differ) + F.abs(F.length(a) - F.length(b))


def confusion_form(text: Column) -> Column:
    """Folded text with characters that scanners confuse made one."""
    out = fold_latin(text)
    for old, new in (("rn", "m"), ("cl", "d"), ("1", "l"), ("0", "o")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def _damerau(a: str, b: str) -> int:
    """Edits and swaps of neighbours, each place edited once; a column of the table is the bits of a number (Hyyrö)."""
    if a == b:
        return 0
    if not a or not b:
        return len(a) + len(b)
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full, last, n = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down, level, before = full, 0, 0, 0
    for y in b:
        at = places.get(y, 0)
        level = (((at & up) + up) ^ up | at | down | ((~level & at) << 1) & before) & full
        right, left = down | full & ~(level | up), level & up
        if right & last:
            n += 1
        elif left & last:
            n -= 1
        right, left = (right << 1 | 1) & full, left << 1
        up, down, before = (left | ~(level | right)) & full, right & level, at
    return n


def _confused(text: str) -> str:
    return text.replace("rn", "m").replace("cl", "d").replace("1", "l").replace("0", "o")


@F.pandas_udf(DoubleType())
def scan_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """The least of the normalised Damerau distance d of the texts, 0.12 + 0.88 d of the folded and 0.22 + 0.78 d of the confusion forms."""

    def one(x, y):
        if x is None or y is None:
            return None
        ratio = lambda p, q: _damerau(p, q) / max(len(p), len(q), 1)
        fx, fy = _fold(x), _fold(y)
        return min(ratio(x, y), 0.12 + 0.88 * ratio(fx, fy), 0.22 + 0.78 * ratio(_confused(fx), _confused(fy))) if x != y else 0.0

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")


def least_similarity(query: Column) -> Column:
    """The similarity that a fuzzy match of a folded query needs, by its words and length; null: none is allowed."""
    n, size = F.size(F.split(query, " ")), F.length(query)
    one = F.when(size >= 9, 0.78).when(size >= 7, 0.82)
    many = F.when(size >= 40, 0.78).when(size >= 20, 0.84).when(size >= 12, 0.90)
    return F.when(n == 1, one).otherwise(many)


def key_form(text: Column) -> Column:
    """Folded, upper case, only letters A-Z and digits."""
    return F.upper(F.regexp_replace(fold_latin(text), "[^a-z0-9]+", ""))


def slug(text: Column, default: str = "item") -> Column:
    """Folded words joined by hyphens."""
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(fold_latin(text), "[^a-z0-9]+", "-"), F.lit("-")), F.lit("")), F.lit(default))


def excerpt(text: Column, most: int) -> Column:
    """At most so many characters; a cut text loses blanks and punctuation at its end and gets an ellipsis."""
    return F.when(F.length(text) > most, F.concat(F.regexp_replace(F.substring(text, 1, most), r"[\s.,;:]+$", ""), F.lit("…"))).otherwise(text)


def is_heading(text: Column, words: list[str]) -> Column:
    """The first line begins with a heading word, or has at most 80 characters and over 70 % capitals among its letters."""
    line = F.trim(F.split(text, "\n")[0])
    capitals, every = F.regexp_count(line, F.lit(r"\p{Lu}")), F.regexp_count(line, F.lit(r"\p{L}"))
    begins = F.lower(line).rlike("^(" + "|".join(map(re.escape, words)) + r")([^\p{L}]|$)")
    return F.coalesce(begins | ((F.length(line) <= 80) & (every > 0) & (capitals > 0.7 * every)), F.lit(False))


def header_fingerprint(text: Column) -> Column:
    """Lower case, numbers to #, everything else but letters to single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]+", "#"), "[^a-z0-9#]+", " "))


def script_counts(text: Column) -> Column:
    """A map from scripts to their number of letters."""
    return F.create_map(*[x for name, ranges in SCRIPTS.items() for x in (F.lit(name), F.regexp_count(text, F.lit(f"[{ranges}]")))])


def script_flags(text: Column) -> Column:
    """The sorted names of scripts that occur."""
    return F.array_sort(F.array_compact(F.array(*[F.when(text.rlike(f"[{ranges}]"), F.lit(name)) for name, ranges in SCRIPTS.items()])))


def infer_script(text: Column, declared: Column) -> Column:
    """struct(script, confidence): "mixed" if the second script has 8 letters and 12 % or more; the declared script is confirmed (0.80 or
    more) or, where the observed share is under 0.75, kept at 0.55; without letters it is taken at 0.45, or null at 0 (X37)."""
    counts = F.reverse(F.array_sort(F.transform(F.map_entries(script_counts(text)), lambda e: F.struct(e["value"].alias("n"), e["key"].alias("s")))))
    total = F.aggregate(counts, F.lit(0), lambda a, c: a + c["n"])
    first, second = counts[0], counts[1]
    share = first["n"] / total
    known = F.coalesce(declared, F.lit("")) != ""
    answer = lambda s, c: F.struct(s.alias("script"), F.round(c, 4).cast("double").alias("confidence"))
    return (
        F.when(total == 0, answer(F.when(known, declared), F.when(known, F.lit(0.45)).otherwise(F.lit(0.0))))
        .when((second["n"] >= 8) & (second["n"] >= 0.12 * total), answer(F.lit("mixed"), share))
        .when(known & (declared == first["s"]), answer(first["s"], F.greatest(share, F.lit(0.80))))
        .when(known & (share < 0.75), answer(declared, F.lit(0.55)))
        .otherwise(answer(first["s"], share))
    )


def guess_language(text: Column, hint: Column) -> Column:
    """The hint, or the code of the first script that occurs."""
    codes = (("greek", "grc"), ("hebrew", "hbo"), ("arabic", "ara"), ("syriac", "syr"), ("coptic", "cop"), ("cyrillic", "chu"), ("latin", "lat"))
    by_script = F.coalesce(*[F.when(text.rlike(f"[{SCRIPTS[s]}]"), F.lit(c)) for s, c in codes])
    return F.coalesce(F.nullif(hint, F.lit("")), by_script, F.lit("und"))


def text_class(text: Column, declared: Column) -> Column:
    """mixed, greek or other: by the declared script, else by the characters."""
    greek, latin = text.rlike(f"[{SCRIPTS['greek']}]"), text.rlike(f"[{SCRIPTS['latin']}]")
    seen = F.when(greek & latin, "mixed").when(greek, "greek").otherwise("other")
    return F.when(declared.isin("mixed", "greek"), declared).otherwise(seen)


def kinds(text: Column, patterns: dict[str, str], most: int = 4000) -> Column:
    """The names of the patterns that the first ``most`` characters match, in their order (X42: a page's kind shows in its beginning)."""
    start = F.lower(F.substring(text, 1, most))
    return F.array_compact(F.array(*[F.when(start.rlike(p), F.lit(n)) for n, p in patterns.items()]))


def dedupe(items: Column) -> Column:
    """Without later items that equal an earlier one but for case."""
    low = F.transform(items, F.lower)
    return F.filter(items, lambda x, i: F.array_position(low, F.lower(x)) == i + 1)


def budget(text: Column, tokens: int, characters_per_token: float = 4.0) -> Column:
    """The end of the text that fits the number of tokens."""
    most = int(tokens * characters_per_token)
    return F.when(F.length(text) > most, F.right(text, F.lit(most))).otherwise(text)


def literal(label: Column) -> Column:
    """Separators to underscores; null unless several words remain."""
    made = F.trim(F.regexp_replace(label, r"[\s/,;.\-]+", "_"), F.lit("_"))
    return F.when(F.contains(made, F.lit("_")), made)


def record_text(*fields: Column) -> Column:
    """The distinct non-empty fields in order, joined by blanks."""
    return F.array_join(F.array_distinct(F.filter(F.array(*[F.trim(F.coalesce(f, F.lit(""))) for f in fields]), lambda x: x != "")), " ")


def has_any_character(text: Column, banned: list[str]) -> Column:
    """Whether a banned character stands in the text."""
    return F.arrays_overlap(F.split(text, ""), F.array(*map(F.lit, banned)))


@F.pandas_udf(BooleanType())
def sane_marks(text: pd.Series) -> pd.Series:
    """No combining mark begins a text or a word, and no letter has more than three."""
    return text.map(lambda t: not re.search(r"(?:^|\s)[̀-ͯ]|[̀-ͯ]{4}", unicodedata.normalize("NFD", t)), na_action="ignore")
