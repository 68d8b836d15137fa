"""Checks and repairs of keywords."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .text import SCRIPTS, _fold

SANITIZED = StructType([StructField("value", StringType()), StructField("issues", ArrayType(StringType()))])
_SCRIPT_FORMS = {name: re.compile(f"[{ranges}]") for name, ranges in SCRIPTS.items()}


def clean(text: str) -> str:
    """Compatibility composition, format characters dropped, blanks collapsed."""
    text = "".join(c for c in unicodedata.normalize("NFKC", text) if unicodedata.category(c) != "Cf")
    return re.sub(r"\s+", " ", text).strip()


def unwrapped(text: str) -> str:
    """Fences, bullets, emphasis and paired quotes taken off, also where they are nested."""
    text = re.sub(r"^```\w*\n?|```$", "", text.strip()).strip()
    before = None
    while before != text:
        before = text
        text = re.sub(r"^(?:[-*•]|\d+[.)])\s+", "", text).strip()
        for a, b in (("**", "**"), ("*", "*"), ("_", "_"), ("`", "`"), ('"', '"'), ("'", "'"), ("«", "»"), ("“", "”")):
            if len(text) > len(a) + len(b) and text.startswith(a) and text.endswith(b):
                text = text[len(a) : -len(b)].strip()
    return text


def sanitize(text: str | None) -> dict:
    """A keyword's clean value, or null, and the sorted codes of what was wrong."""
    issues: set[str] = set()
    if text is None or not text.strip():
        return {"value": None, "issues": ["empty"]}
    value = clean(text)
    bare = unwrapped(value)
    if bare != value:
        issues.add("markup")
    label = re.sub(r"^(?:keywords?|palavras?-chave|mots?-cl[eé]s?|schlagw[oö]rter)\s*:\s*", "", bare, flags=re.IGNORECASE)
    if label != bare:
        issues.add("label")
    label = label.strip(" ,.;:-–—")
    if not re.search(r"\w", label):
        return {"value": None, "issues": sorted(issues | {"no_letters"})}
    if label.count("(") != label.count(")"):
        issues.add("parentheses")
        label = re.sub(r"[()\s]+", " ", label).strip()
    if len(label) > 120 or len(label.split()) > 12:
        return {"value": None, "issues": sorted(issues | {"too_long"})}
    if re.fullmatch(r"[\d\s.,:;-]+", label):
        return {"value": None, "issues": sorted(issues | {"numbers_only"})}
    return {"value": label, "issues": sorted(issues)}


@F.pandas_udf(SANITIZED)
def sanitized(text: pd.Series) -> pd.DataFrame:
    """``sanitize`` of each keyword."""
    return pd.DataFrame([sanitize(t) for t in text], columns=["value", "issues"])


def status(term: str | None, lexicon: set[str], stop: set[str]) -> str:
    """VALID, SUSPECT, STOPWORD, NOISE, MIXED_SCRIPT or UNKNOWN (D03): by the scripts, the stop words, then the lexicon by word."""
    value = sanitize(term)["value"]
    if value is None:
        return "NOISE"
    for word in re.findall(r"\w+", value):
        if sum(bool(f.search(word)) for f in _SCRIPT_FORMS.values()) > 1:
            return "MIXED_SCRIPT"
    words = re.findall(r"[^\W\d_]+", _fold(value))
    if not words or all(len(w) < 2 for w in words):
        return "NOISE"
    if all(w in stop for w in words):
        return "STOPWORD"
    known = sum(w in lexicon or w in stop for w in words)
    return "VALID" if known == len(words) else "SUSPECT" if known else "UNKNOWN"


def checked(term: Column, lexicon: frozenset[str], stop: frozenset[str]) -> Column:
    """``status`` of each term, the word lists once for each worker (D02). They are parameters, and sent with the function."""

    @F.pandas_udf(StringType())
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda t: status(t, lexicon, stop))

    return run(term)
