"""JSON and arrays as Column functions."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType


def json_items(text: Column, *names: str) -> Column:
    """The strings of the first of the named arrays that is there, or of the text itself if it is an array."""
    strings = "array<string>"
    return F.coalesce(*[F.from_json(F.get_json_object(text, f"$.{n}"), strings) for n in names], F.when(F.trim(text).startswith("["), F.from_json(text, strings)))


def json_numbers(text: Column, *names: str) -> list[Column]:
    """The named numbers of an object as integer columns."""
    parsed = F.from_json(text, ", ".join(f"{n} int" for n in names))
    return [parsed[n].alias(n) for n in names]


def any_kind(text: Column, kinds: list[str]) -> Column:
    """Whether an array of objects has one whose kind is listed; false for what is no such array."""
    return F.coalesce(F.exists(F.from_json(text, "array<struct<kind:string>>"), lambda e: F.coalesce(e["kind"].isin(*kinds), F.lit(False))), F.lit(False))


def expand_range(text: Column) -> Column:
    """The numbers of a list such as ``3-5,9`` in order."""
    parts = F.filter(F.split(F.regexp_replace(text, r"\s", ""), ","), lambda p: p.rlike("^[0-9]+(-[0-9]+)?$"))
    first = lambda p: F.element_at(F.split(p, "-"), 1).cast("int")
    last = lambda p: F.element_at(F.split(p, "-"), -1).cast("int")
    return F.flatten(F.transform(F.filter(parts, lambda p: first(p) <= last(p)), lambda p: F.sequence(first(p), last(p))))


def first_object(text: str) -> str | None:
    """The first complete JSON object in free text."""
    decoder = json.JSONDecoder()
    at = text.find("{")
    while at >= 0:
        try:
            found, _ = decoder.raw_decode(text, at)
            return json.dumps(found, ensure_ascii=False, sort_keys=True)
        except ValueError:
            at = text.find("{", at + 1)
    return None


@F.pandas_udf(StringType())
def json_object(text: pd.Series) -> pd.Series:
    """The first complete JSON object in each text, its keys sorted; null if there is none."""
    return text.map(first_object, na_action="ignore")


def _replaced(value, change):
    if isinstance(value, str):
        return change(value)
    if isinstance(value, list):
        return [_replaced(v, change) for v in value]
    if isinstance(value, dict):
        return {k: _replaced(v, change) for k, v in value.items()}
    return value


def replacer(mapping: dict[str, str], whole_only: bool = False):
    """What ``replace_strings`` does to one string."""
    wanted = {k.strip().lower(): v for k, v in mapping.items() if k.strip()}
    rules = [(re.compile(rf"(?<!\w){re.escape(k)}(?!\w)", re.IGNORECASE), wanted[k]) for k in sorted(wanted, key=len, reverse=True)]

    def change(value: str) -> str:
        whole = wanted.get(value.strip().lower())
        if whole is not None:
            return whole
        for pattern, into in () if whole_only else rules:
            value = pattern.sub(lambda _, into=into: into, value)
        return value

    return change


def replace_strings(text: Column, mapping: dict[str, str], whole_only: bool = False) -> Column:
    """The JSON text with the strings at any depth replaced; keys of objects and what is no JSON stay.

    Case and blanks around a string or a key of the mapping do not count. A string that is a key becomes its value; in others, unless
    ``whole_only``, each key that stands there as whole words is replaced, the longest keys first, one after the other.
    """
    change = replacer(mapping, whole_only)

    @F.pandas_udf(StringType())
    def run(texts: pd.Series) -> pd.Series:
        def one(t: str) -> str:
            try:
                return json.dumps(_replaced(json.loads(t), change), ensure_ascii=False)
            except ValueError:
                return t

        return texts.map(one, na_action="ignore")

    return run(text)


@F.pandas_udf(ArrayType(StructType([StructField("category", StringType()), StructField("items", ArrayType(StringType()))])))
def category_lines(text: pd.Series) -> pd.Series:
    """Lines ``name: a, b; c`` of free text; bullets and emphasis are tolerated, other lines passed over."""

    def one(t):
        found = []
        for line in t.splitlines():
            name, colon, rest = line.strip().strip("-*• ").replace("**", "").partition(":")
            items = [p.strip(" .*_`\"'") for p in rest.replace(";", ",").split(",")]
            if colon and name.strip() and any(items):
                found.append({"category": name.strip().lower(), "items": [i for i in items if i]})
        return found

    return text.map(one, na_action="ignore")


def decode_json(value: bytes | str | None) -> str | None:
    """A JSON text, plain or zlib-compressed (N08, D01); registered for SQL as ``decode_json``."""
    import zlib

    if value is None or isinstance(value, str):
        return value
    try:
        return zlib.decompress(value).decode()
    except zlib.error:
        return bytes(value).decode()


def register(spark) -> None:
    """The SQL functions of this package."""

    @F.pandas_udf(StringType())
    def run(values: pd.Series) -> pd.Series:
        return values.map(decode_json, na_action="ignore")

    spark.udf.register("decode_json", run)
