"""Numbers of texts, vectors and boxes, encodings and times as Column functions."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def entropy(text: Column) -> Column:
    """Bits a character; 0 for an empty text (M01). A character's count is what the text loses in length without it."""
    n = F.length(text)
    counts = F.transform(F.array_distinct(F.split(text, "")), lambda c: (n - F.length(F.replace(text, c, F.lit("")))).cast("double"))
    total = F.aggregate(counts, F.lit(0.0), lambda s, k: s + F.when(k > 0, k * F.log2(k)).otherwise(0.0))
    return F.when(n > 0, F.log2(n.cast("double")) - total / n).when(n == 0, 0.0)


@F.pandas_udf(DoubleType())
def compression(text: pd.Series) -> pd.Series:
    """zlib bytes over UTF-8 bytes; 0 for an empty text."""
    return text.map(lambda t: len(zlib.compress(t.encode())) / len(t.encode()) if t else 0.0, na_action="ignore").astype("float64")


def letter_share(text: Column) -> Column:
    """Letters over characters; 0 for an empty text."""
    return F.when(F.length(text) > 0, F.regexp_count(text, F.lit(r"\p{L}")) / F.length(text)).when(F.length(text) == 0, 0.0)


def term_weight(tf: Column, df: Column, n: Column) -> Column:
    """(1 + ln tf) (ln((1 + n) / (1 + df)) + 1)."""
    return (1 + F.log(tf)) * (F.log((1 + n) / (1 + df)) + 1)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if either is empty."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 if either has length 0."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms).otherwise(0.0)


def lexical_overlap(query: Column, text: Column) -> Column:
    """The share of the query's words of over 2 characters that stand in the text."""
    tokens = F.filter(F.split(F.lower(query), r"\s+"), lambda w: F.length(w) > 2)
    return F.when(F.size(tokens) > 0, F.size(F.filter(tokens, lambda w: F.contains(F.lower(text), w))) / F.size(tokens)).otherwise(0.0)


def iou(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Intersection over union of boxes (x1, y1, x2, y2); 0 for degenerate ones."""
    side = lambda i: F.greatest(F.lit(0.0), F.least(a[i + 2], b[i + 2]) - F.greatest(a[i], b[i]))
    area = lambda x: F.greatest(F.lit(0.0), x[2] - x[0]) * F.greatest(F.lit(0.0), x[3] - x[1])
    both = side(0) * side(1)
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(0.0)


def discrepance(a: Column, b: Column) -> Column:
    """|a - b| over the larger; 0 if both are 0."""
    return F.when(F.greatest(a, b) > 0, F.abs(a - b) / F.greatest(a, b)).otherwise(0.0)


def framed_digest(*parts: Column) -> Column:
    """sha256 of the parts, each after its length in bytes, so borders count."""
    framed = [F.concat(F.octet_length(p).cast("string"), F.lit(":"), p) for p in parts]
    return F.sha2(F.concat(*framed), 256)


def text_digest(text: Column) -> Column:
    """sha256 of the UTF-8 bytes in hexadecimal digits."""
    return F.sha2(text, 256)


def draw(seed: str, key: Column) -> Column:
    """The first 16 hexadecimal digits of sha256 of seed and key: an order that is the same everywhere."""
    return F.substring(F.sha2(F.concat(F.lit(seed + ":"), key.cast("string")), 256), 1, 16)


def zigzag(value: Column) -> Column:
    """Small numbers of either sign to small unsigned ones."""
    return F.shiftleft(value, 1).bitwiseXOR(F.shiftright(value, 31))


def varuint(value: Column) -> Column:
    """The hexadecimal digits of the LEB128 bytes of an unsigned 32-bit number."""
    n = F.when(value < 1 << 7, 1).when(value < 1 << 14, 2).when(value < 1 << 21, 3).when(value < 1 << 28, 4).otherwise(5)
    byte = lambda i: F.pmod(F.floor(value / F.pow(F.lit(128.0), i)).cast("long"), F.lit(128)) + F.when(i < n - 1, 128).otherwise(0)
    return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.lpad(F.hex(byte(i)), 2, "0")), "")


def to_utc(text: Column) -> Column:
    """A date, or an ISO time with Z, an offset or none (UTC), as a timestamp; null if it is neither."""
    return F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))


def softmax(score: Column, window) -> Column:
    """Over a window, less its largest score."""
    shifted = F.exp(score - F.max(score).over(window))
    return shifted / F.sum(shifted).over(window)
