"""Secret scans: patterns of credentials, and a token-efficiency test for random strings.

Prose needs few tokens for many characters; a random string needs about one token for each one or two characters. A run of key
characters whose characters-per-token ratio under a byte-level vocabulary is low, and that is no known digest or identifier, is
reported as kind ``opaque``.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

from pyspark.sql import DataFrame

from .base import map_texts, slices

# The patterns of the base kinds, in their order.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "opaque")
#: Every match of ASSIGN has one of these, once lower-cased.
ASSIGN_HINTS = ("passw", "secret", "token", "api")

RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Hexadecimal digits of CRC-128, MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_DIGITS = {32, 40, 56, 64, 96, 128}
HEXADECIMAL = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
#: Names in snake, kebab or path form and numbers: each part is a word (with a number after it) or a number.
IDENTIFIER = re.compile(r"[+/_=-]*(?:(?:[A-Z]?[a-z]+|[A-Z]+)\d{0,4}|\d+)(?:[+/_=-]+(?:(?:[A-Z]?[a-z]+|[A-Z]+)\d{0,4}|\d+))*[+/_=-]*\Z")
#: Least characters of an identifier that can be random: of long words in four languages, 33 of 4,586 with 16 letters or more are under
#: two characters a token, with 20 or more 2, with 24 or more none.
NAMED = 20
SEPARATORS = re.compile(r"[+/_=-]+")
#: Camel case without digits.
CAMEL = re.compile(r"(?:[A-Z]?[a-z]{2,})(?:[A-Z][a-z]{2,})*\Z")


@lru_cache(2)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ratio(parts: list[str], encoding) -> float:
    """Characters per token of the parts together."""
    return sum(map(len, parts)) / max(1, sum(len(encoding.encode_ordinary(p)) for p in parts))


def is_opaque(run: str, encoding, max_ratio: float, window: int = 64) -> bool:
    """Whether a run is random by its characters per token, and neither a known digest nor an identifier.

    An identifier is exempt if its parts with letters are token-efficient themselves, or shorter than ``NAMED`` characters together. Other runs are random if any of their windows
    of ``window`` characters (each overlaps the next by half) or any part of 16 characters or more between separators is, so neither a
    path before a key nor the length of a run hides it.
    """
    if HEXADECIMAL.match(run) and (len(run) in DIGEST_DIGITS or run.isdigit()) or UUID.match(run):
        return False
    if len(set(run)) < 8:  # rules, padding, table borders
        return False
    parts = [p for p in SEPARATORS.split(run) if p]
    if CAMEL.match(run) or IDENTIFIER.match(run):
        named = [p for p in parts if not p.isdigit()]
        return sum(map(len, named)) >= NAMED and ratio(named, encoding) < max_ratio
    if any(len(p) >= 16 and len(set(p)) >= 8 and not HEXADECIMAL.match(p) and ratio([p], encoding) < max_ratio for p in parts):
        return True
    pieces = [run] if len(run) <= window else (run[i : i + window] for i in range(0, len(run) - window // 2, window // 2))
    return any(len(piece) >= 16 and len(set(piece)) >= 8 and ratio([piece], encoding) < max_ratio for piece in pieces)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, by start and kind; leftmost and without overlap within a kind."""
    spans = []
    low = text.lower()
    if any(hint in low for hint in ASSIGN_HINTS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def opaque_spans(text: str, found: list[tuple[int, int, int]], encoding, max_ratio: float) -> list[tuple[int, int, int]]:
    """Random runs that share no character with a span found already."""
    taken: list[list[int]] = []  # the spans found, joined where they overlap
    for start, _, end in found:
        if taken and start < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    spans, at = [], 0
    for m in RUN.finditer(text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if not (at < len(taken) and taken[at][0] < m.end()) and is_opaque(m.group(), encoding, max_ratio):
            spans.append((m.start(), 3, m.end()))
    return spans


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with each maximal run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def vocabulary(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_path: str | None = None, max_ratio: float = 2.0) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_opaque, base_spans, spans (texts ``kind:start:end`` by start, then kind, comma-joined).

    Reads the whole text of every row; offsets are code points, ends exclusive. Null and empty texts have no spans. Repeated rows
    give repeated results; a null id is passed on. No shuffle, nothing is gathered.
    """

    def scan(_, texts):
        encoding = _encoding(vocabulary(vocabulary_path))
        rows = []
        for text in texts:
            base = base_spans(text) if text else []
            extra = opaque_spans(text, base, encoding, max_ratio) if text else []
            rows.append((base, sorted(base + extra)))
        count = lambda kind: [sum(s[1] == kind for s in both) for _, both in rows]
        return {f"n_{name}": count(i) for i, name in enumerate(KINDS)} | {"base_spans": [spell(b) for b, _ in rows], "spans": [spell(s) for _, s in rows]}

    return map_texts(docs, scan, "n_assign long, n_access long, n_hex long, n_opaque long, base_spans string, spans string", id_col, text_col, binary=False)


def redact_secrets(docs: DataFrame, text_col: str = "text", vocabulary_path: str | None = None, max_ratio: float = 2.0, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret's span replaced by ``mark``; all columns and rows stay, repeated ones and null and empty texts too."""
    import pyarrow as pa

    at = docs.columns.index(text_col)

    def run(batches):
        encoding = _encoding(vocabulary(vocabulary_path))
        for batch in slices(batches, at):
            column = batch.column(at)
            texts = []
            for text in column.to_pylist():
                if text:
                    base = base_spans(text)
                    spans = base + opaque_spans(text, base, encoding, max_ratio)
                    text = redact(text, spans, mark) if spans else text
                texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, column.type) if i == at else batch.column(i) for i in range(batch.num_columns)], schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op1_secret_scan(spark, sf_dir) -> DataFrame:
    """The digest columns of the scan over ``documents``."""
    from pyspark.sql import functions as F

    from .base import table

    found = find_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_opaque")
