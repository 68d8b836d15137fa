"""Sum-of-squares online packing of token sequences into windows.

N(h) is the number of open windows filled to level h. An item of s tokens goes to the level h (0: a new window) that minimises the sum of N(h)^2
afterwards; full windows count nothing. The rule keeps the levels spread, so later items find a window that they fill, and its waste
grows more slowly than the number of items.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import slices, table


@lru_cache(2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(2)
def _added(path: str) -> tuple[re.Pattern | None, dict[str, int]] | None:
    """The vocabulary's added tokens, which are taken out of a text before all else; None if their rules are more than their strings."""
    added = {t.content: (n, t) for n, t in _tokenizer(path).get_added_tokens_decoder().items()}
    if any(t.normalized or t.single_word or t.lstrip or t.rstrip for _, t in added.values()):
        return None
    longest_first = sorted(added, key=len, reverse=True)
    return re.compile("|".join(map(re.escape, longest_first))) if added else None, {k: n for k, (n, _) in added.items()}


@lru_cache(2)
def _ranks(path: str):
    from .secrets import _encoding

    return _encoding(path)


def token_ids(text: str, vocabulary: str, ranks: str | None) -> np.ndarray:
    """Ids of the whole text as the tokenizer in ``vocabulary`` gives them, its added tokens included.

    With ``ranks``, the same vocabulary in ranked form, the faster library gives the same ids for what lies between added tokens; what
    it cannot take (very long runs of blanks overflow its matcher) goes to the tokenizer.
    """
    added = _added(vocabulary) if ranks else None
    if added:
        pattern, number = added
        try:
            parts, at = [], 0
            for found in pattern.finditer(text) if pattern else ():
                parts += [_ranked(text[at : found.start()], ranks), np.array([number[found.group()]], np.uint32)]
                at = found.end()
            parts.append(_ranked(text[at:], ranks))
            return np.concatenate(parts)
        except ValueError:
            pass
    return np.array(_tokenizer(vocabulary).encode(text, add_special_tokens=False).ids, np.uint32)


def _ranked(text: str, ranks: str) -> np.ndarray:
    return np.asarray(_ranks(ranks).encode_to_numpy(text, allowed_special=set(), disallowed_special=()), np.uint32)


class Packer:
    """Windows of ``size`` tokens, filled online. ``put`` returns (window, offset); windows are numbered from 0."""

    def __init__(self, size: int = 1024):
        self.size, self.made = size, 0
        self.count = np.zeros(size + 1, np.int64)  # N(h); N(0) and N(size) stay 0
        self.open: list[list[int]] = [[] for _ in range(size)]

    def new(self) -> int:
        self.made += 1
        return self.made - 1

    def put(self, item: int) -> tuple[int, int]:
        """Place an item of 1 to ``size`` tokens."""
        n, top = self.count, self.size - item
        # The change of the sum of squares: a window leaves level h (none does at 0) and comes to h + item (nothing counts at size).
        change = 2 * n[item:] + 1
        change[-1] = 0
        change[1:] -= 2 * n[1 : top + 1] - 1
        allowed = n[: top + 1] > 0
        allowed[0] = True
        change[~allowed] = np.iinfo(np.int64).max
        level = top - int(np.argmin(change[::-1]))  # of equal ones the fullest
        if level:
            window = self.open[level].pop()
            n[level] -= 1
        else:
            window = self.new()
        if level + item < self.size:
            self.open[level + item].append(window)
            n[level + item] += 1
        return window, level


def pack_shard(lengths: list[int], size: int) -> list[list[tuple[int, int, int, int]]]:
    """For each document the pieces (start, length, window, offset).

    A document is cut at multiples of ``size``; whole windows stand alone, the rest is an item. At the end the partially filled
    windows are joined: taken from the fullest, the emptiest ones' items move, cut if need be, into what is free. So at most one
    window of a shard is neither full nor joined by need.
    """
    packer = Packer(size)
    pieces: list[list[tuple[int, int, int, int]]] = []
    rests: dict[int, list[tuple[int, int, int]]] = {}  # window: (document, start, length) in order of offset
    for doc, length in enumerate(lengths):
        whole, rest = divmod(length, size)
        pieces.append([(i * size, size, packer.new(), 0) for i in range(whole)])
        if rest:
            window, _ = packer.put(rest)
            rests.setdefault(window, []).append((doc, whole * size, rest))
    partial = sorted((w for level in packer.open for w in level), key=lambda w: (-sum(x[2] for x in rests[w]), w))
    fill = {w: sum(x[2] for x in rests[w]) for w in partial}
    first, last = 0, len(partial) - 1
    while first < last:
        to, source = partial[first], partial[last]
        if not (free := size - fill[to]):
            first += 1
            continue
        if not rests[source]:
            last -= 1
            continue
        doc, start, length = rests[source].pop()
        took = min(free, length)
        if took < length:
            rests[source].append((doc, start, length - took))
        rests[to].append((doc, start + length - took, took))
        fill[to] += took
        fill[source] -= took
    for window, items in rests.items():
        offset = 0
        for doc, start, length in items:
            pieces[doc].append((start, length, window, offset))
            offset += length
    return [sorted(p) for p in pieces]


def id_lists(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The ids of each piece as an array."""
    return pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(flat.view(np.int32)))


def id_sums(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """crc32 of each piece's ids as little-endian 32-bit numbers."""
    stored, at = memoryview(flat.astype("<u4").tobytes()), (bounds * 4).tolist()
    return pa.array([zlib.crc32(stored[a:b]) for a, b in zip(at, at[1:])], pa.int64())


#: What a piece carries of its ids: column, type, and how it is made.
IDS, SUMS = ("ids", "array<int>", id_lists), ("ids_crc32", "long", id_sums)


def pack(docs: DataFrame, size: int = 1024, vocabulary: str | None = None, ranks: str | None = None, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = 1 << 23, carry: tuple = IDS) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids (or what ``carry`` makes of them), doc_tokens, sequence_id, offset.

    A document's tokens are those of its whole text, then ``end_id``; null and empty texts have that one only. Each task packs what
    it reads, in shards of about ``shard_tokens`` tokens, so nothing is shuffled and the waste is under one window a shard.
    ``sequence_id`` is made of the task's number and the window's within it; repeated rows are packed as rows of their own.
    """
    import public_tokenizers

    own = vocabulary is None
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    ranks = ranks or (public_tokenizers.path("byte_bpe_50k.tiktoken") if own else None)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    column, kind, make = carry
    names = ["doc_id", "start", "length", column, "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, 0
        held: list[tuple[int | None, np.ndarray]] = []

        def flush():
            rows = [(doc_id, piece, ids) for (doc_id, ids), pieces in zip(held, pack_shard([len(x) for _, x in held], size)) for piece in pieces]
            flat = np.concatenate([ids[piece[0] : piece[0] + piece[1]] for _, piece, ids in rows])
            lengths = [piece[1] for _, piece, _ in rows]
            windows = [piece[2] for _, piece, _ in rows]
            columns = [[r[0] for r in rows], [piece[0] for _, piece, _ in rows], lengths, [len(ids) for _, _, ids in rows], [base + made + w for w in windows], [piece[3] for _, piece, _ in rows]]
            arrays = [pa.array(c, pa.int64()) for c in columns]
            arrays.insert(3, make(flat, np.cumsum([0, *lengths])))
            return pa.RecordBatch.from_arrays(arrays, names=names), 1 + max(windows)

        tokens = 0
        for part in slices(batches, 1):
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                ids = np.append(token_ids(text, vocabulary, ranks) if text else np.empty(0, np.uint32), np.uint32(end_id)).astype(np.uint32, copy=False)
                held.append((doc_id, ids))
                tokens += len(ids)
                if tokens >= shard_tokens:
                    batch, windows = flush()
                    yield batch
                    made, held, tokens = made + windows, [], 0
        if held:
            yield flush()[0]

    return source.mapInArrow(run, f"doc_id long, start long, length long, {column} {kind}, doc_tokens long, sequence_id long, offset long")


def op6_packing(spark, sf_dir) -> DataFrame:
    """All ``documents`` in windows of 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"), carry=SUMS)
