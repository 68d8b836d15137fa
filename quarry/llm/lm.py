"""LM scoring by deleted interpolation.

    P(w | h) = a_b f(w | h) + b_b f(w) + c_b / (V + 1)

f are maximum-likelihood estimates from the counts of all training documents; b is the bucket of the context's frequency, the
integer part of its binary logarithm. The weights of a bucket are learnt by expectation-maximisation on held-out counts: each
training event is deleted from its own counts, and the mixture has to predict it from what is left. The n-grams are words and pairs.

The counts are sorted arrays of 64-bit hashes. A run of blocks of documents adds up its distinct words and word pairs and sends each
range of hashes its part of them; the range adds up those of all runs and sends each run its totals. So a key that fills a third of
the text is one number for each run, and what is sent grows with the distinct keys of the runs, not with the tokens. The messages are
as many as runs times ranges, and a range has 2 million tokens: some 5,000 of 100,000 keys at 1 GB of text and 13 million of some 700
at 50 GB, with 32 MB a run. Beyond that larger runs keep them few, as far as a worker's memory goes.

What is approximate: two words or pairs in 2^64 share a hash; and the weights are learnt from held-out ratios rounded to a sixteenth of
a binary logarithm (2.2 % at most), of which a table of a bounded size is all that reaches the driver. Scores use the exact counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import blank_words, crc_of_id, drop_kept, keep, slices, table

#: Stands for the end of a text; no word has a blank.
END = b" "
#: Stands for the context before the first word.
START = np.uint64(0x9E3779B97F4A7C15)
#: Steps of the binary logarithm in which held-out ratios are counted.
STEPS = 16
#: The least weight of the uniform distribution, so no token is impossible.
LEAST = 1e-4


def planes(values: np.ndarray, delta: bool = False) -> bytes:
    """64-bit values byte by byte, all first bytes first, compressed; with ``delta`` the differences of sorted values."""
    values = values.astype("<u8")
    if delta and len(values):
        values = np.concatenate([values[:1], np.diff(values)])
    return zstandard.compress(values.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unplanes(stored: bytes, delta: bool = False) -> np.ndarray:
    stored = zstandard.decompress(stored)
    values = np.ascontiguousarray(np.frombuffer(stored, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)
    return np.cumsum(values, dtype=np.uint64) if delta else values


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A hash of each pair of hashes."""
    x = before * np.uint64(0xBF58476D1CE4E5B9) + word
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(29)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


BLOCKS = "run long, block long, train_tokens long, train_docs long, ids array<long>, sizes array<int>, train array<boolean>, keys binary, tokens binary"


def blocks(docs: DataFrame, train, id_col: str, text_col: str, block_bytes: int, run_bytes: int) -> DataFrame:
    """Documents in blocks of about ``block_bytes`` of text, and these in runs of about ``run_bytes``: their words' hashes, and their tokens as numbers of words."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))

    def run(batches):
        from pyspark import TaskContext

        made = run_id = TaskContext.get().partitionId() << 32
        held = 0
        for part in slices(batches, 1, block_bytes):
            numbers = _Numbers({END: 0})
            tokens, sizes = [], []
            for text in part.column(1).to_pylist():
                words = blank_words(text)
                words.append(END)
                tokens.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
                sizes.append(len(words))
            keys = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), np.uint64, len(numbers))
            learnt = part.column(2).to_pylist()
            columns = {
                "run": [run_id], "block": [made], "train_tokens": [sum(n for n, t in zip(sizes, learnt) if t)], "train_docs": [sum(learnt)], "ids": [part.column(0).to_pylist()],
                "sizes": [sizes], "train": [learnt], "keys": [keys.tobytes()], "tokens": [planes(np.concatenate(tokens))],
            }
            made += 1
            held += sum(len(k) for k in part.column(1).to_pylist() if k)
            if held >= run_bytes:
                run_id, held = made, 0
            yield pa.RecordBatch.from_pydict(columns, schema=_schema(BLOCKS))

    return source.mapInArrow(run, BLOCKS)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<boolean>": pa.list_(pa.bool_())}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split(" ") for x in ddl.split(", "))])


@dataclass
class Block:
    """A block's tokens, with the sorted distinct keys of its words and pairs."""

    tokens: np.ndarray
    train: np.ndarray  # of each token
    word_order: np.ndarray  # sorted place to word number
    word_keys: np.ndarray
    pair_keys: np.ndarray
    pair_of: np.ndarray  # of each token

    @classmethod
    def read(cls, row: dict) -> Block:
        tokens, sizes = unplanes(row["tokens"]).astype(np.int32), np.array(row["sizes"], np.int64)
        keys = np.frombuffer(row["keys"], np.uint64)
        starts = np.zeros(len(tokens), bool)
        starts[np.cumsum(sizes) - sizes] = True
        word = keys[tokens]
        before = np.roll(word, 1)
        before[starts] = START
        pairs, pair_of = np.unique(pair_keys(before, word), return_inverse=True)
        order = np.argsort(keys)
        return cls(tokens, np.repeat(np.array(row["train"], bool), sizes), order, keys[order], pairs, pair_of.astype(np.int32))

    def counts(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Sorted keys and their counts in training documents, of words and of pairs."""
        words = np.bincount(self.tokens[self.train], minlength=len(self.word_keys))[self.word_order]
        return [(self.word_keys, words), (self.pair_keys, np.bincount(self.pair_of[self.train], minlength=len(self.pair_keys)))]


def _cuts(keys: np.ndarray, ranges: int) -> list[int]:
    """Where the sorted keys of each of ``ranges`` equal ranges of hashes begin, and the end."""
    return np.append(np.searchsorted(keys, np.array([(i << 64) // ranges for i in range(ranges)], np.uint64)), len(keys)).tolist()


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts; the list is emptied, so that its arrays go before those of the sums come."""
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    parts.clear()
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ np.uint64(1)))
    return keys[first], np.add.reduceat(counts[order], first, dtype=np.int64)


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    """Sorted distinct keys; the list is emptied."""
    keys = np.concatenate(parts)
    parts.clear()
    keys.sort()
    return keys[np.diff(keys, prepend=keys[:1] ^ np.uint64(1)) != 0]


def _in_order(group: pa.Table):
    """The rows of a run's blocks, each read when it is asked for."""
    for i in np.argsort(group.column("block").to_numpy()).tolist():
        yield group.slice(i, 1).to_pylist()[0]


def totals(found: DataFrame, ranges: int) -> DataFrame:
    """For each run, order and range: the totals over all runs of the run's keys; ``owned``: how many with a total it has first."""
    request = "range long, run long, order long, keys binary, counts binary"
    asked = _schema(request)

    def ask(group: pa.Table) -> pa.Table:
        run = group.column("run")[0].as_py()
        both: tuple[list, list] = ([], [])
        for row in _in_order(group):
            for own, (keys, counts) in zip(both, Block.read(row).counts()):
                own.append((keys, counts.astype(np.uint32)))
        columns: list[list] = [[] for _ in range(5)]
        for order, found in enumerate(both, 1):
            keys, counts = _added(found)
            at = _cuts(keys, ranges)
            for i in range(ranges):
                if at[i] < at[i + 1]:
                    part = slice(at[i], at[i + 1])
                    for column, value in zip(columns, (i, run, order, planes(keys[part], True), planes(counts[part]))):
                        column.append(value)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, asked)], schema=asked)

    answer = "run long, order long, range long, totals binary, owned long"

    def add(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["order"], r["run"]))
        out: list[list] = [[] for _ in range(5)]
        for order in (1, 2):
            own = [r for r in rows if r["order"] == order]
            if not own:
                continue
            keys = [unplanes(r["keys"], True) for r in own]
            _, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            total = np.bincount(place, np.concatenate([unplanes(r["counts"]) for r in own]).astype(np.float64)).astype(np.int64)
            ends = np.cumsum([len(k) for k in keys])
            owned = np.bincount(np.searchsorted(ends, first[total > 0], side="right"), minlength=len(own))
            for r, n, end, k in zip(own, owned.tolist(), ends.tolist(), keys):
                for column, value in zip(out, (r["run"], order, r["range"], planes(total[place[end - len(k) : end]]), n)):
                    column.append(value)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(out, _schema(answer))], schema=_schema(answer))

    return found.groupBy("run").applyInArrow(ask, request).groupBy("range").applyInArrow(add, answer)


JOINED = "block long, owned long, ids array<long>, sizes array<int>, train array<boolean>, tokens binary, word_totals binary, pair_totals binary"


def join(left: pa.Table, right: pa.Table) -> pa.Table:
    """A run's blocks with its totals. One block's pairs are held at a time: they are made once for the run's keys and once to be looked up."""
    word_keys, own_pairs = [], []
    for row in _in_order(left):
        block = Block.read(row)
        word_keys.append(block.word_keys)
        own_pairs.append(block.pair_keys)
        del block
    asked = [_distinct(word_keys), _distinct(own_pairs)]
    answers = sorted(right.to_pylist(), key=lambda r: (r["order"], r["range"]))
    owned = sum(r["owned"] for r in answers if r["order"] == 1)
    words, pairs = (np.concatenate([_narrow(unplanes(r["totals"])) for r in answers if r["order"] == order]) for order in (1, 2))
    del answers
    out: list[pa.RecordBatch] = []
    for row in _in_order(left):
        block = Block.read(row)
        by_number = np.empty(len(block.word_keys), np.uint64)
        by_number[block.word_order] = words[np.searchsorted(asked[0], block.word_keys)]
        own = pairs[np.searchsorted(asked[1], block.pair_keys)][block.pair_of]
        del block
        values = (row["block"], owned, row["ids"], row["sizes"], row["train"], row["tokens"], planes(by_number), planes(own))
        owned = 0
        out.append(pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _schema(JOINED))], schema=_schema(JOINED)))
    return pa.Table.from_batches(out, schema=_schema(JOINED))


def _narrow(values: np.ndarray) -> np.ndarray:
    """In 32 bits if all fit."""
    return values.astype(np.uint32) if not len(values) or values.max() < 1 << 32 else values


def joined(found: DataFrame, answers: DataFrame) -> DataFrame:
    """Each block with the totals of its words (by number) and of the pair at each token; a run's first block has what the run owns."""

    return found.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(join, JOINED)


def _events(row: dict, train_docs: int) -> tuple[np.ndarray, ...]:
    """Of each token: the totals of its context, its pair and its word; the documents' sizes."""
    tokens, sizes = unplanes(row["tokens"]).astype(np.int64), np.array(row["sizes"], np.int64)
    word = unplanes(row["word_totals"]).astype(np.int64)[tokens]
    context = np.roll(word, 1)
    context[np.cumsum(sizes) - sizes] = train_docs
    return context, unplanes(row["pair_totals"]).astype(np.int64), word, sizes


def bucket(context: np.ndarray) -> np.ndarray:
    """The integer part of the binary logarithm of the context's count; 0 for an unseen one."""
    return np.frexp(np.maximum(context, 1).astype(np.float64))[1].astype(np.int64) - 1


HELD = "bucket long, pair long, word long, n long"


def held_out(rows: DataFrame, train_docs: int) -> DataFrame:
    """How often each bucket has a deleted event of such ratios: steps of log2 f(w|h) (1: zero) and of log2 c(w) (-1: zero)."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                context, pair, word, sizes = (x for x in _events(row, train_docs))
                train = np.repeat(np.array(row["train"], bool), sizes)
                context, pair, word = context[train], pair[train] - 1, word[train] - 1
                with np.errstate(divide="ignore", invalid="ignore"):
                    p = np.where(pair > 0, np.rint(STEPS * np.log2(pair / np.maximum(context - 1, 1))), 1).astype(np.int64)
                    w = np.where(word > 0, np.rint(STEPS * np.log2(np.maximum(word, 1))), -1).astype(np.int64)
                code, n = np.unique(bucket(context) << 24 | (1 - p) << 12 | (w + 1), return_counts=True)
                columns = [code >> 24, 1 - (code >> 12 & 4095), (code & 4095) - 1, n]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_schema(HELD))

    return rows.mapInArrow(run, HELD).groupBy("bucket", "pair", "word").agg(F.sum("n").alias("n"))


def learn_weights(events: np.ndarray, train_tokens: int, distinct: int, rounds: int = 60) -> np.ndarray:
    """Weights (pair, word, uniform) of buckets 0 to 63 by expectation-maximisation; columns of ``events`` as in HELD.

    A bucket without events takes those of the bucket below; before the first of them all weight is on the words and the
    uniform part, without training tokens on the latter alone.
    """
    weights = np.empty((64, 3))
    last = np.array([0.0, 0.9, 0.1] if train_tokens else [0.0, 0.0, 1.0])
    for b in range(64):
        own = events[events[:, 0] == b]
        if len(own):
            n = own[:, 3].astype(np.float64)
            parts = np.stack([
                np.where(own[:, 1] == 1, 0.0, np.exp2(np.minimum(own[:, 1], 0) / STEPS)),
                np.where(own[:, 2] < 0, 0.0, np.exp2(own[:, 2] / STEPS) / max(train_tokens - 1, 1)),
                np.full(len(own), 1 / (distinct + 1)),
            ])
            last = np.full(3, 1 / 3)
            for _ in range(rounds):
                each = parts * last[:, None]
                last = (each / each.sum(0) * n).sum(1) / n.sum()
            last[2] = max(last[2], LEAST)
            last = last / last.sum()
        weights[b] = last
    return weights


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(rows: DataFrame, weights: np.ndarray, train_tokens: int, train_docs: int, distinct: int) -> DataFrame:
    """The scores of each document of the joined blocks."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                context, pair, word, sizes = _events(row, train_docs)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                mix = weights[bucket(context)]
                p = mix[:, 0] * pair / np.maximum(context, 1) + mix[:, 1] * word / max(train_tokens, 1) + mix[:, 2] / (distinct + 1)
                base = (word + 0.5) / (train_tokens + 0.5 * (distinct + 1))
                sums = [np.bincount(doc, x, len(sizes)) for x in (word > 0, np.log10(base), np.log10(p))]
                n = len(sizes)
                columns = [row["ids"], [not t for t in row["train"]], sizes, sums[0].astype(np.int64), np.full(n, train_tokens), sums[1], sums[2]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _schema(SCORED))], schema=_schema(SCORED))

    return rows.mapInArrow(run, SCORED)


def score_documents(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 5 << 20, run_bytes: int = 1 << 25, range_tokens: int = 1 << 21) -> DataFrame:
    """doc_id, held_out (not ``train``), n_tokens, n_known, train_tokens, base_score, score: one row for each row of ``docs``.

    ``train`` is a boolean column: whether a document is learnt from; null is not. Tokens are lower-cased words
    ``[^\\x20\\x09-\\x0D]+``, then one end; null and empty texts have the end alone. ``base_score`` is the add-half unigram score, ``score``
    the mixture's log10 probability. Without training documents each token has probability 1 / (V + 1) = 1.
    """
    found = keep(blocks(docs, train, id_col, text_col, block_bytes, run_bytes), "blocks")
    tokens = F.aggregate("sizes", F.lit(0).cast("long"), lambda n, x: n + x)
    sums = found.agg(F.sum("train_tokens"), F.sum("train_docs"), F.countDistinct("run"), F.sum(tokens)).first()
    train_tokens, train_docs = sums[0] or 0, sums[1] or 0
    ranges = max(1, min(sums[2], 8), -(-(sums[3] or 0) // range_tokens))
    rows = keep(joined(found, totals(found, ranges)), "joined")
    drop_kept(found)
    distinct = rows.agg(F.sum("owned")).first()[0] or 0
    events = np.array([tuple(r) for r in held_out(rows, train_docs).collect()], np.int64).reshape(-1, 4)
    weights = learn_weights(events[np.lexsort(events.T[::-1])], train_tokens, distinct)
    return score(rows, weights, train_tokens, train_docs, distinct)


def op10_lm_score(spark, sf_dir) -> DataFrame:
    """Scores of all ``documents``, learnt from those whose id's crc32 mod 5 is not 1."""
    return score_documents(table(spark, sf_dir, "documents"), crc_of_id("doc_id") % 5 != 1)
