"""Toxicity: a factorization machine over hashed terms.

    y(x) = w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

x_i says whether a term that hashes to bucket i stands in the text. The factors v give each pair of terms a weight of its own, so
that an insult together with a mention of a group can weigh more than the sum of both.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import crc_of_id, cut, item_words, map_texts, slices, table


@dataclass
class Machine:
    """A fitted machine: the sorted active buckets, their weights and factors; every other bucket has weight 0."""

    bits: int
    buckets: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def probabilities(self, rows: list[np.ndarray]) -> np.ndarray:
        """Of label 1, for texts given as positions of their active buckets."""
        lengths = np.array([len(r) for r in rows], int)
        flat = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
        return _sigmoid(_scores(flat, lengths, self.bias, self.weights, self.factors)[0])


def _sigmoid(y: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(y, -35, 35)))


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of rows; an empty group has sum 0."""
    ends = np.cumsum(lengths)
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[ends] - total[ends - lengths]


def _scores(flat, lengths, bias, weights, factors):
    v = factors[flat]
    s = _sums(v, lengths)
    return bias + _sums(weights[flat], lengths) + 0.5 * ((s * s).sum(1) - _sums((v * v).sum(1), lengths)), s


#: Lengths in bytes of the word beginnings (stems) that are terms too, so that unseen inflections of a learnt stem count.
STEMS = (4, 5)


def word_bucket(word: bytes, bits: int) -> int:
    return zlib.crc32(word) >> (32 - bits)


def stem_buckets(word: bytes, bits: int) -> list[int]:
    return [zlib.crc32(word[:n] + b"-") >> (32 - bits) for n in STEMS if len(word) > n]


def fit(rows: list[np.ndarray], labels: np.ndarray, bits: int = 24, rank: int = 8, min_texts: int = 3, min_z: float = 4.0, max_buckets: int = 1 << 15, epochs: int = 40, seed: int = 7) -> Machine:
    """A machine from texts, given as arrays of distinct buckets, and their labels 0 or 1.

    Buckets become active if ``min_texts`` texts have them and their share differs between the labels by ``min_z`` standard errors;
    ``max_buckets`` is the most that are kept, by that measure. AdaGrad on the logistic loss, with a small L2 penalty; the seed
    fixes every choice. Texts of the rarer label weigh more, by the root of the labels' ratio. Without both labels the machine is the smoothed share of label 1.
    """
    labels = np.asarray(labels, np.float64)
    n, n1 = len(labels), labels.sum()
    weight = np.where(labels == 1, max(1.0, (n - n1) / max(n1, 1)) ** 0.5, max(1.0, n1 / max(n - n1, 1)) ** 0.5)
    empty = Machine(bits, np.empty(0, np.int64), float(np.log((n1 + 0.5) / (n - n1 + 0.5))), np.empty(0), np.empty((0, rank)))
    if not 0 < n1 < n:
        return empty
    lengths = np.array([len(r) for r in rows], int)
    flat = np.concatenate(rows).astype(np.int64)
    owner = np.repeat(np.arange(n), lengths)
    seen, index, count = np.unique(flat, return_inverse=True, return_counts=True)
    with1 = np.bincount(index, labels[owner], len(seen))
    p = (count + 1) / (n + 2)
    z = np.abs(with1 / n1 - (count - with1) / (n - n1)) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / (n - n1)))
    chosen = np.flatnonzero((count >= min_texts) & (z >= min_z))
    if len(chosen) > max_buckets:
        chosen = np.sort(chosen[np.argsort(-z[chosen], kind="stable")[:max_buckets]])
    if not len(chosen):
        return empty
    place = np.full(len(seen), -1)
    place[chosen] = np.arange(len(chosen))
    inside = place[index] >= 0
    flat, owner = place[index][inside], owner[inside]
    lengths = np.bincount(owner, minlength=n)
    ends = np.cumsum(lengths)

    draw = np.random.default_rng(seed)
    m = len(chosen)
    w, v, b = np.zeros(m), draw.normal(0, 0.01, (m, rank)), empty.bias
    gw, gv, gb, rate, l2, batch = np.full(m, 1e-6), np.full((m, rank), 1e-6), 1e-6, 0.2, 1e-5, 256
    for _ in range(epochs):
        order = draw.permutation(n)
        for start in range(0, n, batch):
            picked = order[start : start + batch]
            size = lengths[picked]
            at = np.repeat(ends[picked] - size - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            x = flat[at]
            y, s = _scores(x, size, b, w, v)
            error = (_sigmoid(y) - labels[picked]) * weight[picked]
            each = np.repeat(error, size)
            rows_s = np.repeat(s, size, axis=0)
            used, local = np.unique(x, return_inverse=True)
            dw = np.bincount(local, each, len(used)) / len(picked) + l2 * w[used]
            dv = np.stack([np.bincount(local, each * (rows_s[:, f] - v[x, f]), len(used)) for f in range(rank)], 1) / len(picked) + l2 * v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            w[used] -= rate * dw / np.sqrt(gw[used])
            v[used] -= 0.25 * rate * dv / np.sqrt(gv[used])
            db = error.mean()
            gb += db * db
            b -= rate * db / np.sqrt(gb)
    return Machine(bits, seen[chosen], float(b), w, v)


def _active_terms(used: DataFrame, chosen) -> DataFrame:
    """doc_id, terms: the active ones of each text, sorted; one row for each row, however many terms its text has.

    ``chosen``: an Arrow table of term and stem, whether a stem that stands in a text counts as this term; at most ``max_buckets`` rows.
    """
    import pyarrow as pa

    terms, stem = np.asarray(chosen["term"], np.int64), np.asarray(chosen["stem"], bool)
    shared = used.sparkSession.sparkContext.broadcast((terms, terms[stem]))

    def run(batches):
        active, stems = shared.value
        for batch in batches:
            own = []
            for words, tagged in zip(batch.column(1), batch.column(2)):
                words, tagged = np.asarray(words.values, np.int64), np.asarray(tagged.values, np.int64) >> 3
                own.append(np.union1d(words[np.isin(words, active)], tagged[np.isin(tagged, stems)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.list_(pa.int64()))], names=["doc_id", "terms"])

    return used.select("doc_id", "words", "stems").mapInArrow(run, "doc_id long, terms array<long>")


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_texts: int = 12_000, max_terms: int = 1 << 23, bits: int = 24, min_texts: int = 3, min_z: float = 4.0, max_buckets: int = 1 << 15, **options) -> Machine:
    """A machine from the labelled texts.

    The bound: the labelled ids with a text are taken in the order of a hash of the id, at most ``max_texts`` of them and ``max_terms``
    terms in all. An id with several labels has the largest; one with several texts that of the smallest hash, so repeated rows count
    as one. Rows without an id or a label teach nothing. Terms are counted in the cluster; to the driver come ``max_texts`` sizes and
    the rows' buckets that ``fit`` can use, at most ``max_buckets`` different ones.
    """
    picked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("label")).dropna().groupBy("doc_id").agg((F.max("label") > 0).cast("int").alias("label"))
    picked = cut(picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_texts))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(picked.select("doc_id")), "doc_id", "left_semi")

    def terms(_, texts):
        words = [set(item_words(t)) for t in texts]
        return {
            "text_hash": [zlib.crc32(t or b"") for t in texts],
            "words": [sorted({word_bucket(w, bits) for w in own}) for own in words],
            "stems": [sorted({stem << 3 | zlib.crc32(w) & 7 for w in own for stem in stem_buckets(w, bits)}) for own in words],
        }

    found = map_texts(texts, terms, "text_hash long, words array<int>, stems array<int>")
    found = found.groupBy("doc_id").agg(F.min_by(F.struct("words", "stems"), "text_hash").alias("own")).select("doc_id", "own.*")
    found = cut(found.join(F.broadcast(picked), "doc_id"))
    sizes = found.select("doc_id", "label", F.size("words").alias("n"), F.xxhash64("doc_id").alias("draw")).orderBy("draw", "doc_id").collect()  # max_texts rows at most
    kept = {r["doc_id"]: r["label"] for r, total in zip(sizes, np.cumsum([r["n"] for r in sizes])) if total <= max_terms}
    if not 0 < sum(kept.values()) < len(kept):
        return fit([np.empty(0, np.int64)] * len(kept), np.array(list(kept.values()), float), bits, **options)
    spark = docs.sparkSession
    used = found.join(F.broadcast(spark.createDataFrame([(k,) for k in kept], "doc_id long")), "doc_id", "left_semi")
    # A stem is a term if several words of texts with label 1 share it; else it would only repeat a word.
    tagged = used.where("label = 1").select(F.explode("stems").alias("tagged")).distinct()
    shared = tagged.groupBy(F.shiftright("tagged", 3).alias("term")).count().where("count >= 3").select("term")
    stems = used.select("doc_id", "label", F.explode("stems").alias("tagged")).select("doc_id", "label", F.shiftright("tagged", 3).alias("term")).join(shared, "term", "left_semi")
    rows = used.select("doc_id", "label", F.explode("words").alias("term")).unionByName(stems).distinct()
    n, n1 = len(kept), sum(kept.values())
    counts = rows.groupBy("term").agg(F.count("*").alias("n"), F.sum("label").alias("with1")).where(F.col("n") >= min_texts)
    share = (F.col("n") + 1) / (n + 2)
    z = F.abs(F.col("with1") / n1 - (F.col("n") - F.col("with1")) / (n - n1)) / F.sqrt(share * (1 - share) * (1 / n1 + 1 / (n - n1)))
    active = counts.withColumn("z", z).where(F.col("z") >= min_z).orderBy(F.desc("z"), "term").limit(max_buckets).select("term")
    data = dict.fromkeys(kept, np.empty(0, np.int64))
    chosen = active.join(shared.withColumn("stem", F.lit(True)), "term", "left").select("term", F.coalesce("stem", F.lit(False)).alias("stem"))
    for batch in _active_terms(used, chosen.toArrow()).toArrow().to_batches():
        data |= {doc_id: np.asarray(own.values, np.int64) for doc_id, own in zip(batch.column(0).to_pylist(), batch.column(1)) if len(own)}
    return fit(list(data.values()), np.array(list(kept.values()), float), bits, min_texts=min_texts, min_z=min_z, max_buckets=max_buckets, **options)


class _Places(dict):
    """Word to the places of its active buckets; forgets all when it grows large."""

    def __init__(self, machine: Machine, most: int = 500_000):
        self.bits, self.most = machine.bits, most
        self.of = dict(zip(machine.buckets.tolist(), range(len(machine.buckets))))

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self.most:
            self.clear()
        places = self[word] = tuple(self.of[b] for b in (word_bucket(word, self.bits), *stem_buckets(word, self.bits)) if b in self.of)
        return places


def _active(texts: list[bytes | None], places: _Places) -> list[np.ndarray]:
    """The distinct active places of each text."""
    look = places.__getitem__
    return [np.array(sorted(set(chain.from_iterable(map(look, set(item_words(t)))))), np.int64) for t in texts]


def score_texts(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score: the probability of label 1 for each row's whole text; texts without a known term, empty and null ones get the
    machine's bias. No shuffle; the machine is a broadcast of at most ``max_buckets`` rows."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    kept: list[_Places] = []

    def run(_, texts):
        kept or kept.append(_Places(shared.value))
        return {"score": shared.value.probabilities(_active(texts, kept[0])).tolist()}

    return map_texts(docs, run, "score double", id_col, text_col)


def drop_toxic(docs: DataFrame, machine: Machine, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, with all their columns; repeated rows fare alike.

    Null and empty texts have the machine's bias as their score, and stay unless that reaches the threshold.
    """
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(machine)
    at = docs.columns.index(text_col)

    def run(batches):
        places = _Places(shared.value)
        for batch in slices(batches, at):
            texts = [t.encode() if t else None for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(shared.value.probabilities(_active(texts, places)) < threshold))

    return docs.mapInArrow(run, docs.schema)


def op2_toxicity(spark, sf_dir) -> DataFrame:
    """Scores of all ``documents``; learnt from ``labels`` of ids whose crc32 mod 3 is not 1."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_of_id("doc_id") % 3 == 1, F.lit(False))
    machine = learn(docs, table(spark, sf_dir, "labels").where(~held_out))
    return score_texts(docs, machine).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
