"""Near copies: SimHash fingerprints in BK-trees find candidates, the exact Jaccard similarity of word shingles decides.

A fingerprint of 64 bits cannot tell a similarity of 0.8 (9.7 bits apart on average) from lower ones at a radius that a tree of all
fingerprints could be searched with. Here it has 256 bits, and texts share a shard if four min-hashes of their shingle sets agree, in one
of 20 bands: at a similarity of exactly 0.8 that misses one pair in 38,000, above it fewer. Each shard has a BK-tree, searched within
64 bits (at 0.8 the mean is 39 and the standard deviation 5.7). Candidates are links only if both whole shingle sets say so.

Groups of many copies are joined in rounds, so that not all of their pairs are counted in full: first each set meets the nearest one
of its shards, then, twice, the nearest that the links so far do not reach; the last round takes all candidates still unconnected.
Pairs whose parity signatures differ in too many bits to reach the similarity are no candidates; that loses none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import blank_words, cut, map_texts
from .simhash import apart, components, in_parts, keep_one, shard_searches, text_hashes, whole_shards

#: 64-bit words of a fingerprint, min-hashes of a band, bands.
WORDS, ROWS, BANDS = 4, 4, 20
#: Odd multipliers, one for each min-hash.
MULTIPLIERS = np.random.default_rng(20).integers(0, 1 << 63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Other hashes of hashes (the finishing step of a splittable generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """XXH64 of each word, computed once."""

    def __missing__(self, word):
        value = self[word] = xxhash.xxh64_intdigest(word, 42)
        return value


def shingle_set(text: bytes | None, width: int = 5, known: WordHashes | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all shingles of ``width`` words; of a shorter text of its whole sequence, without words none."""
    words = blank_words(text)
    if not words:
        return np.empty(0, np.uint64)
    known = WordHashes() if known is None else known
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    total = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):  # a polynomial in the place of the word, then mixed
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(total)]
    return np.unique(mixed(total + np.uint64(width)))


def set_digest(shingles: np.ndarray) -> int:
    """One 64-bit signed number for a set."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes())).view(np.int64))


def wide_fingerprint(shingles: np.ndarray) -> bytes:
    """``WORDS`` words; a bit is 1 if it is set in over half of the shingles' hashes (the first word is that of their own hashes)."""
    counts = np.zeros(64 * WORDS, np.int64)
    for start in range(0, len(shingles), 1 << 14):
        part = shingles[start : start + (1 << 14)]
        words = np.stack([part, *(mixed(part + np.uint64(0x9E3779B97F4A7C15 * k % (1 << 64))) for k in range(1, WORDS))], 1)
        bits = np.unpackbits(words.astype("<u8").view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little")
        for at in range(0, len(bits), 255):  # the sum of 255 bits is a byte
            counts += np.add.reduce(bits[at : at + 255], axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > len(shingles), bitorder="little").tobytes()


def band_keys(shingles: np.ndarray) -> list[int]:
    """For each band one signed number of its min-hashes; none for the empty set."""
    if not len(shingles):
        return []
    low = np.full(len(MULTIPLIERS), np.uint64(0xFFFFFFFFFFFFFFFF))
    for start in range(0, len(shingles), 1 << 9):
        low = np.minimum(low, (shingles[None, start : start + (1 << 9)] * MULTIPLIERS[:, None]).min(axis=1))
    keys = [xxhash.xxh64_intdigest(x.tobytes(), band) for band, x in enumerate(low.reshape(BANDS, ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def signature(shingles: np.ndarray) -> np.ndarray:
    """A bit for each of 64 or more places (a power of two, the set's size at least): whether an odd number of hashes falls there."""
    places = 1 << max(6, (max(1, len(shingles)) - 1).bit_length())
    return np.packbits(np.bincount((shingles & np.uint64(places - 1)).astype(np.int64), minlength=places).astype(np.uint8) & 1, bitorder="little")


#: Bytes of the short signature that travels with a fingerprint.
SHORT = 64


def short_signature(shingles: np.ndarray) -> bytes:
    """The signature of 512 places, whatever the set's size."""
    parity = np.bincount((shingles & np.uint64(8 * SHORT - 1)).astype(np.int64), minlength=8 * SHORT).astype(np.uint8) & 1
    return np.packbits(parity, bitorder="little").tobytes()


def least_apart(a: bytes, b: bytes) -> int:
    """No more shingles than are in just one of the two sets: each bit that differs is one of them at least."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)))).sum())


def shared_shards(points: DataFrame) -> DataFrame:
    """shard, n (its points), digest, size, fp, short for each point in each shard that it shares with another one."""
    keyed = points.select("digest", F.explode("bands").alias("shard"))
    shared = keyed.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1")
    return keyed.join(shared, "shard").join(points.select("digest", "size", "fp", "short"), "digest").select("shard", "n", "digest", "size", "fp", "short")


def candidates(shards: DataFrame, threshold: float, radius: int, part_size: int, nearest: bool) -> DataFrame:
    """a, b (digests) and distance of points of one shard, but not of one ``root``, within the radius, whose sizes and short signatures
    allow the threshold.

    All such pairs, once or more; with ``nearest`` for each point the nearest it finds among those of its part of a shard.
    """
    columns = ("shard", "digest", "root", "size", "fp", "short")
    shards = shards.withColumn("parts", F.ceil(F.col("n") / part_size).cast("int"))
    if nearest:
        part = F.pmod(F.xxhash64("digest", F.lit(1)), F.col("parts"))
        tasks = shards.select(F.lit(2).cast("byte").alias("side"), F.xxhash64("shard", part).alias("shard"), *columns[1:])
    else:
        mixed_roots = shards.groupBy("shard").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("shard")
        tasks = in_parts(shards.join(mixed_roots, "shard"), "digest").select("side", *columns)

    def run(batches):
        for side, shard, digest, root, size, fp, short in whole_shards(batches, 7, 1):
            points = np.frombuffer(b"".join(fp), "<u8").reshape(len(fp), WORDS)
            marks = np.frombuffer(b"".join(short), "<u8").reshape(len(short), SHORT // 8)
            if not nearest:
                side = np.where((side == 2) & of_largest(shard, root), 0, side)
            for q, p in shard_searches(shard, side, points, radius):
                small, large = np.minimum(size[q], size[p]), np.maximum(size[q], size[p])
                ok = (root[q] != root[p]) & (small >= threshold * large - 1e-9) & ((side[p] != 2) | (digest[q] < digest[p]) | nearest)
                q, p = q[ok], p[ok]
                ok = apart(marks[q], marks[p]) <= (size[q].astype(np.int64) + size[p]) * (1 - threshold) / (1 + threshold) + 1e-6
                q, p = q[ok], p[ok]
                distance = apart(points[q], points[p])
                if nearest:
                    order = np.lexsort((digest[p], distance, q))
                    q, p, distance = q[order], p[order], distance[order]
                    head = np.r_[True, q[1:] != q[:-1]] if len(q) else np.empty(0, bool)
                    q, p, distance = q[head], p[head], distance[head]
                yield pa.RecordBatch.from_arrays([pa.array(digest[q]), pa.array(digest[p]), pa.array(distance, pa.int32())], names=["a", "b", "distance"])

    together = tasks.repartition("shard").sortWithinPartitions("shard", "digest")
    return together.mapInArrow(run, "a long, b long, distance int")


def of_largest(shard: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Whether a row is of the root that most rows of its shard have; these need not ask each other."""
    order = np.lexsort((root, shard))
    head = np.r_[True, (shard[order][1:] != shard[order][:-1]) | (root[order][1:] != root[order][:-1])]
    run = np.cumsum(head) - 1
    size, at = np.bincount(run), order[head]
    best = np.lexsort((size, shard[at]))
    last = best[np.r_[shard[at][best][1:] != shard[at][best][:-1], True]]
    out = np.empty(len(shard), bool)
    out[order] = np.isin(run, last)
    return out


def screened(pairs: DataFrame, points: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose signatures leave it open whether they reach the threshold; none that does is lost."""

    def side(name):
        return points.select(F.col("digest").alias(name), F.col("size").alias(f"size_{name}"), F.col("signature").alias(f"bits_{name}"))

    def run(batches):
        for batch in batches:
            size = batch.column(2).to_numpy() + batch.column(4).to_numpy()
            least = np.fromiter(map(least_apart, batch.column(3).to_pylist(), batch.column(5).to_pylist()), np.int64, batch.num_rows)
            yield batch.select([0, 1]).filter(pa.array(least <= size * (1 - threshold) / (1 + threshold) + 1e-6))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "size_a", "bits_a", "size_b", "bits_b")
    return both.mapInArrow(run, "a long, b long")


def sets_of(asked: DataFrame, points: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """digest, shingles: the whole set of each asked digest, from the text of one of its rows."""
    ids = points.join(asked, "digest", "left_semi").select(F.col("first").alias("doc_id")).where("doc_id is not null")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.join(ids, "doc_id", "left_semi").unionByName(texts.where("doc_id is null"))  # sets of rows without an id may link others

    def run(_, texts):
        known = WordHashes()
        sets = [shingle_set(t, width, known) for t in texts]
        return {"digest": [set_digest(x) for x in sets], "shingles": [x.view(np.int64) for x in sets]}

    sets = map_texts(texts, run, "digest long, shingles array<long>").drop("doc_id")
    return sets.join(asked, "digest", "left_semi").dropDuplicates(["digest"])


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose sets reach the threshold, counted in full."""
    both = pairs
    for name in ("a", "b"):
        both = both.join(sets.select(F.col("digest").alias(name), F.col("shingles").alias(f"s{name}")), name)
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(common >= threshold * (F.size("sa") + F.size("sb") - common) - 1e-9).select("a", "b")


def grouped(docs: DataFrame, id_col: str, text_col: str, width: int, threshold: float, radius: int, part_size: int, rounds: int = 3) -> DataFrame:
    """doc_id, text_hash, digest, component_id for each row of ``docs``."""

    def run(_, texts):
        known = WordHashes()
        sets = [shingle_set(t, width, known) for t in texts]
        return {
            "text_hash": text_hashes(texts),
            "digest": [set_digest(x) for x in sets],
            "size": [len(x) for x in sets],
            "fp": [wide_fingerprint(x) for x in sets],
            "short": [short_signature(x) for x in sets],
            "signature": [signature(x).tobytes() for x in sets],
            "bands": [band_keys(x) for x in sets],
        }

    schema = "text_hash long, digest long, size int, fp binary, short binary, signature binary, bands array<long>"
    marked = cut(map_texts(docs, run, schema, id_col, text_col))
    points = cut(marked.groupBy("digest").agg(F.min("doc_id").alias("first"), *[F.first(c).alias(c) for c in ("size", "fp", "short", "signature", "bands")]))
    shards = cut(shared_shards(points))

    def nearest(rooted):
        found = candidates(rooted, threshold, radius, min(part_size, 128), True)
        return found.groupBy("a").agg(F.min(F.struct("distance", "b")).alias("low")).select("a", F.col("low.b").alias("b"))

    def rooted(links):
        roots = components(links)
        return shards.join(roots, shards.digest == roots.node, "left").select(*shards.columns, F.coalesce("root", "digest").alias("root"))

    pairs = cut(nearest(shards.withColumn("root", F.col("digest"))))
    # a point of a shard in several parts may have its first candidate in a later round
    late = shards.where(F.col("n") > min(part_size, 128)).select("digest")
    asked = pairs.select(F.col("a").alias("digest")).unionByName(pairs.select(F.col("b").alias("digest"))).unionByName(late).distinct()
    sets = cut(sets_of(asked, points, docs, id_col, text_col, width))
    links = cut(verified(pairs, sets, threshold))
    for _ in range(rounds - 1):
        links = cut(links.unionByName(verified(nearest(rooted(links)), sets, threshold)))
    pairs = candidates(rooted(links), threshold, radius, part_size, False).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = links.unionByName(verified(cut(screened(pairs, points, threshold)), sets, threshold))
    roots = components(links)
    root = points.join(roots, points.digest == roots.node, "left").select("digest", "first", F.coalesce("root", "digest").alias("root"))
    names = root.join(root.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("digest", "component_id")
    return marked.select("doc_id", "text_hash", "digest").join(names, "digest")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: float = 0.8, radius: int = 64, part_size: int = 1024) -> DataFrame:
    """doc_id, component_id (the smallest doc_id that links of the similarity reach), one row for each row of ``docs``.

    Null and empty texts, and texts of blanks, are copies of each other. Rows with a null id link others like any row, but give a
    component no id unless all of its rows have none: then component_id is null.
    """
    return grouped(docs, id_col, text_col, width, threshold, radius, part_size).select("doc_id", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: float = 0.8, radius: int = 64, part_size: int = 1024) -> DataFrame:
    """``docs`` with one row of each component, see ``keep_one``: that of the smallest id."""
    return keep_one(docs, grouped(docs, id_col, text_col, width, threshold, radius, part_size), id_col, text_col)
