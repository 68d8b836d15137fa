"""SimHash near-duplicates: fingerprints of word shingles, linked within a Hamming radius through BK-trees.

Linked fingerprints agree in ``blocks - radius`` of ``blocks`` bit blocks at least (the pigeonhole principle), so each choice of
that many blocks, with its bits, names a shard that has both. A shard's BK-tree hangs each fingerprint under the child of its
parent's distance; a search follows only the edges whose distance differs from its own by the radius at most. Shards above a size
bound are cut into parts, and the tree of each part is sent to the tasks of the other parts.

Fingerprints of more than 64 bits (``copies``) are rows of 64-bit words in the same trees.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import blank_words, cut, map_texts, table


def fingerprint(text: bytes | None, width: int = 4, seed: int = 42) -> int:
    """64 bits, each 1 if it is set in over half of the hashes of all shingles of ``width`` words; 0 without words."""
    words = blank_words(text)
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(line, seed)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a:b], seed) for a, b in zip((ends - size).tolist(), ends[width - 1 :].tolist())]
    counts = np.zeros(64, np.int64)
    bits = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    for start in range(0, len(bits), 1 << 16):
        counts += np.unpackbits(bits[start : start + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


# --- BK-trees over arrays: many trees grow and are searched at once, level by level


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that differ; a fingerprint is a 64-bit word or a row of them."""
    bits = np.bitwise_count(a ^ b)
    return bits.astype(np.int64) if bits.ndim == 1 else bits.sum(axis=1, dtype=np.int64)


def reach(points: np.ndarray) -> int:
    """Edge keys of one parent: one more than the bits of a fingerprint."""
    return 64 * (points.shape[1] if points.ndim > 1 else 1) + 1


def grow(points: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges (parent * reach + distance, child) sorted by key, and the root of each tree.

    ``tree`` are the sorted tree numbers 0, 1, ... of the points. Equal points of a tree hang under each other at distance 0.
    """
    wide = reach(points)
    first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if len(tree) else np.empty(0, np.int64)
    roots = first.copy()
    waiting = np.setdiff1d(np.arange(len(points)), first)
    parent = first[tree[waiting]]
    keys, children = [], []
    while len(waiting):
        key = parent * wide + apart(points[waiting], points[parent])
        order = np.argsort(key, kind="stable")
        waiting, key = waiting[order], key[order]
        head = np.r_[True, key[1:] != key[:-1]]
        child = waiting[head]
        keys.append(key[head])
        children.append(child)
        parent = child[np.cumsum(head) - 1][~head]
        waiting = waiting[~head]
    key, child = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (keys, children))
    order = np.argsort(key)
    return key[order], child[order], roots


def search(points, edges, queries, start, radius):
    """Pairs (query number, point number) within the radius. ``start``: for each query the root of its tree."""
    key, child = edges
    wide = reach(points)
    asking, at = np.arange(len(queries)), start
    found_q, found_p = [], []
    while len(asking):
        distance = apart(queries[asking], points[at])
        near = distance <= radius
        found_q.append(asking[near])
        found_p.append(at[near])
        low = np.searchsorted(key, at * wide + np.maximum(distance - radius, 0))
        high = np.searchsorted(key, at * wide + np.minimum(distance + radius, wide - 1), side="right")
        n = high - low
        asking = np.repeat(asking, n)
        at = child[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
    return np.concatenate([np.empty(0, np.int64), *found_q]), np.concatenate([np.empty(0, np.int64), *found_p])


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the smallest node that the links a-b reach."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def shard_searches(shard: np.ndarray, side: np.ndarray, points: np.ndarray, radius: int, most: int = 1 << 21):
    """Row numbers (asking, found) of other points within the radius in the same shard, in pieces that hold all of an asking row.

    ``shard`` is sorted. Side 0 points make the tree, side 1 points ask it, side 2 points do both. ``most`` bounds the pairs of a
    question and a point that are looked at together.
    """
    number = np.cumsum(np.r_[False, shard[1:] != shard[:-1]])
    in_tree, asks = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    key, child, roots = grow(points[in_tree], np.unique(number[in_tree], return_inverse=True)[1])
    root_of = np.full(number[-1] + 1, -1)
    root_of[number[in_tree[roots]]] = roots
    asks = asks[root_of[number[asks]] >= 0]
    size = np.bincount(number[in_tree], minlength=number[-1] + 1)
    work = np.cumsum(size[number[asks]])
    for part in np.split(asks, np.searchsorted(work, np.arange(most, work[-1], most))) if len(work) else []:
        q, p = search(points[in_tree], (key, child), points[part], root_of[number[part]], radius)
        q, p = part[q], in_tree[p]
        other = q != p
        yield q[other], p[other]


def shard_links(shard: np.ndarray, side: np.ndarray, fp: np.ndarray, radius: int, most: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what lies within the radius in each shard: each point with the smallest it reaches there."""
    label = np.arange(len(fp))
    for q, p in shard_searches(shard, side, fp.view(np.uint64), radius, most):
        if len(q):
            label = forest(np.r_[label[q], np.arange(len(fp))], np.r_[label[p], label], len(fp))
    linked = label != np.arange(len(fp))
    return fp[linked], fp[label[linked]]


# --- distributed links and components


def block_masks(blocks: int, radius: int) -> list[int]:
    """Bit masks of each choice of ``blocks - radius`` of the blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    own = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(own, blocks - radius)]


def blocks_for(count: int, radius: int, shard_size: int = 128) -> int:
    """The fewest blocks at which a shard of evenly spread fingerprints has ``shard_size`` points at most. Every choice finds every link."""
    blocks = radius + 1
    while blocks < radius + 4 and count >> (64 * (blocks - radius) // blocks) > shard_size:
        blocks += 1
    return blocks


def links(points: DataFrame, radius: int = 4, part_size: int = 1024) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp`` of ``points`` that connect all within the radius.

    A shard of n points sends at most n links, not all pairs. Shards above ``part_size`` points are cut into parts by a hash; each
    pair of parts is a task of its own.
    """
    masks = block_masks(blocks_for(points.count(), radius), radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = points.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("bits")) for i, m in enumerate(signed)])).alias("shard"))
    keyed = keyed.select("fp", F.xxhash64("shard.choice", "shard.bits").alias("shard"))  # a rare clash of hashes joins two shards: no link is lost or wrong
    large = keyed.groupBy("shard").count().where(F.col("count") > part_size).select("shard", F.ceil(F.col("count") / part_size).cast("int").alias("parts"))
    sized = keyed.join(large, "shard", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))

    def run(batches):
        for side, shard, fp in whole_shards(batches, 3, 1):
            a, b = shard_links(shard, side, fp, radius)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    together = in_parts(sized, "fp").repartition("shard").sortWithinPartitions("shard", "fp")
    return together.mapInArrow(run, "a long, b long").distinct()


def in_parts(sized: DataFrame, point: str) -> DataFrame:
    """side, shard, and the other columns of ``sized`` (shard, parts, the column ``point``): each pair of a shard's parts is a shard of its own."""
    rest = [c for c in sized.columns if c not in ("shard", "parts")]
    part = F.pmod(F.xxhash64(point, F.lit(1)), F.col("parts")).cast("int")
    tasks = sized.withColumn("part", part).select("*", F.expr("explode(sequence(0, parts - 1))").alias("other"))
    return tasks.select(
        F.when(F.col("part") == F.col("other"), F.lit(2)).when(F.col("part") < F.col("other"), F.lit(0)).otherwise(F.lit(1)).cast("byte").alias("side"),
        F.xxhash64("shard", F.least("part", "other"), F.greatest("part", "other")).alias("shard"),
        *rest,
    )


def whole_shards(batches, columns: int, shard: int, rows: int = 1 << 14):
    """Lists of arrays that hold whole shards, of about ``rows`` rows. Batches are sorted by column number ``shard``."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(columns)]
        held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
        whole = int(np.searchsorted(held[shard], held[shard][-1]))  # the last shard may go on
        if whole > rows:
            yield [x[:whole] for x in held]
            held = [x[whole:] for x in held]
    if held is not None and len(held[0]):
        yield held


def contracted(edges: DataFrame) -> DataFrame:
    """u, v (v < u): in each partition every node with the smallest one that the partition's edges reach from it."""

    def run(batches):
        got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not got:
            return
        nodes, ends = np.unique(np.concatenate([np.concatenate(x) for x in zip(*got)]), return_inverse=True)
        half = len(ends) // 2
        label = forest(ends[:half], ends[half:], len(nodes))
        moved = np.flatnonzero(label != np.arange(len(nodes)))
        for at in range(0, len(moved), 1 << 16):
            part = moved[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[part]), pa.array(nodes[label[part]])], names=["u", "v"])

    return edges.mapInArrow(run, "u long, v long")


def components(edges: DataFrame, part: int = 1 << 20) -> DataFrame:
    """node, root: the smallest node (as a signed long) of each linked node's component.

    Edges are dealt to partitions of about ``part`` of them, whatever their nodes; each replaces its own by stars. If there are several
    partitions alternating star steps follow: both hang nodes under smaller neighbours until each component is a star. Intermediate
    stars are cut from their lineage.
    """
    edges = cut(edges.where("a <> b").select("a", "b"))
    parts = -(-edges.count() // part)
    stars = cut(contracted(edges.repartition(max(1, parts))))
    mark = None
    while parts > 1:
        now = stars.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == mark:
            break
        mark = now
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        wide = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        low = wide.groupBy("u").agg(F.min("v").alias("low"))
        ends = F.array(F.struct(F.col("u"), F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))
        stars = cut(wide.join(low, "u").select(F.explode(ends).alias("s")).select("s.*").where("u <> v").distinct())
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def grouped(docs: DataFrame, id_col: str, text_col: str, width: int, radius: int, part_size: int) -> DataFrame:
    """doc_id, text_hash, fp, component_id for each row of ``docs``."""

    def run(_, texts):
        return {"text_hash": text_hashes(texts), "fp": np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)}

    marked = cut(map_texts(docs, run, "text_hash long, fp long", id_col, text_col))
    points = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(points.select("fp"), radius, part_size))
    named = points.join(roots, points.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    names = named.join(named.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("fp", "component_id")
    return marked.join(names, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4, part_size: int = 1024) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest doc_id that links reach from the row's fingerprint).

    One row for each row of ``docs``. Null and empty texts, and texts of blanks, have fingerprint 0, which links like any other.
    Rows with a null id get a component, but give it no id unless all of its rows have none: then component_id is null.
    """
    found = grouped(docs, id_col, text_col, width, radius, part_size)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4, part_size: int = 1024) -> DataFrame:
    """``docs`` with one row of each component, see ``keep_one``."""
    return keep_one(docs, grouped(docs, id_col, text_col, width, radius, part_size), id_col, text_col)


def text_hashes(texts: list[bytes | None]) -> np.ndarray:
    """What the SQL function xxhash64 gives for each text."""
    return np.array([42 if t is None else xxhash.xxh64_intdigest(t, 42) for t in texts], np.uint64).view(np.int64)


def keep_one(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 1 << 20) -> DataFrame:
    """``docs`` with one row of each component of ``found`` (doc_id, text_hash, component_id for each row of ``docs``).

    The row of the smallest id stays; of rows with that id in the component the one of the smallest text hash, and of rows equal in
    both that whose JSON form is the smallest. Rows with a null id stay, for no id can stand for them. Texts are not shuffled while
    the rows that change are at most ``most``: then their ids and hashes are broadcast.
    """
    first = found.where("doc_id = component_id").groupBy("doc_id").agg(F.min("text_hash").alias("text_hash")).withColumn("stays", F.lit(True))
    rows = found.where("doc_id is not null").groupBy("doc_id", "text_hash").agg((F.count("*") > 1).alias("repeated"))
    touched = rows.join(first, ["doc_id", "text_hash"], "left").where("stays is null or repeated")
    touched = cut(touched.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.coalesce("stays", F.lit(False)).alias("_once")))
    n, once = touched.agg(F.count("*"), F.sum(F.col("_once").cast("long"))).first()
    row = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("_id"), F.xxhash64(F.col(text_col).cast("binary")).alias("_hash"))
    marked = row.join(F.broadcast(touched) if n <= most else touched, ["_id", "_hash"], "left")
    kept = marked.where("_once is null").select("row.*")
    if once:
        again = marked.where("_once").groupBy("_id", "_hash").agg(F.min_by("row", F.to_json("row")).alias("row"))
        kept = kept.unionByName(again.select("row.*"))
    return kept


def op3_simhash(spark, sf_dir) -> DataFrame:
    """Near-duplicate components of ``documents``: shingles of 4 words, links at 4 or fewer differing bits."""
    return near_duplicates(table(spark, sf_dir, "documents"))
