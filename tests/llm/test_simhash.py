import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import simhash as s


def slow_fingerprint(text):
    words = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).replace(b"\x0b", b" ").split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64(x, seed=42).intdigest() for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(rows, radius=4):
    """rows: (id, fingerprint); the smallest id that links reach, by looking at all pairs."""
    points = sorted({f for _, f in rows})
    parent = {f: f for f in points}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(points):
        for b in points[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    low = {}
    for i, f in rows:
        if i is not None:
            low[find(f)] = min(low.get(find(f), i), i)
    return [low.get(find(f)) for _, f in rows]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=300))
def test_fingerprint(text):
    assert s.fingerprint(text.encode("utf-8", "ignore")) == slow_fingerprint(text.encode("utf-8", "ignore").decode())


def test_spark_hash_is_the_same(spark):
    from pyspark.sql import functions as F

    got = spark.createDataFrame([("one two three four",)], "t string").select(F.xxhash64("t")).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"one two three four", 42)


@pytest.mark.parametrize("blocks", [5, 6, 7, 8])
def test_every_near_pair_shares_a_choice(blocks):
    draw = np.random.default_rng(blocks)
    masks = s.block_masks(blocks, 4)
    for _ in range(300):
        a = int(draw.integers(0, 1 << 63))
        b = a
        for bit in draw.choice(64, 4, replace=False):
            b ^= 1 << int(bit)
        assert any(a & m == b & m for m in masks)


def clusters(seed, centres=30, each=20):
    draw = np.random.default_rng(seed)
    out = []
    for c in draw.integers(0, 1 << 63, centres):
        for _ in range(each):
            f = int(c)
            for bit in draw.choice(64, int(draw.integers(0, 7)), replace=False):
                f ^= 1 << int(bit)
            out.append(f)
    return out


@pytest.mark.parametrize("part_size, edges", [(4, 1 << 20), (50, 40), (1024, 150)])
def test_links_give_the_components_of_all_pairs(spark, part_size, edges):
    """Also where shards are cut into parts of a few points, and links into parts of a few."""
    points = sorted(set(clusters(3)))
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in points], "fp long")
    roots = {r.node % (1 << 64): r.root for r in s.components(s.links(frame, 4, part_size), edges).collect()}
    want = slow_components([(i, p) for i, p in enumerate(points)])
    groups, expected = {}, {}
    for p, w in zip(points, want):
        groups.setdefault(roots.get(p, p - (1 << 64) if p >> 63 else p), set()).add(p)
        expected.setdefault(w, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_tree_search():
    points = np.array(sorted(set(clusters(5))), np.uint64)
    key, child, roots = s.grow(points, np.zeros(len(points), int))
    assert len(child) == len(points) - 1 and len(roots) == 1
    q, p = s.search(points, (key, child), points, np.zeros(len(points), int), 4)
    want = {(i, j) for i in range(len(points)) for j in range(len(points)) if (int(points[i]) ^ int(points[j])).bit_count() <= 4}
    assert set(zip(q.tolist(), p.tolist())) == want


def test_query_against_all_pairs(spark, tables):
    rows = s.op3_simhash(spark, tables).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    assert all(int(r.fingerprint, 16) == slow_fingerprint(texts[r.doc_id]) and len(r.fingerprint) == 16 for r in rows)
    assert [r.component_id for r in rows] == slow_components([(r.doc_id, int(r.fingerprint, 16)) for r in rows])


def test_messy(messy, empty):
    rows = s.near_duplicates(messy).collect()
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in rows}
    assert len(rows) == messy.count() and s.near_duplicates(empty).count() == 0
    assert found[2] == found[3] == found[4] == ("0" * 16, 2) and found[7] == found[1] and found[1][1] == 1
    assert found[None][1] is None
    kept = s.drop_near_duplicates(messy)
    assert kept.columns == messy.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 5, 6]
