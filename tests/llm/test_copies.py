import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import copies as c

from .test_simhash import slow_fingerprint


def slow_set(text):
    words = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).replace(b"\x0b", b" ").split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def slow_copies(rows, threshold=0.8):
    """rows: (id, text); the smallest id that links reach, by looking at all pairs."""
    sets = [slow_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or len(a & sets[j]) >= threshold * len(a | sets[j]) - 1e-9:
                parent[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), k), k)
    return {k: low[find(i)] for i, (k, _) in enumerate(rows)}


def edited():
    """Copies with ever more words replaced, in one large group and in small ones, some with a common line."""
    draw = random.Random(7)
    word = lambda: draw.choice("abcdefgh") + str(draw.randrange(400))
    line = [word() for _ in range(12)]
    out = []
    for g in range(25):
        base = [word() for _ in range(draw.choice((6, 30, 150, 400)))] + (line if g % 3 == 0 else [])
        for _ in range(40 if g == 0 else 5):
            text = list(base)
            for _ in range(draw.randrange(0, 2 + len(base) // 30)):
                text[draw.randrange(len(text))] = word()
            out.append(" ".join(text))
    draw.shuffle(out)
    return list(enumerate(out))


def test_components_of_all_pairs(spark):
    rows = edited()
    want = slow_copies(rows)
    got = {r.doc_id: r.component_id for r in c.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and 30 < len(set(want.values())) < len(rows)


def test_stage_finds_copies_that_differ_in_more_than_four_bits(spark, tables):
    words = [f"w{i * i % 211}x{i + 1000}" for i in range(120)]
    other = [w if i not in (30, 75) else "changed" for i, w in enumerate(words)]
    rows = [(1, " ".join(words), "en", "s", 1), (2, " ".join(other), "en", "s", 1), (3, " ".join(words[::-1]), "en", "s", 1)]
    assert (slow_fingerprint(rows[0][1]) ^ slow_fingerprint(rows[1][1])).bit_count() > 4
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, tables).collect()) == [1, 3]


def test_given_table(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id: r.component_id for r in c.near_copies(docs).collect()} == slow_copies(rows)


def test_bands_and_fingerprints():
    draw = np.random.default_rng(4)
    both = draw.integers(0, 1 << 63, 900).astype(np.uint64)
    a, b = (np.unique(np.r_[both[:800], x]) for x in (both[800:], draw.integers(0, 1 << 63, 100).astype(np.uint64)))
    assert set(c.band_keys(a)) & set(c.band_keys(b)) and len(c.band_keys(a)) == c.BANDS and c.band_keys(a[:0]) == []
    x, y = (np.frombuffer(c.wide_fingerprint(v), np.uint64) for v in (a, b))
    assert 10 < np.bitwise_count(x ^ y).sum() < 64
    bits = [sum(int(h) >> k & 1 for h in a) * 2 > len(a) for k in range(64)]
    assert [bool(int(x[0]) >> k & 1) for k in range(64)] == bits


def test_parts_of_shards_give_the_same(spark):
    rows = edited()
    got = c.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), part_size=6)
    assert {r.doc_id: r.component_id for r in got.collect()} == slow_copies(rows)


def test_the_row_that_stays(spark):
    """Not any row of the smallest id, but that of the component; whatever the order of the rows."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(3, long, "x"), (5, long, "x"), (5, "another text altogether", "x"), (5, "another text altogether", "x"), (5, "another text altogether", "y")]
    for order in (rows, rows[::-1]):
        kept = c.drop_near_copies(spark.createDataFrame(order, "doc_id long, text string, source string")).collect()
        assert sorted(map(tuple, kept)) == [(3, long, "x"), (5, "another text altogether", "x")]


def test_signatures_rule_out_no_similar_pair():
    draw = np.random.default_rng(3)
    for n, m in ((1, 1), (60, 70), (100, 140), (3000, 4100)):
        both = draw.integers(0, 1 << 63, n).astype(np.uint64)
        other = np.r_[both, draw.integers(0, 1 << 63, m - n).astype(np.uint64)]
        a, b = (c.signature(np.unique(x)).tobytes() for x in (both, other))
        assert c.least_apart(a, a) == 0 and c.least_apart(a, b) == c.least_apart(b, a) <= m - n
        x, y = (np.frombuffer(c.short_signature(np.unique(v)), np.uint64) for v in (both, other))
        assert np.bitwise_count(x ^ y).sum() <= m - n
    assert c.least_apart(c.signature(both).tobytes(), c.signature(other + np.uint64(1)).tobytes()) > (n + m) / 9


def test_messy(messy, empty):
    found = {r.doc_id: r.component_id for r in c.near_copies(messy).collect()}
    assert found[2] == found[3] == found[4] == 2 and found[7] == found[1] == 1 and found[None] is None
    assert c.near_copies(empty).count() == 0
    kept = c.drop_near_copies(messy)
    assert kept.columns == messy.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 5, 6]


def test_rows_without_an_id_link_others(spark):
    words = [f"w{i}" for i in range(200)]
    change = lambda *at: " ".join("x" if i in at else w for i, w in enumerate(words))
    docs = spark.createDataFrame([(1, change(20, 60, 80)), (None, change()), (2, change(100, 120, 140))], "doc_id long, text string")
    assert len(slow_set(change(20, 60, 80)) & slow_set(change(100, 120, 140))) < 0.8 * len(slow_set(change(20, 60, 80)) | slow_set(change(100, 120, 140)))
    assert {r.doc_id: r.component_id for r in c.near_copies(docs).where(F.col("doc_id").isNotNull()).collect()} == {1: 1, 2: 1}
