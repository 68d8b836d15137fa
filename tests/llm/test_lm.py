import math
import zlib
from collections import Counter

import numpy as np
import pytest

from quarry.llm import lm


def train_of(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 != 1


def brute(rows):
    """Counts, weights by expectation-maximisation over single deleted events, and scores, in plain Python."""
    tokens = [(i, [*(t or "").encode().lower().split(), b" "]) for i, t in rows]
    words, pairs, docs = Counter(), Counter(), 0
    for i, own in tokens:
        if train_of(i):
            docs += 1
            words.update(own)
            pairs.update(zip([None, *own], own))
    n, v = sum(words.values()), len(words)
    context = lambda h: docs if h is None else words[h]
    bucket = lambda c: int(math.log2(max(c, 1)))
    events = {}
    for (h, w), k in pairs.items():
        c = context(h)
        events.setdefault(bucket(c), []).append((((k - 1) / max(c - 1, 1), (words[w] - 1) / max(n - 1, 1), 1 / (v + 1)), k))
    weights, last = {}, (0.0, 0.9, 0.1)
    for b in range(64):
        if b in events:
            last = (1 / 3,) * 3
            for _ in range(60):
                sums, total = [0.0] * 3, 0
                for parts, k in events[b]:
                    each = [x * y for x, y in zip(last, parts)]
                    total += k
                    sums = [s + k * e / sum(each) for s, e in zip(sums, each)]
                last = [s / total for s in sums]
            last[2] = max(last[2], lm.LEAST)
            last = [x / sum(last) for x in last]
        weights[b] = last
    out = []
    for i, own in tokens:
        base = sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        score = 0.0
        for h, w in zip([None, *own], own):
            a, b, c = weights[bucket(context(h))]
            score += math.log10(a * pairs[h, w] / max(context(h), 1) + b * words[w] / max(n, 1) + c / (v + 1))
        out.append((i, len(own), sum(words[w] > 0 for w in own), n, base, score))
    return out


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 20_000, "run_bytes": 70_000, "range_tokens": 9_000}])
def test_query_against_brute_force(spark, tables, sizes):
    """In one block for each task and in many, in several runs and ranges."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    found = {r.doc_id: r for r in lm.score_documents(docs, lm.crc_of_id("doc_id") % 5 != 1, **sizes).collect()}
    assert len(found) == len(rows)
    for i, n, known, train, base, score in brute([tuple(r) for r in rows]):
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, train, not train_of(i))
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(score, rel=0.01)  # ratios of held-out events are counted in steps of 1/16 octave


def test_a_mixture_beats_its_parts(spark, tables):
    rows = lm.op10_lm_score(spark, tables).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert rows["sum(score)"] > rows["sum(base_score)"]


def test_packed_arrays():
    draw = np.random.default_rng(3)
    values = np.sort(draw.integers(0, 1 << 63, 1000).astype(np.uint64))
    assert (lm.unplanes(lm.planes(values)) == values).all() and (lm.unplanes(lm.planes(values, True), True) == values).all()
    assert len(lm.unplanes(lm.planes(values[:0]))) == 0
    assert lm._cuts(values, 7)[0] == 0 and lm._cuts(values, 7)[-1] == 1000
    assert lm.bucket(np.array([0, 1, 2, 3, 4, 1 << 40])).tolist() == [0, 0, 1, 1, 2, 40]


def test_messy(messy, empty):
    from pyspark.sql import functions as F

    rows = lm.score_documents(messy, lm.crc_of_id("doc_id") % 5 != 1).collect()
    assert len(rows) == messy.count() and lm.score_documents(empty, F.lit(True)).count() == 0
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].n_tokens == by_id[3].n_tokens == 1 and by_id[5].n_tokens == 160_001 and by_id[None].held_out
    untaught = lm.score_documents(messy, F.lit(False)).collect()
    assert all(r.base_score == 0.0 and r.score == 0.0 and r.train_tokens == 0 for r in untaught)


def test_a_run_meets_its_totals_block_by_block(spark):
    """What is held beside the run is few arrays of its keys, not the pairs of all blocks and copies of them (235 MB for 32 MB of text before)."""
    import tracemalloc

    draw = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{n}" for n in draw.integers(0, 3000, 2000))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = lm.blocks(docs, lm.F.lit(True), "doc_id", "text", 1 << 19, 1 << 25)
    left, right = found.toArrow(), lm.totals(found, 2).toArrow()
    assert left.num_rows > 4 and len(set(left.column("run").to_pylist())) == 1
    tracemalloc.start()
    made = lm.join(left, right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    blocks = [lm.Block.read(row) for row in left.to_pylist()]
    pairs = Counter(np.concatenate([b.pair_keys[b.pair_of] for b in blocks]).tolist())
    assert peak < 6 * 8 * len(pairs)
    for b, row in zip(sorted(left.to_pylist(), key=lambda r: r["block"]), made.to_pylist()):
        own = lm.Block.read(b)
        assert row["block"] == b["block"] and lm.unplanes(row["pair_totals"]).tolist() == [pairs[k] for k in own.pair_keys[own.pair_of].tolist()]
