import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import decontaminate as d
from quarry.llm.base import item_words
from quarry.llm.fmindex import FmIndex, Ranks, suffix_order

from ..oracle import assert_same, connect

runs = st.lists(st.lists(st.integers(1, 5), min_size=1, max_size=30), min_size=1, max_size=8)


def joined(own):
    return np.array([x for run in own for x in [*run, 0]], np.int32)


@settings(max_examples=80, deadline=None)
@given(runs)
def test_suffix_order(own):
    text = joined(own)
    key = lambda i: [(1, int(x)) if x else (0, j) for j, x in list(enumerate(text))[i : i + list(text[i:]).index(0) + 1]]
    assert suffix_order(text).tolist() == sorted(range(len(text)), key=key)


@settings(max_examples=80, deadline=None)
@given(runs, st.lists(st.lists(st.integers(1, 6), min_size=1, max_size=4), min_size=1, max_size=5))
def test_search_and_locate(own, patterns):
    text = joined(own)
    index = FmIndex(text, sample=4)
    rows = np.zeros((len(patterns), 4), np.int32)
    for i, pattern in enumerate(patterns):
        rows[i, : len(pattern)] = pattern
    low, high = index.search(rows, np.array([len(x) for x in patterns]))
    for pattern, a, b in zip(patterns, low.tolist(), high.tolist()):
        want = [i for i in range(len(text)) if text[i : i + len(pattern)].tolist() == pattern]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=200))
def test_ranks(symbols):
    text = np.array(symbols)
    ranks = Ranks(text)
    at = np.arange(len(text))
    assert (ranks.access(at) == text).all()
    for symbol in set(symbols):
        assert ranks.rank(np.full(len(text) + 1, symbol), np.arange(len(text) + 1)).tolist() == [symbols[:i].count(symbol) for i in range(len(text) + 1)]


def brute(texts, items, width=10):
    """Hit words and items by comparing every window with every place."""
    out = []
    windows = []
    for item_id, text in items:
        words = item_words((text or "").encode())
        windows += [(item_id, words[i : i + width]) for i in range(max(1, len(words) - width + 1)) if words]
    for text in texts:
        words, hit, found = item_words((text or "").encode()), set(), set()
        for item_id, w in windows:
            for i in range(len(words) - len(w) + 1):
                if words[i : i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    found.add(item_id)
        out.append((len(words), len(hit), sorted(found)))
    return out


PASSAGE = " ".join(f"w{i}" for i in range(14))
TEXTS = [PASSAGE, f"x {PASSAGE} y {PASSAGE}", "w1 w2 w3", "short item here", "a Short, ITEM here b short item here", "w0 w1 w2 w3 w4 w5 w6 w7 w8", None, "", "é short item hereé"]
ITEMS = [(1, PASSAGE), (2, "Short item HERE"), (3, None), (4, ""), (10, PASSAGE), (5, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 and more")]


@pytest.mark.parametrize("block_bytes", [8 << 20, 60])
def test_against_brute_force(spark, block_bytes):
    """In one block of items, and in several."""
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = {r.doc_id: r for r in d.find_contamination(docs, items, block_bytes=block_bytes).collect()}
    for i, (n, hit, ids) in enumerate(brute(TEXTS, ITEMS)):
        spans = [(s.start, s.end) for s in found[i].spans]
        assert (found[i].n_words, sum(b - a for a, b in spans), found[i]["items"]) == (n, hit, ids)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_query_is_its_sql(spark, tables):
    assert_same(d.op7_decontaminate(spark, tables), connect(tables).sql(d.op7_sql()))


def test_items_are_listed_as_text(spark):
    docs, items = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([(10, "a"), (9, "b"), (None, "c")], "item_id long, text string")
    row = d.find_contamination(docs, items).first()
    assert row["items"] == [9, 10] and [(s.start, s.end) for s in row.spans] == [(0, 3)]
    assert hashlib.sha256(b"10,9").hexdigest() == hashlib.sha256(",".join(sorted(map(str, row["items"]))).encode()).hexdigest()


@pytest.mark.parametrize("block_bytes", [8 << 20, 20])
def test_messy(spark, messy, empty, block_bytes):
    items = spark.createDataFrame([(1, "brown fox jumps"), (2, "lazy dog"), (3, "gamma")], "item_id long, text string")
    rows = d.find_contamination(messy, items, block_bytes=block_bytes).collect()
    assert len(rows) == messy.count() and d.find_contamination(empty, items, block_bytes=block_bytes).count() == 0
    assert sum(r.doc_id == 7 and r["items"] == [1, 2] for r in rows) == 2
    assert all(r.spans == [] for r in d.find_contamination(messy, items.limit(0)).collect())
    kept = d.drop_contaminated(messy, items)
    assert kept.columns == messy.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 4, 6]
