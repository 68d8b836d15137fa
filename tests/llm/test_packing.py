import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import packing as p

VOCABULARY, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
PLAIN = Tokenizer.from_file(VOCABULARY)


@pytest.mark.parametrize("text", ["", "hello world", " " * 20_000 + "a", "a" * 20_000, "<|endoftext|> x", "x <|endoftext|> y<|endoftext|><|endoftext", "<|endoftext|>", "Ünï 日本語 🙂\n\n\t x", "\r\n" * 500, "don't we'll 12345 67"])
def test_both_libraries_give_the_same_ids(text):
    want = PLAIN.encode(text, add_special_tokens=False).ids
    assert p.token_ids(text, VOCABULARY, RANKS).tolist() == want == p.token_ids(text, VOCABULARY, None).tolist()


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=200))
def test_same_ids_of_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert p.token_ids(text, VOCABULARY, RANKS).tolist() == PLAIN.encode(text, add_special_tokens=False).ids


def best_level(count, item, size):
    """By trying each level: the sum of squares afterwards; of equal ones the fullest."""
    tried = []
    for h in range(size - item + 1):
        if h == 0 or count[h] > 0:
            after = count.copy()
            if h:
                after[h] -= 1
            if h + item < size:
                after[h + item] += 1
            tried.append(((after**2).sum(), -h))
    return -min(tried)[1]


def test_sum_of_squares_rule():
    draw, packer = np.random.default_rng(4), p.Packer(32)
    for item in draw.integers(1, 33, 600).tolist():
        want = best_level(packer.count.copy(), item, 32)
        assert packer.put(item)[1] == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 200), max_size=60))
def test_shards_keep_every_token(lengths):
    pieces = p.pack_shard(lengths, 32)
    windows = defaultdict(list)
    for length, own in zip(lengths, pieces):
        at = 0
        for start, n, window, offset in own:
            assert start == at and n > 0
            at += n
            windows[window].append((offset, n))
        assert at == length
    for own in windows.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 32
    assert sum(sum(n for _, n in own) < 32 for own in windows.values()) <= 1


def test_query(spark, tables):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    by_doc, windows = defaultdict(list), defaultdict(list)
    for r in p.op6_packing(spark, tables).collect():
        by_doc[r.doc_id].append(r)
        windows[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc_id, rows in by_doc.items():
        ids = [*PLAIN.encode(texts[doc_id], add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in windows.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 1024
    fill = [sum(n for _, n in own) for own in windows.values()]
    assert sum(1024 - f for f in fill) <= 0.02 * 1024 * len(fill)


def test_small_shards(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = p.pack(docs, shard_tokens=3000).collect()
    fill = defaultdict(int)
    for r in rows:
        fill[r.sequence_id] += r.length
        assert len(r.ids) == r.length
    assert max(fill.values()) <= 1024


def test_messy(messy, empty):
    rows = p.pack(messy).collect()
    assert p.pack(empty).count() == 0
    assert [r.ids for r in rows if r.doc_id == 2] == [[0]] and sum(r.doc_id == 7 for r in rows) >= 2
    assert {r.doc_id for r in rows} == {1, 2, 3, 4, 5, 6, 7, None}
