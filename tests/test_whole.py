"""Queries without SQL against plain versions over the whole tables."""

from collections import defaultdict
from itertools import combinations

import pytest

import quarry.plans  # noqa: F401
from quarry.plans import similarity
from quarry.plans.registry import QUERIES, Tables

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def slow_shingles(text, width=4):
    import re

    w = re.findall("[a-z]{3,}", text.lower())
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def copies():
    """Half of the rows are copies with a word of their own, so their common shingles are in far more than a fiftieth of the rows."""
    common = "some line that all the copies have in common and that goes on for many words"
    sides = [(i, f"{common} word{'abcdefghij'[i]}x" if i % 2 else f"other{'abcdefghij'[i]}x text", "en", f"v{i % 4 // 2}", 1) for i in range(10)]
    return sides + [(i, f"nothing here is like a page of{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}", "en", "v2", 1) for i in range(10, 40)]


@pytest.fixture
def folder(spark, tmp_path):
    spark.createDataFrame(copies(), COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_page_matches(spark, folder):
    pages = defaultdict(dict)
    for i, text, _, source, _ in copies():
        pages[source][i] = slow_shingles(text)
    want = set()
    for a, b in combinations(sorted(pages), 2):
        scored = sorted((-len(x & y) / len(x | y), i, j) for i, x in pages[a].items() for j, y in pages[b].items() if x & y)
        left, right = set(), set()
        for score, i, j in scored:
            if i not in left and j not in right and len(left) < 5:
                left.add(i)
                right.add(j)
                want.add((a, b, i, j, round(-score, 6)))
    assert {tuple(r) for r in QUERIES["j10_page_matches"](spark, folder).select("left_volume", "right_volume", "left_page", "right_page", "jaccard").collect()} == want
    assert any(x[:2] == ("v0", "v1") for x in want)


def test_volume_pairs(spark, tables):
    own = defaultdict(set)
    for r in spark.read.parquet(f"{tables}/documents.parquet").collect():
        own[r.source] |= slow_shingles(r.text)
    want = {(a, b): len(own[a] & own[b]) / min(len(own[a]), len(own[b])) for a, b in combinations(sorted(own), 2) if own[a] & own[b]}
    got = {(r.a, r.b): r.score for r in similarity.volume_pairs(Tables(spark, tables)).collect()}
    assert got == pytest.approx(want)


def unit(v):
    import numpy as np

    v = np.asarray(v, float)
    return v / (np.sqrt(v @ v) or 1)


@pytest.mark.parametrize("name, paged", [("t01_cosine_top", False), ("t02_page_neighbours", True)])
def test_every_hundredth_vector_asks_all(spark, tables, name, paged):
    rows = [(r.vec_id, unit(r.embedding), r.label) for r in spark.read.parquet(f"{tables}/embeddings.parquet").collect()]
    want = {}
    for i, v, g in rows:
        if i % 100 == 0:
            scored = [(-round(float(v @ w), 5), -j if paged else j) for j, w, h in rows if not paged or abs(i - j) > 5 and g != h]
            want[i] = [(abs(j), -s) for s, j in sorted(scored)[:10]]
    got = defaultdict(list)
    for r in QUERIES[name](spark, tables).orderBy("id", "rank").collect():
        got[r.id].append((r.neighbour, r.score))
    assert len(want) > 1 and got.keys() == want.keys()
    for i, found in got.items():
        assert [s for _, s in found] == pytest.approx([s for _, s in want[i]], abs=2e-5) and len({j for j, _ in found} & {j for j, _ in want[i]}) >= 9


def test_every_item_against_all_documents(spark, tables):
    import re

    read = lambda n: spark.read.parquet(f"{tables}/{n}.parquet").collect()
    vector = {r.vec_id: unit(r.embedding) for r in read("embeddings")}
    words = {r.doc_id: set(re.findall("[a-z]+", r.text.lower())) for r in read("documents")}
    got = defaultdict(list)
    for r in QUERIES["r13_hybrid_score"](spark, tables).collect():
        got[r.item_id].append(r.score)
    items = {r.item_id: set(re.findall("[a-z]+", r.text.lower())) for r in read("benchmark")}
    items = {i: q for i, q in items.items() if q}
    assert got.keys() == items.keys()
    for i, q in items.items():
        want = sorted((0.6 * len(q & w) / len(q) + 0.4 * (float(vector[i] @ vector[d]) if i in vector and d in vector else 0) for d, w in words.items()), reverse=True)[:5]
        assert sorted(got[i], reverse=True) == pytest.approx(want, abs=2e-5)


def test_evidence_far_from_the_items_number(spark):
    from quarry.operators import evidence

    items = spark.createDataFrame([(1, "The wanted line of text"), (2, "Quite another thing")], "item_id long, wanted string")
    rows = [(90_000, "first\nthe wantd line of texts"), (5, "nothing"), (7, "QUITE another thing")]
    found = evidence.located_anywhere(items, spark.createDataFrame(rows, "doc_id long, text string"), "item_id", "wanted", "doc_id", "text")
    assert {(r.item_id, r.doc_id): round(r.distance, 6) for r in found.collect()} == {(1, 90_000): round(2 / 23, 6), (2, 7): 0.0}


def test_equal_names_are_measured_once(spark, tmp_path):
    """Sixty customers to a name: all their pairs in the result, but the distances stand below the pairing of customers."""
    rows = [(i, ["Customer#1", "Customer#22", None, "Client#1"][i % 4], 1, "A") for i in range(240)]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    found = QUERIES["x21_edit_distances"](spark, str(tmp_path))
    got = found.collect()
    assert {(r.a, r.b) for r in got} == set(combinations(range(240), 2)) and len(got) == 240 * 239 // 2
    assert {r.distance for r in got if r.a % 4 == 0 and r.b % 4 == 1} == {2} and {r.distance for r in got if r.a % 4 == r.b % 4 == 3} == {0}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "levenshtein" in plan and plan.rindex("Generate explode(y_keys") < plan.index("levenshtein")


def test_near_pairs_shuffle_prefixes_alone(spark):
    """Copies are compared once and all their pairs are there; a line that all have is last in the order, so it makes no candidates."""
    from quarry.operators import similarity as ops

    shared = list(range(1000, 1010))
    sets = {i: shared + [10_000 * (i // 3) + k for k in range(40)] + ([-i - 1] if i % 3 == 2 else []) for i in range(60)}
    frame = spark.createDataFrame(list(sets.items()), "doc long, terms array<long>")
    want = {(a, b): len(set(x) & set(y)) / len(set(x) | set(y)) for (a, x), (b, y) in combinations(sets.items(), 2)}
    got = {(r.a, r.b): r.jaccard for r in ops.jaccard_pairs(frame, 0.85, 20).collect()}
    assert got == {k: v for k, v in want.items() if v >= 0.85}
    classes, near = ops.near_sets(frame, 0.85, 20)
    assert classes.where("doc = first").count() == 40 and near.count() == 20
    heads = ops._heads(frame, 0.85, 20).collect()
    assert all(len(r.prefix) < 10 and not set(r.prefix) & set(shared) for r in heads)


def test_page_matches_below_the_levels(spark):
    """Pairs of volumes with too few similar pages go down to pages with one common term."""
    from quarry.operators import similarity as ops

    pages = {i: ("v" + str(i % 3), [i // 3 * 100 + k for k in range(10)] + [7_000_000 + i % 2]) if i < 30 else ("w", [100 * i + k for k in range(9)] + [i % 3]) for i in range(36)}
    frame = spark.createDataFrame([(v, i, i, x) for i, (v, x) in pages.items()], "volume string, page long, doc long, terms array<long>")
    got = {tuple(r) for r in ops.greedy_matches(frame, ["left_volume", "right_volume"]).select("left_volume", "right_volume", "left_page", "right_page").collect()}
    want = set()
    for a, b in combinations(sorted({v for v, _ in pages.values()}), 2):
        scored = sorted((-len(set(x) & set(y)) / len(set(x) | set(y)), i, j) for i, (v, x) in pages.items() for j, (w, y) in pages.items() if (v, w) == (a, b) and set(x) & set(y))
        left, right = set(), set()
        for _, i, j in scored:
            if i not in left and j not in right and len(left) < 5:
                left.add(i)
                right.add(j)
                want.add((a, b, i, j))
    assert got == want and any(r[1] == "w" for r in want) and any(r[0] == "v0" for r in want)
