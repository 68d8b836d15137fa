"""Queries whose joins once made a row for each pair: the same results, and no step with more rows than inputs and results account for."""

import random
from itertools import groupby, product

import pytest

from quarry.operators import evidence, joins
from quarry.plans.registry import QUERIES


def most_rows(frame):
    """The rows of the frame, and the most that one step of its plan made."""
    rows = frame.collect()

    def steps(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            yield from steps(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            yield from steps(node.plan())
        else:
            found = node.metrics().get("numOutputRows")
            yield found.get().value() if found.isDefined() else 0
            for i in range(node.children().size()):
                yield from steps(node.children().apply(i))

    return rows, max(steps(frame._jdf.queryExecution().executedPlan()))


def test_seed_links_are_counted_not_made(spark):
    draw = random.Random(3)
    some = lambda *values: draw.choice(values)
    seeds = [(i, some(1, 1, 2), some(1, 2, None), some(None, 1, 2), some(0, 1, None)) for i in range(200)]
    occurrences = [(i, some(1, 1, 2), some(1, 2), some(None, 1, 2), some(7, 8, None), draw.randrange(5)) for i in range(1000)]
    pages = [(some(0, 1), some(7, 8), draw.randrange(5)) for _ in range(8)]
    s = spark.createDataFrame(seeds, "seed_id long, book int, chapter int, verse int, m int")
    o = spark.createDataFrame(occurrences, "occurrence_id long, book int, chapter int, verse int, volume int, page int")
    p = spark.createDataFrame(pages, "m int, volume int, page int")
    want = {(r.seed_id, r.score): r["count"] for r in joins.seed_links(s.drop("m"), o, s.select("seed_id", "m").join(p, "m"), "volume", "page").groupBy("seed_id", "score").count().collect()}
    rows, most = most_rows(joins.seed_link_counts(s, o, p, "m", "volume", "page"))
    assert {(r.seed_id, r.score): r.n for r in rows} == want and {score for _, score in want} == {0.82, 0.99}
    assert sum(want.values()) > 10_000 and most < 5_000


def test_survey_counts_pages_by_number(spark):
    draw = random.Random(4)
    entries = [(draw.choice([1, 2, None]), draw.choice([*range(300), None]), draw.choice([*range(10), None])) for _ in range(600)]
    pages = [(draw.choice([1, 2, None]), draw.choice([*range(2000), None]), draw.choice([*range(12), None])) for _ in range(1000)]
    hits = {}
    for (v, e, n), (w, p, m) in product(entries, pages):
        if None not in (v, e, n, m) and v == w and abs(m - n) <= 2:
            hits.setdefault((v, e), []).append((abs(m - n), -1 if p is None else p))
    key = lambda own: (sum(d == 0 for d, _ in own), sum(d > 0 for d, _ in own), (lambda p: None if p == -1 else p)(min(own)[1]) if own else None)
    want = sorted(str((v, e, *key(hits.get((v, e), [])))) for v, e, _ in entries)
    e, p = spark.createDataFrame(entries, "volume int, entry int, number int"), spark.createDataFrame(pages, "volume int, page int, printed int")
    rows, most = most_rows(evidence.survey(e, p, "volume", "entry", "number", "page", "printed"))
    assert sorted(str(tuple(r)) for r in rows) == want
    assert sum(map(len, hits.values())) > 40_000 and most < 2_000


def test_header_candidates_are_joined_once(spark, tmp_path):
    """Many headers around one number: the join makes the result's rows, not one for each header."""
    orders = [(o, 1, "P") for o in range(7)] + [(o, c, "O") for o in range(3) for c in range(5)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(500 * i + n,) for i in range(200) for n in range(20)], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    rows, most = most_rows(QUERIES["r07_header_candidates"](spark, str(tmp_path)))
    want = {(1, 500 * i + n, max(0, n - 6), 1 if n <= 6 else 2 if n == 7 else 3) for i in range(200) for n in range(10)}
    assert sorted(tuple(r) for r in rows) == sorted(want) and most <= 4_000


@pytest.mark.parametrize("least", [1, 4])
def test_density_clusters_without_pairs(spark, least):
    """Groups of near copies, chains and noise against all pairs; no step makes a row for each pair."""
    import numpy as np

    from quarry.operators import clustering

    r = np.random.default_rng(5)
    middles = r.normal(size=(6, 8)) * 2
    v = np.concatenate([middles[0] + r.normal(size=(300, 8)) * 0.02, *[m + r.normal(size=(30, 8)) * 0.3 for m in middles], r.normal(size=(40, 8)) * 2, np.arange(20)[:, None] * np.eye(8)[0] * 0.5 + 9])
    ids = r.permutation(len(v)) * 3
    near = ((v[:, None] - v) ** 2).sum(-1) <= 0.5 * 0.5
    core = near.sum(1) >= least
    name = np.where(core, ids, 10**6)
    while True:
        now = np.where(core, np.where(near & core, name, 10**6).min(1), name)
        if (now == name).all():
            break
        name = now
    first = [min((ids[j], name[j]) for j in np.flatnonzero(near[i] & core))[1] if (near[i] & core).any() else None for i in range(len(v))]
    want = {(int(i), None if c is None else int(c), bool(k)) for i, c, k in zip(ids, np.where(core, name, first), core)}
    frame = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v)] + [(7, None)], "id long, e array<double>")
    rows, most = most_rows(clustering.density_clusters(frame, "id", "e", 0.5, least, block=200))
    assert {tuple(x) for x in rows} == want | {(7, 7 if least == 1 else None, least == 1)}
    assert near.sum() > 80_000 and most < 10_000


def test_near_lines_against_a_table_of_edits():
    import numpy as np

    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            was, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                was, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, was + (x != y))
        return row[-1]

    draw = random.Random(6)
    base = ["".join(draw.choice("abcé ") for _ in range(n)) for n in (1, 5, 63, 64, 65, 128, 129, 200)]
    lines = [""]
    for text in base:
        for rate in (0, 0.1, 0.2, 0.25, 0.3, 0.5):
            lines.append("".join(draw.choice(["", "x", c + "b"]) if draw.random() < rate else c for c in text))
    asks = [(t, t, len(t)) for t in base]
    got = {(w, at): d for w, at, d in evidence.near_lines(asks, lines, np.array([len(x) for x in lines]), 0.25)}
    want = {(t, i): d for t in base for i, x in enumerate(lines) if (d := slow(t, x) / max(len(t), len(x))) <= 0.25}
    many = lines * 60  # enough texts for the bit vectors of 64 rows
    assert {(w, at % len(lines)): d for w, at, d in evidence.near_lines(asks, many, np.array([len(x) for x in many]), 0.25)} == pytest.approx(want)
    assert got == pytest.approx(want) and 20 < len(want) < len(base) * len(lines) / 4


def test_similar_pairs_make_no_rows_of_unlike_documents(spark, tmp_path, monkeypatch):
    """Documents that share many words and are not alike, copies, near copies, repeated and null ids: the SQL's rows, and no row for each candidate."""
    from quarry.operators import similarity
    from quarry.plans.registry import SQL

    from .oracle import assert_same, connect

    monkeypatch.setattr(similarity, "BLOCK", 50, raising=False)
    monkeypatch.setattr(similarity, "VOCABULARY", 200, raising=False)
    draw = random.Random(9)
    names = ["".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(900)]
    texts = [" ".join(draw.choice(names[i % 3 * 300 :][:300]) for _ in range(60)) for i in range(240)]
    texts[100:112] = [texts[7]] * 12
    texts[120:140] = [t.replace(" ", " x ", 30).rsplit(" ", 8)[0] + " other end" for t in texts[:20]]
    texts[150:153] = ["", None, "of a"]
    rows = [(i if i < 200 else 200 + i // 4, "s", t) for i, t in enumerate(texts)] + [(None, "s", texts[3]), (None, "s", texts[4])]
    spark.createDataFrame(rows, "doc_id long, source string, text string").coalesce(1).write.parquet(f"{tmp_path}/t")
    (path,) = (tmp_path / "t").glob("*.parquet")
    path.rename(tmp_path / "documents.parquet")
    frame = QUERIES["j09_similar_pairs"](spark, str(tmp_path))
    assert_same(frame, connect(str(tmp_path)).sql(SQL["j09_similar_pairs"]))
    found, most = most_rows(frame)
    assert len(found) > 80 and most < 2_000


def test_edit_pairs_in_blocks(spark, tmp_path):
    """Long, equal, empty and missing names, repeated and missing keys and groups: the SQL's rows from blocks of any size."""
    from quarry.operators import similarity
    from quarry.plans.registry import SQL

    from .oracle import assert_same, connect

    draw = random.Random(11)
    name = lambda top: "Customer#" + "".join(draw.choice("012 ") for _ in range(draw.randrange(top))) + "x"
    rows = [(draw.randrange(150), draw.choice([name(8), name(20), "Customer#1x", name(90)]), draw.choice([1, 1, 2]), "A") for _ in range(160)]
    rows += [(200 + i, None, 1, "A") for i in range(3)] + [(210, "", 1, "A"), (None, "n", 1, "A"), (211, "n", None, "A"), (212, "n", 3, None)]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").coalesce(1).write.parquet(f"{tmp_path}/t")
    (path,) = (tmp_path / "t").glob("*.parquet")
    path.rename(tmp_path / "customer.parquet")
    want = connect(str(tmp_path)).sql(SQL["x21_edit_distances"])
    found, most = most_rows(QUERIES["x21_edit_distances"](spark, str(tmp_path)))
    assert_same(QUERIES["x21_edit_distances"](spark, str(tmp_path)), want)
    assert most <= len(found) and len(found) > 5_000
    small = similarity.edit_pairs(spark.read.parquet(f"{tmp_path}/customer.parquet"), ["c_nationkey", "c_mktsegment"], "c_custkey", "c_name", block=30, batch=64)
    assert_same(small, want)


def test_header_candidates_follow_in_order(spark, tmp_path):
    """Each reference is followed by its pages in order, the same for all references of a number, so that a stored result is small."""
    draw = random.Random(12)
    orders = [(500 * i + draw.randrange(5, 7), draw.randrange(10**6), "P") for i in range(1200)]
    pages = [500 * draw.randrange(10**6) + n for n in range(20) for _ in range(60)]
    draw.shuffle(pages)
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(p,) for p in pages], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    rows = QUERIES["r07_header_candidates"](spark, str(tmp_path)).collect()
    runs = [[r.page for r in own] for _, own in groupby(rows, lambda r: (r.ref, r.page % 500))]
    assert len(rows) > 400_000 and len(runs) < 9_000 and all(own == sorted(own) for own in runs)


def test_edits_in_bands_of_words():
    """Long forms against texts of many lengths, with bounds of several sizes: as one integer a text finds them."""
    import numpy as np

    draw = random.Random(13)
    for n, most in ((70, 0.25), (300, 0.25), (300, 0.1), (500, 0.9)):
        form = [draw.randrange(4) for _ in range(n)]
        rate = [draw.random() * most * 1.2 for _ in range(300)]
        texts = [[c for x in form for c in draw.choice([[], [x, 1], [draw.randrange(5)]]) + []] if r > most else [c for x in form for c in (draw.choice([[], [x, 1], [4]]) if draw.random() < r else [x])] for r in rate]
        lengths = np.array([len(x) for x in texts])
        bound = np.floor(most * np.maximum(lengths, n)).astype(np.int64)
        got = evidence._edits(form, np.array(sum(texts, [])), 5, np.cumsum(lengths) - lengths, lengths, bound)
        want = [evidence._long_edits(form, x, k) for x, k in zip(texts, bound.tolist())]
        assert got.tolist() == want and sum(x >= 0 for x in want) > 20
