import math
import re
import zlib
from itertools import combinations

import numpy as np
import pytest

from quarry.llm import toxicity as t


def test_pairs_are_learnt():
    """Label 1 only where both terms stand: no sum of two weights tells it from either alone as well as the pair does."""
    draw = np.random.default_rng(1)
    rows, labels = [], []
    for _ in range(3000):
        a, b = draw.random(2) < 0.5
        rows.append(np.array(sorted(({10} if a else set()) | ({20} if b else set()) | set(draw.integers(100, 130, 5).tolist()))))
        labels.append(float(a and b))
    machine = t.fit(rows, np.array(labels), min_z=3.0)
    places = {int(b): i for i, b in enumerate(machine.buckets)}
    p = machine.probabilities([np.array(sorted(places[x] for x in own), int) for own in ([10], [20], [10, 20], [])])
    assert p[2] > 0.9 and max(p[0], p[1], p[3]) < 0.1
    assert machine.factors[places[10]] @ machine.factors[places[20]] > 1


def test_one_label_only():
    machine = t.fit([np.array([1])] * 5, np.zeros(5))
    assert len(machine.buckets) == 0 and machine.probabilities([np.empty(0, int)])[0] < 0.2


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    scores = t.op2_toxicity(spark, folder)
    assert scores.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    joined = scores.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    caught = [r.predicted for r in joined if r.toxic]
    wrong = [r.predicted for r in joined if not r.toxic]
    assert np.mean(caught) >= 0.85 and np.mean(wrong) <= 0.01
    assert all(0 <= r.score <= 1 for r in joined)


def slow_machine(texts, labels):
    """Rows of hashed terms in plain Python, then the fit; every labelled text counts."""
    own = {i: {w for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[i] or ""))} for i in labels}
    forms = {}
    for i, y in labels.items():
        for w in own[i] if y else ():
            for stem in t.stem_buckets(w.encode(), 24):
                forms.setdefault(stem, set()).add(zlib.crc32(w.encode()) & 7)
    rows = []
    for i in labels:
        terms = {t.word_bucket(w.encode(), 24) for w in own[i]} | {s for w in own[i] for s in t.stem_buckets(w.encode(), 24) if len(forms.get(s, ())) >= 3}
        rows.append(np.array(sorted(terms), np.int64))
    return t.fit(rows, np.array(list(labels.values()), float))


def slow_score(text, m):
    words = {w for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))}
    terms = {b for w in words for b in (t.word_bucket(w.encode(), 24), *t.stem_buckets(w.encode(), 24))}
    at = [i for i, b in enumerate(m.buckets.tolist()) if b in terms]
    y = m.bias + sum(m.weights[i] for i in at) + sum(float(m.factors[i] @ m.factors[j]) for i, j in combinations(at, 2))
    return 1 / (1 + math.exp(-y))


def test_query_against_plain_python(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    marks = {r.doc_id: int(r.toxic > 0) for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    teach = [i for i in marks if zlib.crc32(str(i).encode()) % 3 != 1 and i in texts]
    order = spark.createDataFrame([(i,) for i in teach], "doc_id long").selectExpr("doc_id", "xxhash64(doc_id) h").orderBy("h", "doc_id").collect()
    m = slow_machine(texts, {r.doc_id: marks[r.doc_id] for r in order})
    assert len(m.buckets) > 10
    rows = t.op2_toxicity(spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.score == pytest.approx(slow_score(texts[r.doc_id], m), abs=1e-6) and r.predicted == (r.score >= 0.7)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_messy(spark, messy, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (None, 1), (5, None), (99, 1)], "doc_id long, toxic int")
    machine = t.learn(messy, labels)
    rows = t.score_texts(messy, machine).collect()
    assert len(rows) == messy.count() and all(0 <= r.score <= 1 for r in rows)
    kept = t.drop_toxic(messy, machine, threshold=2.0)
    assert kept.columns == messy.columns and kept.count() == messy.count() and t.drop_toxic(messy, machine, threshold=0.0).count() == 0
    assert t.score_texts(empty, t.learn(empty, labels)).count() == 0
    assert t.learn(messy, labels.limit(0)).bias < 0.1


def test_bound_on_texts(spark, messy):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 8)], "doc_id long, toxic int")
    assert t.learn(messy, labels, max_texts=2, max_terms=10) is not None


def test_no_row_for_each_active_term(spark, monkeypatch):
    """Texts that share many active words: the machine is that of plain Python, and no inner join by term makes a row for each of them."""
    words = [f"w{c}{d}" for c in "abcdefgh" for d in "abcdefgh"]
    texts = {i: " ".join([*words, "insulting insulted insults"] if i % 3 == 0 else ["plain", f"own{i}", "insulter"]) for i in range(60)}
    marks = {i: int(i % 3 == 0) for i in texts}
    joins, kind = [], type(spark.range(1))
    join = kind.join
    monkeypatch.setattr(kind, "join", lambda self, other, on=None, how=None: joins.append((on, how or "inner")) or join(self, other, on, how))
    made = t.learn(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), spark.createDataFrame(list(marks.items()), "doc_id long, toxic int"))
    order = spark.createDataFrame([(i,) for i in texts], "doc_id long").selectExpr("doc_id", "xxhash64(doc_id) h").orderBy("h", "doc_id").collect()
    want = slow_machine(texts, {r.doc_id: marks[r.doc_id] for r in order})
    assert len(want.buckets) > 60 and made.buckets.tolist() == want.buckets.tolist()
    assert made.weights == pytest.approx(want.weights) and made.factors == pytest.approx(want.factors)
    assert joins and ("term", "inner") not in joins
