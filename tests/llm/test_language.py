import math
import zlib
from collections import Counter

import numpy as np
import pytest

from quarry.llm import language as g


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = g.op9_language(spark, folder)
    assert found.count() == docs.count()
    rows = found.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.98 and all(0 <= r.score <= 1 for r in rows)


def model(rows):
    return g._fit(sorted(rows), 5, 1.0)


def test_known_words_come_first_then_shorter_grams():
    m = model([("de", 0, "und", 50), ("en", 0, "and", 50), ("de", 1, "ich", 9), ("en", 1, "ing", 9), ("de", 1, "^", 5), ("en", 1, "^", 5), ("en", 1, "w", 5)])
    assert np.argmax(m.word("und")) == 0 and np.argmax(m.word("and")) == 1
    assert np.argmax(m.unseen("riching")) in (0, 1) and np.argmax(m.unseen("xich")) == 0 and np.argmax(m.unseen("xing")) == 1
    assert (m.unseen("qqq")[0], m.unseen("qqq")[1]) == (0.0, 0.0) or abs(m.unseen("qqq")).max() < 1


def test_longest_gram_is_taken():
    m = model([("a", 1, "bc", 10), ("b", 1, "b", 10), ("b", 1, "c", 10)])
    # At b the gram bc is taken, not b; at c only c is left.
    want = (m.scores[m.grams["bc"]] + m.scores[m.grams["c"]]) / 2
    assert np.allclose(m.unseen("bc"), want)


def test_cache_that_overflows_gives_the_same():
    m = model([("a", 0, f"w{i}", i % 7 + 1) for i in range(100)] + [("b", 0, f"w{i}", i % 5 + 1) for i in range(100)])
    words = [f"w{i % 130}" for i in range(1000)]
    assert np.allclose(g._Known(m, most=8).total(words), g._Known(m).total(words), atol=1e-3)


def test_messy(spark, messy, empty):
    learnt = g.learn(messy.unionByName(messy))
    rows = {r.doc_id: r for r in g.identify(messy, learnt).collect()}
    assert g.identify(messy, learnt).count() == messy.count() and g.identify(empty, learnt).count() == 0
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0.0 for i in (2, 3, 4))
    assert rows[5].lang_pred == "en"
    digits = spark.createDataFrame([(1, "12 ½ _ 34"), (2, "日本")], "doc_id long, text string")
    assert [r.lang_pred for r in g.identify(digits, learnt).orderBy("doc_id").collect()][0] == "und"
    nothing = g.learn(empty)
    assert {r.lang_pred for r in g.identify(messy, nothing).collect()} == {"und"}


def slow_query(rows):
    """Every text counts: the bounds of the sample and of the terms must not be reached."""
    words, grams = {}, {}
    for i, text, lang in rows:
        if text is None or lang is None or zlib.crc32(str(i).encode()) % 4 == 2:
            continue
        for w in g.words_of(text):
            words.setdefault(lang, Counter())[w] += 1
            marked = f"^{w}$"
            for size in range(1, 6):
                for start in range(len(marked) - size + 1):
                    grams.setdefault(lang, Counter())[marked[start : start + size]] += 1
    langs = sorted(set(words) | set(grams))

    def logs(tables):
        kept = {lang: {t: n for t, n in tables.get(lang, {}).items() if n > 1} for lang in langs}
        assert all(len(x) < 50_000 for x in kept.values())
        terms = {t for x in kept.values() for t in x}
        sums = {lang: sum(kept[lang].values()) + 0.5 * len(terms) for lang in langs}
        out = {}
        for t in terms:
            row = [math.log((kept[lang].get(t, 0) + 0.5) / sums[lang]) for lang in langs]
            out[t] = [x - sum(row) / len(row) for x in row]
        return out

    known, parts = logs(words), logs(grams)

    def word(w):
        if w in known:
            return known[w]
        marked, found = f"^{w}$", []
        for start in range(len(marked)):
            own = next((marked[start:end] for end in range(min(len(marked), start + 5), start, -1) if marked[start:end] in parts), None)
            if own:
                found.append(parts[own])
        return [sum(x) / len(found) for x in zip(*found)] if found else [0.0] * len(langs)

    out = {}
    for i, text, _ in rows:
        own = [word(w) for w in g.words_of(text)]
        total = [sum(x) for x in zip(*own)]
        out[i] = (langs[total.index(max(total))], 1 / sum(math.exp(x - max(total)) for x in total)) if own else ("und", 0.0)
    return out


def test_query_against_plain_python(spark, small):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = slow_query(rows)
    found = g.op9_language(spark, small).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.lang_pred == want[r.doc_id][0] and r.score == pytest.approx(want[r.doc_id][1], abs=1e-3)


def test_repeated_rows_do_not_shrink_the_sample(spark):
    """Of 401 distinct texts 100 teach, though one of them is there 40,000 times."""
    name = lambda i: "w" + "".join(chr(97 + int(d)) for d in str(i))
    rows = [(i, f"{name(i)} {name(i)}", "en") for i in range(400)] + [(1000, "again and again", "en")] * 40_000
    m = g.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4), max_texts=100, max_grams=100_000)
    assert 99 <= len(m.words) <= 101


def test_too_many_languages_are_an_error(spark):
    docs = spark.createDataFrame([(i, "text", f"l{i}") for i in range(9)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        g.learn(docs, max_languages=8)


def test_bound_on_texts(spark):
    docs = spark.createDataFrame([(i, f"word{i % 9} other", "en" if i % 2 else "de") for i in range(400)], "doc_id long, text string, lang string")
    m = g.learn(docs, max_texts=20, max_words=3, max_grams=4)
    assert m.languages == ["de", "en"] and len(m.words) <= 6 and len(m.grams) <= 8
