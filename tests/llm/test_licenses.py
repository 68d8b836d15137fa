import pytest

from quarry.llm import licenses as l
from quarry.llm.base import item_words


def brute(text):
    words = item_words((text or "").encode())
    found = []
    for phrase, label in l.PHRASES.items():
        own = [w.encode() for w in phrase.split()]
        found += [(i, i + len(own), label) for i in range(len(words)) if words[i : i + len(own)] == own]
    return len(words), sorted(found)


CASES = ["", "under the MIT license", "Under, the\nmit-LICENSE under the mit license", "apache license version 20", "Apache License, Version 2.0", "cc by-nc cc by nc cc cc by nc", "é mit license under the mit licenses", "1 2 under the mit license"]


@pytest.mark.parametrize("text", CASES)
def test_base(text):
    n, base, _ = l.Scanner().scan(text.encode())
    assert (n, base) == brute(text)


def filled(label, **replaced):
    text = l.TEMPLATES[label].replace("<<oneOf;this software and associated documentation files|this software>>", "this Software").replace("<<var;max=20>>", "THE AUTHORS").replace("<<var;max=40>>", "2024 A. B.")
    for old, new in replaced.items():
        text = text.replace(old, new)
    return l.MARKUP.sub(" ", text)


def labels(text):
    return {label for _, _, label in l.Scanner().scan(text.encode())[2]}


@pytest.mark.parametrize("label", ["mit", "isc", "bsd", "unlicense"])
def test_mandatory_wording_must_match(label):
    assert label in labels("Preface. " + filled(label) + " Afterwards.")
    assert label not in labels(filled(label, software="softwares", SOFTWARE="SOFTWARES"))


def test_optional_and_replaceable_regions():
    whole = filled("mit")
    assert "mit" in labels(whole.replace("(including the next paragraph)", ""))
    assert "mit" in labels(whole.replace("THE AUTHORS", "ANY OF THE MANY COPYRIGHT HOLDERS"))
    assert "mit" not in labels(whole.replace("THE AUTHORS", "X " * 21))
    assert "bsd" in labels(filled("bsd").replace("Neither the name of THE AUTHORS nor the names of its contributors may be used to endorse or promote products derived", "").replace("from this software without specific prior written permission.", ""))


@pytest.mark.parametrize(
    "text, label", [("Licensed under the Apache License, Version 2.0.", "apache-2"), ("This work is licensed under the GNU General Public License, version 3.", "gpl"), ("licensed under CC BY-NC 4.0", "cc-by-nc"), ("licensed under CC BY 4.0", "cc-by"), ("Released under the terms of the Expat licence", "mit"), ("released under a license", None)]
)
def test_notices(text, label):
    assert labels(text) == ({label} if label else set())


def test_templates_need_a_first_word():
    with pytest.raises(ValueError):
        l.Scanner(templates={"x": "<<var;max=2>> word"})


def test_query(spark, tables):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = l.op5_licenses(spark, tables).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, base = brute(texts[r.doc_id])
        starts = [a for a, _, _ in base]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(base), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, _, x in base})) and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_messy(messy, empty):
    rows = l.find_licenses(messy).collect()
    assert len(rows) == messy.count() and l.find_licenses(empty).count() == 0
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].n_words == 0 and by_id[2].score == 0.0 and by_id[5].n_words == 160_000
