"""Hand-worked cases of functions that SQL does not check."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import chunks, integrity, nested, numbers, scripture
from quarry.functions import text as fn
from quarry.operators import evidence, search, similarity, windows
from quarry.sources import readers, writers


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], schema=", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'int' if isinstance(v, int) else 'double'}" for k, v in values.items()))
    return frame.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text, value", [("XIV", 14), ("mcmxc", 1990), ("IIX", 8), ("abc", None), ("", None)])
def test_roman_value(spark, text, value):
    assert one(spark, fn.roman_value(F.col("t")), t=text) == value


@pytest.mark.parametrize("text, value", [("XIV", 14), ("IIX", None), ("MM", None), ("", None)])
def test_roman_strict(spark, text, value):
    assert one(spark, fn.roman_strict(F.col("t")), t=text) == value


def test_to_roman(spark):
    assert [one(spark, fn.to_roman(F.col("n")), n=n) for n in (1, 4, 49, 1994, 3999, 0, 4000)] == ["I", "IV", "XLIX", "MCMXCIV", "MMMCMXCIX", None, None]


def test_hyphenation_and_markup(spark):
    assert one(spark, fn.clean_markup(F.col("t")), t="<p>exem-\n  plum   bonum</p>\r\nfinis") == "exemplum bonum\nfinis"
    assert one(spark, fn.strip_markdown(F.col("t")), t="## Title\n- **one** `two`") == "Title\none two"


def test_fold_unicode(spark):
    assert one(spark, fn.fold_unicode(F.col("t")), t="Ἀρχή Æther ﬁne ÇA") == "αρχη aether fine ca"
    assert one(spark, fn.fold_unicode(F.col("t")), t=None) is None


@pytest.mark.parametrize("a, b, score", [("", "", 1.0), ("abc", "", 0.0), ("abcd", "abed", 0.75)])
def test_agreement(spark, a, b, score):
    assert one(spark, fn.agreement(F.col("a"), F.col("b")), a=a, b=b) == score


def test_scan_distance(spark):
    assert one(spark, fn.scan_distance(F.col("a"), F.col("b")), a="modern", b="modem") == pytest.approx(0.22, abs=1e-9)
    assert one(spark, fn.scan_distance(F.col("a"), F.col("b")), a="abcd", b="abdc") == pytest.approx(0.25)


def test_scripts(spark):
    found = one(spark, fn.infer_script(F.col("t"), F.lit(None)), t="λόγος και αλήθεια and words")
    assert found["script"] == "mixed"
    assert one(spark, fn.infer_script(F.col("t"), F.lit("greek")), t="123")["confidence"] == 0.45
    assert one(spark, fn.text_class(F.col("t"), F.lit(None)), t="λόγος") == "greek"


def test_numbers(spark):
    assert one(spark, numbers.entropy(F.col("t")), t="aabb") == 1.0
    assert one(spark, numbers.entropy(F.col("t")), t="") == 0.0
    assert one(spark, numbers.compression(F.col("t")), t="") == 0.0
    assert one(spark, numbers.varuint(F.col("n")), n=300) == "AC02"
    assert [one(spark, numbers.zigzag(F.col("n")), n=n) for n in (0, -1, 1, -2)] == [0, 1, 2, 3]
    box = lambda *v: tuple(map(F.lit, map(float, v)))
    assert one(spark, numbers.iou(box(0, 0, 2, 2), box(1, 0, 3, 2)), n=1) == pytest.approx(1 / 3)
    assert one(spark, numbers.iou(box(0, 0, 0, 2), box(0, 0, 0, 2)), n=1) == 0.0


def test_json(spark):
    assert one(spark, nested.json_items(F.col("t"), "keywords_ranking", "keywords"), t='{"keywords": ["a", "b"]}') == ["a", "b"]
    assert one(spark, nested.json_items(F.col("t"), "keywords"), t='["x"]') == ["x"]
    assert one(spark, nested.json_object(F.col("t")), t='no {bad} but {"b": 1, "a": {"c": "}"}} end') == '{"a": {"c": "}"}, "b": 1}'
    change, whole = (nested.replacer({"Saint John": "John", " john ": "J\\1", "": "x"}, only) for only in (False, True))
    assert [change(v) for v in (" SAINT john", "saint john, Johnson", "of John.", "")] == ["John", "J\\1, Johnson", "of J\\1.", ""]
    assert [whole(v) for v in ("JOHN", "of John.")] == ["J\\1", "of John."]
    assert one(spark, nested.replace_strings(F.col("t"), {"a b": "c"}), t='{"a b": ["A b", 1, {"k": "x a b"}]}') == '{"a b": ["c", 1, {"k": "x c"}]}'
    assert one(spark, nested.replace_strings(F.col("t"), {"a": "c"}), t="a no json") == "a no json"
    assert one(spark, nested.expand_range(F.col("t")), t="3-5, 9, x, 7-2") == [3, 4, 5, 9]
    assert one(spark, nested.any_kind(F.col("t"), ["a"]), t="no json") is False
    lines = one(spark, nested.category_lines(F.col("t")), t="- **Persons**: Paul, Peter; Mark\nnothing\nPlaces:")
    assert [(x["category"], x["items"]) for x in lines] == [("persons", ["Paul", "Peter", "Mark"])]


@pytest.mark.parametrize(
    "text, found",
    [
        ("Cf. Gen 3:5-7, 9; 4:2 et alia", [("gen", 3, 5, 7), ("gen", 3, 9, 9), ("gen", 4, 2, 2)]),
        ("Matth. V, 9", [("matt", 5, 9, 9)]),
        ("Jude 5", [("jude", 1, 5, 5)]),
        ("Rom 8", [("rom", 8, None, None)]),
        ("Ps. 200:1", []),
        ("is 4 am 3", []),
        ("", []),
        ("Éx. 12:1-13:4", [("ex", 12, 1, 4)]),
        ("Psalmus CXXXVIII.", [("ps", 138, None, None)]),
    ],
)
def test_citations(text, found):
    assert [(c.book, c.chapter, c.verse, c.verse_end) for c in scripture.citations(text)] == found


def test_citation_places_point_into_the_text():
    text = "Ἀρχή, vide ÆGen. 3:5 et Éx. 12:1"
    assert [text[c.start : c.end] for c in scripture.citations(text)] == ["Éx. 12:1"]


def test_traditions():
    assert scripture.citations("1 Reg. 3:4", "latin")[0].book == "1sam"
    assert scripture.citations("1 Reg. 3:4")[0].book == "1kgs"


def test_windows_and_sentences():
    text = "one two three. four five six. " * 20
    places = chunks.windows(text, 100, 20)
    assert places[0][0] == 0 and places[-1][1] == len(text)
    assert all(b - a <= 100 for a, b in places) and all(n[0] < p[1] for p, n in zip(places, places[1:]))
    assert all(len(p) <= 50 for p in chunks.sentences(text, 50)) and "".join(chunks.sentences("x" * 120, 50)) == "x" * 120
    assert chunks.windows("", 10, 2) == [] and chunks.sentences(" ", 10) == []


def test_locate():
    text = "In principio erat Verbum, et Verbum erat apud Deum."
    assert chunks.locate("erat Verbum", text)["kind"] == "exact"
    assert chunks.locate("VERBUM ERAT apud", text)["kind"] == "normalized"
    assert chunks.locate("Verbvm erat apud Devm", text)["kind"] == "fuzzy"
    assert chunks.locate("nothing like it", text)["kind"] == "absent" and chunks.locate("", "")["kind"] == "absent"


def test_alignment():
    assert chunks.compared("in principio erat", "in principio erat") == {"n_same": 3, "n_changed": 0, "n_omitted": 0, "n_added": 0, "n_unresolved": 0, "coverage": 1.0}
    assert chunks.compared("in prin cipio erat", "in principio erat")["n_changed"] == 1
    assert chunks.compared("", "a b")["n_omitted"] == 2 and chunks.compared("a", "")["coverage"] == 1.0


def test_alignment_covers_both_lists():
    """Every word of both is in one link, whatever the anchors; gaps beyond the bound are unresolved and not counted as covered."""
    import random

    draw = random.Random(3)
    for _ in range(60):
        a = [draw.choice("abcdefgh") * draw.randrange(1, 4) for _ in range(draw.randrange(0, 60))]
        b = [w for w in a if draw.random() > 0.1] + [draw.choice("xyz")] * draw.randrange(3)
        links = chunks.align(a, b)
        assert [n for i, j, *_ in links for n in range(i, j)] == list(range(len(a)))
        assert [n for _, _, k, m, _ in links for n in range(k, m)] == list(range(len(b)))
        assert all(a[i:j] == b[k:m] for i, j, k, m, c in links if c == 0.0)
    apart = chunks.compared(" ".join(f"a{i}" for i in range(600)), " ".join(f"b{i}" for i in range(500)))
    assert apart["n_unresolved"] == 500 and apart["coverage"] == 0.0


def test_line_diffs(spark):
    rows = spark.createDataFrame([("d", 1, "one\ntwo\nthree"), ("d", 2, "two\none\nthree"), ("d", 3, "two\none\nthree"), ("d", 4, "two\nthree")], "k string, v int, t string")
    from quarry.operators.windows import version_diffs

    found = {r.v: (r.insertions, r.deletions) for r in version_diffs(rows, ["k"], ["v"], "t").collect()}
    assert found == {2: (1, 1), 4: (0, 1)}


def test_excerpts_and_columns():
    text = "x " * 200 + "divine grace works " + "y " * 200
    assert "divine grace" in chunks.densest(text, "Grace divine", 60)
    assert chunks.column_count([(0, 400), (500, 900), (20, 380)], 1000) == 2 and chunks.column_count([], 1000) == 1


@pytest.mark.parametrize("text, value, issue", [("**Grace**", "Grace", "markup"), ("", None, "empty"), ("12, 13", None, "numbers_only"), ("...", None, "no_letters"), ("Keywords: Faith", "Faith", "label"), ("a (b", "a b", "parentheses")])
def test_sanitize(text, value, issue):
    found = integrity.sanitize(text)
    assert found["value"] == value and issue in found["issues"]


def test_status():
    check = lambda t: integrity.status(t, {"grace", "faith"}, {"the"})
    assert [check(t) for t in ("Grace", "the", "grace unknowable", "zzz", "λόγоs", None)] == ["VALID", "STOPWORD", "SUSPECT", "UNKNOWN", "MIXED_SCRIPT", "NOISE"]


def test_entries_and_candidates():
    assert evidence.parse_entry("Abraham, 12, 15-17, 215-17 vide Isaac.") == {"lemma": "Abraham", "numbers": [12, 15, 16, 17, 215, 216, 217], "see": "Isaac", "issues": []}
    assert evidence.parse_entry("")["issues"] == ["no_lemma"]
    found = evidence.summary_candidate('Here: {"title": "T", "summary": "A long enough summary.", "work": "w9", "keywords": "a; b, a"}', {"w1"})
    assert found == {"title": "T", "summary": "A long enough summary.", "work": None, "keywords": ["a", "b"], "issues": ["work_unknown", "keywords_text"]}
    assert evidence.summary_candidate("no json", set())["issues"] == ["no_object"]


def test_boolean_queries():
    tree = search.parse_boolean("a || b && (c || d)")
    assert tree.kind == "or" and tree.parts[1].kind == "and"
    for bad in ("", "a &&", "(a", "a)", "a && b && c && d && e", "x" * 401):
        with pytest.raises(ValueError):
            search.parse_boolean(bad)


def test_query_sets_and_quotas():
    assert search.query_set(["a  b", "A b", "", "c" * 300, "d", "e", "f"]) == ["a b", "c" * 200, "d", "e"]
    assert search.largest_remainder(10, {"a": 50, "b": 40, "c": 10}) == {"a": 5, "b": 4, "c": 1}
    assert search.largest_remainder(1, {"a": 1, "b": 1}) == {"a": 1, "b": 0}
    assert search.allocate(10, {"a": 50, "b": 40, "c": 10}, {"a": 2, "b": 100, "c": 0}) == {"a": 2, "b": 8, "c": 0}


def test_pages_of_files(spark, tmp_path):
    folder = tmp_path / "PG001" / "text"
    folder.mkdir(parents=True)
    uuid = "01234567-89ab-cdef-0123-456789abcdef"
    for name, text in (("PG001-001.txt", "one"), (f"{uuid}-1.txt", "twin"), (f"{uuid}-2.txt", "two"), ("notes.txt", "none")):
        (folder / name).write_text(text)
    files = readers.page_files(spark, f"file://{tmp_path}")
    assert sorted((r.page_num, r.raw) for r in files.collect()) == [(1, "one"), (1, "twin"), (2, "two")]
    assert sorted(r.raw for r in readers.preferred_pages(files).collect()) == ["one", "two"]
    assert {r.page_num: r.chosen for r in readers.chosen_pages(files).collect()} == {1: "PG001-001", 2: f"{uuid}-2"}
    with pytest.raises(Exception, match="ambiguous"):
        double = files.unionByName(files.withColumn("stem", F.concat(F.lit("x"), "stem")).where("page_num = 2"))
        readers.unique_pages(double).collect()


def test_page_xml():
    well = readers.parse_page('<pagina estado="ok" tipo="t"><bloco tipo="a" script="latino" bbox="1,2,3,4">A <b>c</b></bloco></pagina>')
    assert well["how"] == "xml" and well["state"] == "ok" and well["blocks"][0]["text"] == "A c"
    assert readers.parse_page("<pagina><bloco>a & b</bloco></pagina>")["how"] == "repaired"
    broken = readers.parse_page('<pagina estado="ok"><bloco tipo="x">a <i>b</bloco>')
    assert broken["how"] == "pattern" and broken["blocks"][0]["type"] == "x" and broken["state"] == "ok"
    assert readers.parse_page("plain")["blocks"][0]["type"] == "texto_principal" and readers.parse_page(None)["blocks"] == []


def test_side_files(spark, tmp_path):
    rows = [("PL002", 7), ("PG001", 300), ("PL002", 8)]
    payload = writers.encode_places(rows)
    assert [(v, p) for _, v, p in readers.decode_places(payload)] == rows
    with pytest.raises(ValueError):
        list(readers.decode_places(payload[:-1] + b"\0"))
    (tmp_path / "a.bin").write_bytes(payload)
    assert [(r.doc_id, r.volume, r.page) for r in readers.places(spark, f"file://{tmp_path}").orderBy("doc_id").collect()] == [(i, *r) for i, r in enumerate(rows)]
    spark.dataSource.register(readers.PlacesSource)
    assert spark.read.format("places").option("binary", payload.hex()).load().count() == 3


def test_tables_from_files(spark, tmp_path):
    (tmp_path / "v.csv").write_text("version,book,chapter,verse,text\nA,gen,1,1,In\nA,gen,1,1,In\nB,gen,1,1,Au\n")
    assert readers.verses(spark, f"file://{tmp_path}/v.csv").count() == 2
    (tmp_path / "freq.txt").write_text("   12 a\n    3 é\nbad\n")
    assert {r.character: r.n for r in readers.character_frequencies(spark, f"file://{tmp_path}/freq.txt").collect()} == {"a": 12, "é": 3}
    (tmp_path / "s.json").write_text('{"volume": "PG001", "page": 1, "text": "t", "keywords": ["k"]}\n')
    assert readers.shards(spark, f"file://{tmp_path}/s.json").first().keywords == ["k"]


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 1, "z")], "doc string, page_num long, text string")
    writers.write_pages(rows, f"file://{tmp_path}/p")
    assert dict(spark.read.parquet(f"file://{tmp_path}/p").dtypes)["page_num"] == "int"
    digests = {r.doc: r.n for r in writers.write_shards(rows, f"file://{tmp_path}/s", "doc", ["page_num"]).collect()}
    assert digests == {"a": 2, "b": 1} and spark.read.json(f"file://{tmp_path}/s").count() == 3
    writers.overwrite_blocks(rows, f"file://{tmp_path}/b", "doc")
    writers.overwrite_blocks(rows.where("doc = 'a' and page_num = 1"), f"file://{tmp_path}/b", "doc")
    assert sorted(r.text for r in spark.read.json(f"file://{tmp_path}/b").collect()) == ["x", "z"]
    writers.write_report(rows, f"file://{tmp_path}/r", ["doc", "page_num"])
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/r").count() == 3


def test_neighbours_in_blocks(spark):
    rows = spark.createDataFrame([(i, [float(i), 0.0], str(i % 2)) for i in range(20)], "id long, v array<double>, g string")
    whole = sorted(map(tuple, search.neighbours(rows, rows, "id", "v", "g", 3).collect()))
    assert sorted(map(tuple, search.neighbours(rows, rows, "id", "v", "g", 3, block=7).collect())) == whole


def test_keep_first(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "a"), (5, "d")], "id long, digest string")
    pairs = spark.createDataFrame([(1, 2), (2, 3), (3, 5)], "a long, b long")
    # 1 stays, 2 goes for 1; 3 is near the dropped 2 only and stays; 5 goes for 3; 4 equals 1.
    assert {r.id: r.kept for r in similarity.keep_first(docs, "id", "digest", pairs).collect()} == {1: True, 2: False, 3: True, 4: False, 5: False}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r.node: r.component for r in similarity.components(edges).collect()}
    assert all(found[i] == 0 for i in range(51)) and found[101] == 100 and len(found) == 53


def test_time_breaks_by_hand(spark):
    rows = spark.createDataFrame([("d", 1, 1), ("d", 2, 3), ("d", 3, 2), ("d", 4, 4), ("e", 1, 5), ("e", 2, 5)], "doc string, page int, ts int")
    assert [tuple(r) for r in windows.time_breaks(rows, "doc", "page", "ts").collect()] == [("d", 3)]


def test_identity_of_page_groups(spark):
    rows = [("v", i, "PG" if i in (1, 12) else None, {1: 20, 12: 21}.get(i), None) for i in range(1, 26)]
    pages = spark.createDataFrame(rows, "volume string, page int, series string, tome int, part int")
    groups = windows.page_groups(pages, "volume", "page", 10).groupBy("volume", "group_no").agg(F.max("series").alias("series"), F.max("tome").alias("tome"), F.max("part").alias("part"))
    filled = windows.fill_identity(groups, "volume", "group_no", "series", "tome", "part").orderBy("group_no").collect()
    assert [r.full_tome for r in filled] == [20, 21, 21] and {r.full_series for r in filled} == {"PG"}


def test_one_writer_for_a_volume(tmp_path):
    from quarry.api import VolumeLock

    with VolumeLock(str(tmp_path), "PG001"), pytest.raises(BlockingIOError), VolumeLock(str(tmp_path), "PG001"):
        pass
    with VolumeLock(str(tmp_path), "PG001"), VolumeLock(str(tmp_path), "PG002"):
        pass


def test_compared_measures_each_gap_once(monkeypatch):
    """Equal words between anchors are aligned once, whatever the text's length; blocks are difflib's."""
    import difflib
    import random

    draw = random.Random(8)
    for _ in range(2_000):
        a = [draw.choice("abc") for _ in range(draw.randrange(7))]
        b = [draw.choice(a + ["x", "y"]) if draw.random() < 0.4 else w for w in a for _ in range(draw.randrange(3))]
        want = [tuple(m) for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if m.size]
        assert [tuple(m) for m in chunks._blocks(a, b) if m[2]] == want
    calls = []
    monkeypatch.setattr(chunks, "_damerau", lambda x, y, f=chunks._damerau: calls.append(x) or f(x, y))
    text = " ".join(f"w{i} v{i} u{i} consubstantialem" for i in range(300))
    found = chunks.compared(text.replace("consubstantialem", "consubst antialem"), text)
    assert found == {"n_same": 900, "n_changed": 300, "n_omitted": 0, "n_added": 0, "n_unresolved": 0, "coverage": 1.0}
    assert len(calls) < 100


def test_compared_pages_align_every_gap(spark):
    """Gaps of any size are aligned: repeated lines, whose runs are no anchors, and lists without a common word; long lists as short ones."""
    import difflib
    import random

    draw = random.Random(10)
    for _ in range(300):
        a = [draw.choice("abcdef"[: draw.randrange(1, 7)]) for _ in range(draw.randrange(1, 40))]
        b = [w for w in a if draw.random() > 0.2] + [draw.choice("abxyz") for _ in range(draw.randrange(8))]
        assert chunks._long_blocks(a, b) == [tuple(m) for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()]
        a, b = (["".join(draw.choice("abrn1m") for _ in range(draw.randrange(1, 6))) for _ in range(draw.randrange(1, 12))] for _ in range(2))
        want = chunks._linked.__wrapped__(tuple(a), tuple(b))
        assert chunks._long_linked(a, b) == chunks._long_linked(a, b, stored=draw.choice([1, 3, 7])) == want
    apart = [" ".join(f"{c}{i % 90}" for i in range(n)) for c, n in (("a", 600), ("b", 500))]
    line = "in principio erat consubstantialem et verbum "
    rows = spark.createDataFrame([(line.replace("consubstantialem", "consubst antialem") * 150, line * 150), tuple(apart)], "c string, r string")
    repeated, unlike = (r.c.asDict() for r in rows.select(chunks.compared_pages("c", "r").alias("c")).collect())
    assert repeated == {"n_same": 750, "n_changed": 150, "n_omitted": 0, "n_added": 0, "n_unresolved": 0, "coverage": 1.0}
    assert unlike["n_unresolved"] == 0 and unlike["n_changed"] + unlike["n_omitted"] == 500 and unlike["n_changed"] > 400
