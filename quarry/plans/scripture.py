"""Queries of citations, verses and page evidence."""

from pyspark.sql import functions as F

from ..functions import scripture as fn
from ..operators import evidence as ops
from ..operators.clustering import top_ranked
from .registry import query

NAMES = ["Gen.", "Exod", "Psalmus", "Isaias", "Matth.", "Marc.", "Luc", "Joannes", "Rom.", "1 Cor"]
KEYS = ["gen", "ex", "ps", "isa", "matt", "mark", "luke", "john", "rom", "1cor"]
NAME_SQL = "[" + ", ".join(f"'{n}'" for n in NAMES) + "][(l_partkey % 10 + 1)::int]"
KEY_SQL = "[" + ", ".join(f"'{n}'" for n in KEYS) + "][(l_partkey % 10 + 1)::int]"


def name():
    return F.element_at(F.array(*map(F.lit, NAMES)), (F.col("l_partkey") % 10 + 1).cast("int"))


def whole(c):
    return F.col(c).cast("int").cast("string")


def labelled(t):
    """Lines as labels that cite: book, chapter (the line number), verses."""
    v = F.col("l_quantity").cast("int")
    text = F.concat(F.lit("De fide, "), name(), F.lit(" "), whole("l_linenumber"), F.lit(":"), v.cast("string"), F.lit("-"), (v + 2).cast("string"), F.lit(", "), (v + 5).cast("string"), F.lit(" et passim"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", text.alias("label"))


@query(f"select l_orderkey, l_linenumber, {KEY_SQL} as book from lineitem")
def p01_book_keys(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", fn.book_key(name()).alias("book"))


@query("""select l_orderkey, l_linenumber, case when l_suppkey % 2 = 0 then (case when l_partkey % 2 = 0 then '1sam' else '2sam' end) else 'rom' end as latin, case when l_suppkey % 2 = 0 then (case when l_partkey % 2 = 0 then '1kgs' else '2kgs' end) else 'rom' end as modern, l_suppkey % 2 = 0 as ambiguous from lineitem""")
def p03_resolved_books(t):
    raw = F.when(F.col("l_suppkey") % 2 == 0, F.when(F.col("l_partkey") % 2 == 0, "I Reg.").otherwise("II Reg.")).otherwise("Rom")
    latin, modern = fn.book_key(raw, "latin"), fn.book_key(raw, "modern")
    return t.lineitem.select("l_orderkey", "l_linenumber", latin.alias("latin"), modern.alias("modern"), (latin != modern).alias("ambiguous"))


@query(f"""with b as (select l_orderkey, l_linenumber, {KEY_SQL} as book, l_linenumber as chapter, l_quantity::int as v from lineitem)
select l_orderkey, l_linenumber, book, chapter, v as verse, v + 2 as verse_end, 'range' as kind from b union all select l_orderkey, l_linenumber, book, chapter, v + 5, v + 5, 'verse' from b""")
def p05_citations(t):
    found = labelled(t).select("l_orderkey", "l_linenumber", F.explode(fn.find_citations(F.col("label"))).alias("c"))
    return found.select("l_orderkey", "l_linenumber", *[F.col(f"c.{n}").alias(n) for n in ("book", "chapter", "verse", "verse_end", "kind")])


@query()
def p04_document_citations(t):
    """Whole texts, each with a citation in the middle and one at the end (the given ones have none)."""
    chapter, verse = (F.col("doc_id") % 50 + 1).cast("string"), (F.col("doc_id") % 20 + 1).cast("string")
    half = F.floor(F.length("text") / 2).cast("int")
    text = F.concat(F.substr("text", F.lit(1), half), F.lit("\ncf. Gen "), chapter, F.lit(":"), verse, F.lit("\n"), F.substr(F.col("text"), half + 1), F.lit("\nRom "), verse, F.lit(":1-3"))
    return t.documents.select("doc_id", F.explode(fn.find_citations(text)).alias("c")).select("doc_id", "c.*")


@query(f"select l_orderkey, l_linenumber, {KEY_SQL} as book, l_linenumber as chapter, 'chapter' as kind from lineitem")
def p06_chapter_references(t):
    found = t.lineitem.select("l_orderkey", "l_linenumber", fn.find_citations(F.concat(F.lit("Vide "), name(), F.lit(" "), whole("l_linenumber"), F.lit(" totum")))[0].alias("c"))
    return found.select("l_orderkey", "l_linenumber", "c.book", "c.chapter", "c.kind")


@query("select doc_id, (doc_id % 149 + 1)::int as psalm from documents")
def p07_psalm_headings(t):
    heading = F.concat(F.lit("Textus\nIN PSALMUM "), fn_roman(F.col("doc_id") % 149 + 1), F.lit(".\n"))
    return t.documents.select("doc_id", fn.find_citations(heading)[0]["chapter"].alias("psalm"))


def fn_roman(value):
    from ..functions.text import to_roman

    return to_roman(value)


@query("""select p_partkey, case when p_size > 40 then 'index' when p_type like 'ECO%' then 'apparatus' when p_type like 'STAN%' then 'note' when p_type like 'SMALL%' then 'header' else 'body' end as kind from part""")
def p08_context_kinds(t):
    block = F.when(F.col("p_type").startswith("ECO"), "aparato").when(F.col("p_type").startswith("STAN"), "nota").when(F.col("p_type").startswith("SMALL"), "cabecalho").otherwise("texto")
    return t.part.select("p_partkey", fn.context_kind(block, F.when(F.col("p_size") > 40, "indice").otherwise("texto"), F.lit(False)).alias("kind"))


@query("""select l_orderkey, l_linenumber, case when w / 1000 >= 0.72 then 'both' when (x + w) / 1000 <= 0.54 then 'left' when x / 1000 >= 0.46 then 'right' else 'both' end as side from (select l_orderkey, l_linenumber, l_quantity * 10 as x, (l_partkey % 900)::double as w from lineitem)""")
def p09_page_sides(t):
    x, w = F.col("l_quantity") * 10, F.col("l_partkey") % 900
    return t.lineitem.select("l_orderkey", "l_linenumber", fn.page_side(x, x + w, F.lit(1000.0)).alias("side"))


REFERENCE = f"select l_orderkey, l_linenumber, {KEY_SQL} as b, l_linenumber as c, l_quantity::int as v, case when l_suppkey % 3 = 0 then l_linenumber + 1 end as ce, case when l_suppkey % 2 = 0 then l_quantity::int + 3 end as ve from lineitem"


@query(f"""with r as ({REFERENCE}) select l_orderkey, l_linenumber, b || ' ' || c || ':' || v || case when ce is not null then '-' || ce || coalesce(':' || ve, '') when ve is not null then '-' || ve else '' end as reference from r""")
def p10_reference_forms(t):
    v = F.col("l_quantity").cast("int")
    form = fn.reference_form(fn.book_key(name()), F.col("l_linenumber"), v, F.when(F.col("l_suppkey") % 3 == 0, F.col("l_linenumber") + 1), F.when(F.col("l_suppkey") % 2 == 0, v + 3))
    return t.lineitem.select("l_orderkey", "l_linenumber", form.alias("reference"))


@query("""select l_orderkey, l_linenumber, case when l_suppkey % 4 = 0 then 'list' when l_suppkey % 4 = 1 then 'range' when l_suppkey % 4 = 2 then 'verse' else 'chapter' end as granularity from lineitem""")
def p12_granularity(t):
    m, c, v = F.col("l_suppkey") % 4, F.col("l_linenumber"), F.col("l_quantity").cast("int")
    one = F.struct(c.alias("start_chapter"), F.when(m != 3, v).alias("start_verse"), c.alias("end_chapter"), F.when(m == 1, v + 1).when(m != 3, v).alias("end_verse"))
    return t.lineitem.select("l_orderkey", "l_linenumber", fn.granularity(F.when(m == 0, F.array(one, one)).otherwise(F.array(one))).alias("granularity"))


@query()
def p11_label_references(t):
    """Labels with their references and how much of them these are."""
    rows = labelled(t).select("l_orderkey", "l_linenumber", "label", fn.find_citations(F.col("label")).alias("found"))
    return rows.select("l_orderkey", "l_linenumber", F.size("found").alias("n"), fn.label_kind(F.col("label"), F.col("found")).alias("kind"))


@query("select l_orderkey, l_linenumber, (l_partkey % 3 = 0)::int + 1 as n_supported from lineitem")
def p14_supported_citations(t):
    c = lambda b, ch, v: F.struct(b.alias("book"), ch.alias("chapter"), v.alias("verse"))
    v = F.col("l_quantity").cast("int")
    anchors = F.array(c(F.lit("gen"), F.col("l_linenumber"), v), c(F.lit("rom"), F.col("l_linenumber"), v))
    hits = F.array(c(F.lit("gen"), F.col("l_linenumber"), F.lit(None).cast("int")), c(F.lit("rom"), F.col("l_linenumber"), F.when(F.col("l_partkey") % 3 == 0, v).otherwise(v + 1)))
    return t.lineitem.select("l_orderkey", "l_linenumber", F.size(ops.supported(anchors, hits)).alias("n_supported"))


@query("""with d as (select doc_id, unnest(string_split(text, chr(10))) as line from documents), q as (select doc_id as item_id, w[1:2] || w[4:] as wanted from (select doc_id, string_split(text, chr(10))[1] as w from documents where doc_id % 100 = 0) where length(w) > 3),
m as (select item_id, line, levenshtein(lower(wanted), lower(line)) / greatest(length(wanted), length(line))::double as distance from q join (select distinct line from d) on length(line) between length(wanted) * 0.75 - 1 and length(wanted) / 0.75 + 1)
select item_id, doc_id as page, round(min(distance), 6) as distance from m join d using (line) where distance <= 0.25 group by 1, 2""")
def p16_located_evidence(t):
    """The first line of every hundredth document, a letter lost, looked for in all documents."""
    line = F.split("text", "\n")[0]
    items = t.documents.where("doc_id % 100 = 0").where(F.length(line) > 3).select(F.col("doc_id").alias("item_id"), F.concat(F.substring(line, 1, 2), F.substr(line, F.lit(4))).alias("wanted"))
    found = ops.located_anywhere(items, t.documents, "item_id", "wanted", "doc_id", "text")
    return found.select("item_id", F.col("doc_id").alias("page"), F.round("distance", 6).alias("distance"))


@query(f"""select l_orderkey, l_linenumber, {KEY_SQL} as book, l_linenumber as chapter, l_quantity::int as start_verse, (case when l_suppkey % 2 = 0 then l_quantity::int + 4 else l_quantity::int end) as end_verse from lineitem""")
def p17_parsed_references(t):
    from ..functions.text import to_roman

    v = F.col("l_quantity").cast("int")
    chapter = F.when(F.col("l_partkey") % 2 == 0, whole("l_linenumber")).otherwise(to_roman(F.col("l_linenumber")))
    tail = F.when(F.col("l_suppkey") % 2 == 0, F.concat(F.lit("-"), (v + 4).cast("string"))).otherwise("")
    return t.lineitem.select("l_orderkey", "l_linenumber", fn.reference_parts(F.concat(name(), F.lit(" "), chapter, F.lit(":"), v.cast("string"), tail)).alias("r")).select("l_orderkey", "l_linenumber", "r.*")


@query("""with v as (select l_suppkey as book, l_linenumber as chapter, (l_partkey % 60)::int as verse, l_returnflag as version, min(l_orderkey) as text from lineitem group by all)
select book, chapter, verse, max(case when version = 'A' then text end) as a, max(case when version = 'N' then text end) as n, max(case when version = 'R' then text end) as r from v where book = 7 and chapter between 2 and 4 and verse between 5 and 30 group by 1, 2, 3""")
def p18_verse_lookup(t):
    """Verses of a range, versions side by side."""
    verses = t.lineitem.where("l_suppkey = 7 and l_linenumber between 2 and 4 and l_partkey % 60 between 5 and 30")
    rows = verses.groupBy(F.col("l_suppkey").alias("book"), F.col("l_linenumber").alias("chapter"), (F.col("l_partkey") % 60).cast("int").alias("verse"), "l_returnflag").agg(F.min("l_orderkey").alias("text"))
    return rows.groupBy("book", "chapter", "verse").pivot("l_returnflag", ["A", "N", "R"]).agg(F.max("text")).toDF("book", "chapter", "verse", "a", "n", "r")


@query("""with m as (select l_partkey as ref, bit_or(case l_returnflag when 'A' then 1 when 'N' then 2 else 4 end) as mask, min(l_linenumber * 10000 + l_suppkey) as s, max(l_linenumber * 10000 + l_suppkey) as e from lineitem group by 1),
r as (select ref, mask, s, case when s = 30000 and e = 49999 then 0 when s <= 30000 and e >= 49999 then 1 when s >= 30000 and e <= 49999 then 2 when s <= 49999 and e >= 30000 then 3 else 99 end::int as relation from m where mask & 4 > 0)
select ref, mask::bigint as mask, relation from r where relation < 99 order by relation, s, ref limit 200""")
def p22_matched_references(t):
    from ..operators.search import interval_relation

    bit = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(4).cast("long")
    at = F.col("l_linenumber") * 10000 + F.col("l_suppkey")
    rows = t.lineitem.groupBy(F.col("l_partkey").alias("ref")).agg(F.bit_or(bit).alias("mask"), F.min(at).alias("s"), F.max(at).alias("e")).where(F.col("mask").bitwiseAND(4) > 0)
    found = rows.withColumn("relation", interval_relation(F.col("s"), F.col("e"), F.lit(30000), F.lit(49999))).where("relation < 99")
    return found.orderBy("relation", "s", "ref").limit(200).select("ref", "mask", "relation")


@query()
def p24_summary_candidates(t):
    raw = F.concat(F.lit("Answer: "), F.to_json(F.struct(F.col("event_type").alias("title"), F.concat(F.lit("A summary of the event numbered "), F.col("event_id").cast("string")).alias("summary"), F.when(F.col("event_id") % 3 == 0, "w1").otherwise("w9").alias("work"), F.lit("a, b; a").alias("keywords"))))
    return t.events.select("event_id", ops.parsed_candidate(raw, ["w1", "w2"]).alias("c")).select("event_id", "c.*")


@query("""with e as (select l_orderkey as entry, l_partkey % 20 as page, l_returnflag as kind, case when abs(l_linenumber - 3) <= 1 then 2.5 when abs(l_linenumber - 3) <= 3 then 1.5 when abs(l_linenumber - 3) <= 8 then 0.5 else 0 end::double as w from lineitem),
k as (select entry, page, kind, sum(w) as w from e group by all), c as (select entry, page, least(w, case kind when 'A' then 3.0 when 'N' then 2.0 else w end) as w from k), s as (select entry, page, sum(w) as score, count(*) as n_kinds from c group by 1, 2)
select entry, page, score, n_kinds, row_number() over (partition by entry order by score desc, page)::int as rank from s qualify rank <= 3""")
def p25_page_candidates(t):
    rows = t.lineitem.select(F.col("l_orderkey").alias("entry"), (F.col("l_partkey") % 20).alias("page"), F.col("l_returnflag").alias("kind"), ops.position_evidence(F.abs(F.col("l_linenumber") - 3)).alias("w"))
    return top_ranked(ops.evidence_scores(rows, "entry", "page", "kind", "w", {"A": 3.0, "N": 2.0}), ["entry"], [F.desc("score"), "page"], 3)


@query("""with e as (select o_custkey % 10 as volume, o_orderkey as entry, (o_orderkey % 300)::int as number from orders), p as (select p_partkey % 10 as volume, p_partkey as page, (p_partkey % 350)::int as printed from part),
h as (select e.volume, entry, page, abs(printed - number) as d from e join p on e.volume = p.volume and printed between number - 2 and number + 2)
select e.volume, e.entry, coalesce(x, 0) as n_exact, coalesce(n, 0) as n_near, best_page from e left join (select volume, entry, sum((d = 0)::int)::bigint as x, sum((d > 0)::int)::bigint as n, min_by(page, (d, page)) as best_page from h group by 1, 2) using (volume, entry)""")
def p26_survey(t):
    entries = t.orders.select((F.col("o_custkey") % 10).alias("volume"), F.col("o_orderkey").alias("entry"), (F.col("o_orderkey") % 300).cast("int").alias("number"))
    pages = t.part.select((F.col("p_partkey") % 10).alias("volume"), F.col("p_partkey").alias("page"), (F.col("p_partkey") % 350).cast("int").alias("printed"))
    return ops.survey(entries, pages, "volume", "entry", "number", "page", "printed")


@query("""with h as (select user_id, event_id, event_type, case when event_type in ('purchase', 'error') then event_type || event_id end as heading from events),
f as (select *, last_value(heading ignore nulls) over (partition by user_id order by event_id) as hb, first_value(heading ignore nulls) over (partition by user_id order by event_id rows between current row and unbounded following) as ha from h)
select user_id, event_id, hb as heading_before, ha as heading_after, case when event_type = 'click' then 'act' when regexp_matches(hb, '^purchase') then 'deal' when regexp_matches(hb, '^error') then 'fault' else 'unknown' end as class from f""")
def p27_taxonomy(t):
    heading = F.when(F.col("event_type").isin("purchase", "error"), F.concat("event_type", F.col("event_id").cast("string")))
    lemma = F.when(F.col("event_type") == "click", F.lit("click"))
    found = ops.taxonomy(t.events, "user_id", "event_id", heading, lemma, {"act": "^click", "deal": "^purchase", "fault": "^error"})
    return found.select("user_id", "event_id", "heading_before", "heading_after", "class")


@query("""select l_orderkey, l_linenumber, 'Lemma ' || l_returnflag as lemma, l_quantity::int as first, case when l_suppkey % 2 = 0 then l_quantity::int + 3 else l_quantity::int end as last, case when l_suppkey % 5 = 0 then 'Alia' end as see from lineitem""")
def p28_index_entries(t):
    v = F.col("l_quantity").cast("int")
    text = F.concat(F.lit("Lemma "), "l_returnflag", F.lit(", "), v.cast("string"), F.when(F.col("l_suppkey") % 2 == 0, F.concat(F.lit("-"), (v + 3).cast("string"))).otherwise(""), F.when(F.col("l_suppkey") % 5 == 0, " vide Alia.").otherwise("."))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", ops.parsed_entry(text).alias("e"))
    return rows.select("l_orderkey", "l_linenumber", "e.lemma", F.array_min("e.numbers").alias("first"), F.array_max("e.numbers").alias("last"), "e.see")
