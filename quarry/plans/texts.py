"""Queries of text, numbers, JSON and filters (F, X, M, N rows)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import nested, numbers
from ..functions import text as fn
from ..operators import filters, similarity
from .registry import query

FOLD = "translate(lower({}), 'áàâäãéèêëíìîïóòôöõúùûüçñ', 'aaaaaeeeeiiiiooooouuuucn')"
r6 = lambda c: F.round(c, 6)


@query("""with w as (select doc_id, text, lang, list_filter(regexp_split_to_array(trim(text), '\\s+'), lambda x: x <> '') as t, len(regexp_extract_all(text, '\\p{L}')) as nl from documents),
c as (select doc_id, case when trim(coalesce(text, '')) = '' then 'empty' when len(t) < (case when lang = 'de' then 3 else 6 end) or nl < (case when lang = 'de' then 10 else 25 end) then 'too_short'
 when regexp_matches(text, '(?i)digitized by|all rights reserved|terms of service') and len(t) < 20 then 'boilerplate' when len(list_filter(t, lambda x: length(x) = 1)) / len(t)::double > 0.45 then 'fragmented' else 'keep' end as decision from w) select * from c""")
def f01_page_decision(t):
    return t.documents.select("doc_id", filters.page_decision(F.col("text"), F.col("lang") == "de").alias("decision"))


@query("""select doc_id, case when lang = 'es' and n_chars % 5 = 0 then 'quality' when trim(text) = '' then 'empty' when length(trim(text)) < 25 and length(trim(h)) < 60 then 'short' when regexp_matches(lower(h), '^(the and|or the)') then 'low_value'
when (contains(lower(h), 'thing')::int + contains(lower(h), 'tion')::int + contains(lower(h), 'with')::int) >= 2 then 'noise' end as reason from (select *, text as h from documents)""")
def f02_similarity_drop(t):
    quality = F.when((F.col("lang") == "es") & (F.col("n_chars") % 5 == 0), "drop").otherwise("ok")
    return t.documents.select("doc_id", filters.similarity_drop(F.col("text"), F.col("text"), quality, "^(the and|or the)", ["thing", "tion", "with"]).alias("reason"))


@query("""with c as (select doc_id, length(text) as n, unnest(string_split(text, '')) as ch from documents), g as (select doc_id, n, ch, count(*) as k from c group by doc_id, n, ch),
e as (select doc_id, log2(n::double) - sum(k * log2(k::double)) / n as ent from g group by doc_id, n), s as (select doc_id, len(regexp_extract_all(text, '\\p{L}')) / length(text)::double as share from documents)
select doc_id, array_to_string(list_filter([case when share < 0.45 then 'few_letters' end, case when ent > 4.7 and share < 0.55 then 'entropy' end], lambda x: x is not null), ',') as flags from e join s using (doc_id)""")
def f03_noise_flags(t):
    return t.documents.select("doc_id", F.array_join(filters.noise_flags(F.col("text")), ",").alias("flags"))


@query()
def f03_noise_flags_compression(t):
    return t.documents.select("doc_id", F.array_join(filters.noise_flags(F.col("text"), True), ",").alias("flags"))


@query("select doc_id as id, source as volume, lang as status from documents where lang = 'fr' and source = 'src3' and trim(text) <> ''")
def f04_line_filter(t):
    rows = t.documents.select(F.col("doc_id").alias("id"), F.col("source").alias("volume"), F.col("lang").alias("status"), "text")
    return filters.line_filter(rows, status="fr", volume="src3", filled=True).drop("text")


@query("""with q as (select o_orderkey, o_totalprice, (row_number() over (order by o_orderdate, o_orderkey) - 1) // 250 as batch from orders where o_orderstatus = 'P')
select batch, o_orderkey, row_number() over (partition by batch order by o_totalprice desc, o_orderkey)::int as place from q""")
def f05_two_stage_queue(t):
    # The first stage numbers the queue by counting before each date, so no task sorts all rows.
    queue = t.orders.where("o_orderstatus = 'P'")
    dates = queue.groupBy("o_orderdate").agg(F.count("*").alias("n"))
    before = global_before(dates, "o_orderdate", "n")
    place = F.row_number().over(Window.partitionBy("o_orderdate").orderBy("o_orderkey")) - 1 + F.col("before")
    batches = queue.join(before, "o_orderdate").select("o_orderkey", "o_totalprice", F.floor(place / 250).alias("batch"))
    return batches.select("batch", "o_orderkey", F.row_number().over(Window.partitionBy("batch").orderBy(F.desc("o_totalprice"), "o_orderkey")).alias("place"))


def global_before(counts, key: str, n: str):
    """key, before: how many rows stand before each key. The running sum is over counts by year and month first, so both windows are small."""
    month = F.date_trunc("month", key)
    months = counts.groupBy(month.alias("_m")).agg(F.sum(n).alias("_n"))
    months = months.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.coalesce(F.sum(n).over(Window.partitionBy("_m").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.withColumn("_m", month).join(F.broadcast(months.select("_m", "_before")), "_m").select(key, (F.col("_before") + inside).alias("before"))


@query("""select p_partkey, case when p_type like 'ECO%' or p_size < 5 then 'scripture' when p_brand like '%1' or p_size > 45 then 'names' else 'subjects' end as domain from part""")
def f06_route(t):
    section = F.when(F.col("p_type").startswith("ECO"), "scripture").when(F.col("p_brand").endswith("1"), "names").otherwise("general")
    kind = F.when(F.col("p_size") < 5, "verse").when(F.col("p_size") > 45, "person").otherwise("entry")
    return t.part.select("p_partkey", filters.route(kind, section).alias("domain"))


@query("""with d as (select o_custkey, list_sort(list(distinct (o_orderkey % 5)::bigint)) as tomes, min(o_orderstatus) as s from orders group by 1)
select o_custkey, case when len(tomes) = 0 then 'undetected' when s <> 'F' then 'review_series' when not list_contains(tomes, o_custkey % 5) then 'review_tome' when len(tomes) > 1 then 'review_multiple' else 'match' end as status from d""")
def f07_declared_status(t):
    rows = t.orders.groupBy("o_custkey").agg(F.collect_set(F.col("o_orderkey") % 5).alias("tomes"), F.min("o_orderstatus").alias("s"))
    return rows.select("o_custkey", filters.declared_status(F.lit("F"), F.col("o_custkey") % 5, F.col("s"), F.col("tomes")).alias("status"))


@query(f"select doc_id, len(list_filter(string_split(text, chr(10)), lambda x: {FOLD.format('x')} <> 'the and attion to thanedble the, anea. eriner thanea.'))::int as n_kept from documents")
def f08_without_constant(t):
    """How many lines of each whole text stay when those that fold to a constant go."""
    kept = F.filter(F.split("text", "\n"), lambda x: fn.fold_latin(x) != "the and attion to thanedble the, anea. eriner thanea.")
    return t.documents.select("doc_id", F.size(kept).alias("n_kept"))


@query("""with p as (select a.s_suppkey as a, b.s_suppkey as b, a.s_name as x, b.s_name as y from supplier a join supplier b on a.s_nationkey = b.s_nationkey and a.s_suppkey < b.s_suppkey)
select a, b, length(x) >= 5 and length(y) >= 5 and abs(length(x) - length(y)) <= 2 and levenshtein(x, y) <= 2 and 1 - levenshtein(x, y) / greatest(length(x), length(y))::double >= 0.9 as fuzzy,
length(a::varchar) = length(b::varchar) and hamming(lpad(a::varchar, 9, '0'), lpad(b::varchar, 9, '0')) <= 1 as one_digit from p""")
def f09_fuzzy_pairs(t):
    left = t.supplier.select(F.col("s_suppkey").alias("a"), F.col("s_name").alias("x"), "s_nationkey")
    right = t.supplier.select(F.col("s_suppkey").alias("b"), F.col("s_name").alias("y"), "s_nationkey")
    pairs = left.join(right, "s_nationkey").where("a < b")
    text = lambda c: F.col(c).cast("string")
    return pairs.select("a", "b", filters.fuzzy_match(F.col("x"), F.col("y"), F.lit(0.9)).alias("fuzzy"), filters.one_digit_off(text("a"), text("b")).alias("one_digit"))


@query("""select l_orderkey, l_linenumber, case when length(a) = length(b) then hamming(a, b)::int when abs(length(a) - length(b)) = 1 and levenshtein(a, b) = 1 then 1 end as distance from (select l_orderkey, l_linenumber, l_partkey::varchar as a, (l_partkey + l_suppkey % 13)::varchar as b from lineitem)""")
def f11_number_distance(t):
    a, b = F.col("l_partkey").cast("string"), (F.col("l_partkey") + F.col("l_suppkey") % 13).cast("string")
    return t.lineitem.select("l_orderkey", "l_linenumber", filters.number_distance(a, b).alias("distance"))


@query()
def f12_reference_labels(t):
    """Of each whole text how many lines and words are reference labels, and whether its brackets are unbalanced."""
    found = lambda pattern: F.size(F.filter(F.split("text", pattern), filters.looks_like_reference))
    return t.documents.select("doc_id", found("\n").alias("n_lines"), found(r"\s+").alias("n_words"), filters.unbalanced(F.col("text")).alias("unbalanced"))


@query("select o_orderkey, 'no_lines' as issue from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey) union all select l_orderkey, 'no_order' from (select distinct l_orderkey from lineitem) where not exists (select 1 from orders where l_orderkey = o_orderkey) union all select o_orderkey, 'implausible' from orders where o_totalprice > 400000")
def f14_integrity(t):
    orders, keys = t.orders, t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    issue = lambda df, name: df.select("o_orderkey", F.lit(name).alias("issue"))
    return issue(orders.join(keys, "o_orderkey", "left_anti"), "no_lines").unionByName(issue(keys.join(orders, "o_orderkey", "left_anti"), "no_order")).unionByName(issue(orders.where("o_totalprice > 400000"), "implausible"))


@query("select p_partkey, p_name, trim(p_name) = '' or contains(lower(p_name), 'part 1') or contains(lower(p_name), 'xyz') or len(string_split(lower(trim(p_name)), ' ')) >= 9 as noise from part")
def f15_noise_terms(t):
    return t.part.select("p_partkey", "p_name", filters.noise_term(F.col("p_name"), ["part 1", "xyz"]).alias("noise"))


@query("select o_orderkey, case when o_orderstatus = 'F' then 'promoted' else 'shadow' end as scope from orders where (o_orderstatus = 'F') <> (o_orderkey % 2 = 0)")
def f16_scope(t):
    return t.orders.where((F.col("o_orderstatus") == "F") != (F.col("o_orderkey") % 2 == 0)).select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "promoted").otherwise("shadow").alias("scope"))


#: The SQL of ``fn.visible`` over composed text, and of ``fn.join_hyphenation``.
VISIBLE = r"regexp_replace(regexp_replace(nfc_normalize({}), '\r\n?', chr(10), 'g'), '[\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{205F}}\x{{3000}}\t]', ' ', 'g')"
JOINED = r"regexp_replace({}, '([\p{{L}}\p{{N}}])[-‐][ \t]*\n[ \t]*([\p{{L}}\p{{N}}])', '\1\2', 'g')"


@query(f"""select doc_id, v as visible, trim(regexp_replace(regexp_replace(v, '[ \\t]+', ' ', 'g'), ' +([,.;:!?])', '\\1', 'g'), ' ') as compact from (select doc_id, {VISIBLE.format('text')} as v from documents)""")
def x01_clean_text(t):
    visible = fn.visible(fn.nfc(F.col("text")))
    return t.documents.select("doc_id", visible.alias("visible"), fn.compact(visible).alias("compact"))


@query(f"""select page_id, trim(regexp_replace(regexp_replace(j, ' +', ' ', 'g'), ' ?\\n ?', chr(10), 'g'), ' ') as text from (select page_id, {JOINED.format("regexp_replace(" + VISIBLE.format('html') + ", '<[^>]*>', ' ', 'g')")} as j from pages)""")
def x03_clean_pages(t):
    return t.pages.select("page_id", fn.clean_markup(fn.nfc(F.col("html"))).alias("text"))


@query()
def x04_clean_ocr_text(t):
    """Composition, markup, hyphenation, boilerplate and blanks, in this order."""
    cleaned = fn.compact(fn.strip_markdown(fn.strip_boilerplate(fn.clean_markup(fn.nfc(F.col("text"))), ["All rights reserved."])))
    return t.documents.select("doc_id", cleaned.alias("text"))


@query(f"""select doc_id, list_transform(regexp_extract_all(regexp_replace({JOINED.format('text')}, '<[^>]*>', ' ', 'g'), '[a-zA-ZÀ-öø-ÿ]{{3,}}'), lambda w: lower(w)) as words from documents""")
def x08_words(t):
    return t.documents.select("doc_id", fn.words(F.col("text")).alias("words"))


@query()
def x09_keyword_keys(t):
    return t.documents.select("doc_id", F.regexp_replace(fn.fold_unicode(F.col("text")), r"(^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$)", "").alias("key"))


@query(f"""select doc_id, len(list_distinct(regexp_extract_all({FOLD.format('text')}, '\\p{{L}}{{3,}}'))) as n_tokens from documents""")
def x14_comparable_tokens(t):
    return t.documents.select("doc_id", F.size(F.array_distinct(fn.letters(F.col("text")))).cast("long").alias("n_tokens"))


@query("""with w as (select doc_id, list_transform(regexp_extract_all(lower(text), '[a-z]{3,}'), lambda x: x) as w from documents)
select doc_id, case when len(w) < 5 then 0 else len(list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)])) end as n_shingles from w""")
def x16_shingle_counts(t):
    w = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))
    return t.documents.select("doc_id", w.alias("w")).select("doc_id", F.size(fn.shingles(F.col("w"), 5)).cast("long").alias("n_shingles"))




@query("""with v as (select p_partkey, (p_partkey * 19) % 3999 + 1 as value from part)
select p_partkey, value, value as back, case when value < 2000 then value end as strict,
['', 'M', 'MM', 'MMM'][value // 1000 + 1] || ['', 'C', 'CC', 'CCC', 'CD', 'D', 'DC', 'DCC', 'DCCC', 'CM'][value // 100 % 10 + 1]
|| ['', 'X', 'XX', 'XXX', 'XL', 'L', 'LX', 'LXX', 'LXXX', 'XC'][value // 10 % 10 + 1] || ['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX'][value % 10 + 1] as roman from v""")
def x17_roman_round_trip(t):
    rows = t.part.select("p_partkey", ((F.col("p_partkey") * 19) % 3999 + 1).alias("value"))
    roman = fn.to_roman(F.col("value"))
    return rows.select("p_partkey", "value", fn.roman_value(roman).alias("back"), fn.roman_strict(roman).alias("strict"), roman.alias("roman"))


@query()
def x20_declared_volumes(t):
    return t.documents.select("doc_id", fn.declared_volumes(F.col("text"), "the").alias("volumes"))


@query("""select a.c_custkey as a, b.c_custkey as b, levenshtein(a.c_name, b.c_name)::int as distance, round(1 - levenshtein(a.c_name, b.c_name) / greatest(length(a.c_name), length(b.c_name))::double, 4) as agreement
from customer a join customer b on a.c_nationkey = b.c_nationkey and a.c_mktsegment = b.c_mktsegment and a.c_custkey < b.c_custkey""")
def x21_edit_distances(t):
    """Each two names of a group are measured once in a block, whatever the number of customers that have them."""
    return similarity.edit_pairs(t.customer, ["c_nationkey", "c_mktsegment"], "c_custkey", "c_name")


@query()
def x24_scan_distances(t):
    """Each part's name against the next one's of its brand."""
    after = F.lead("p_name").over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    pairs = t.part.select("p_partkey", F.col("p_name").alias("a"), after.alias("b"))
    return pairs.select("p_partkey", F.round(fn.scan_distance(F.col("a"), F.col("b")), 6).alias("distance"), fn.differing_characters(F.col("a"), F.col("b")).alias("differing"), fn.confusion_form(F.col("a")).alias("form"))


@query("""select p_partkey, case when len(string_split(p_type, ' ')) = 1 then case when length(p_type) >= 9 then 0.78 when length(p_type) >= 7 then 0.82 end else case when length(p_type) >= 40 then 0.78 when length(p_type) >= 20 then 0.84 when length(p_type) >= 12 then 0.9 end end::double as least from part""")
def x28_fuzzy_thresholds(t):
    return t.part.select("p_partkey", fn.least_similarity(F.col("p_type")).alias("least"))


@query(f"""with h as (select doc_id, text as h from documents)
select doc_id, upper(regexp_replace({FOLD.format('h')}, '[^a-z0-9]+', '', 'g')) as key, coalesce(nullif(trim(regexp_replace({FOLD.format('h')}, '[^a-z0-9]+', '-', 'g'), '-'), ''), 'item') as slug, trim(regexp_replace(regexp_replace(lower(h), '[0-9]+', '#', 'g'), '[^a-z0-9#]+', ' ', 'g')) as fingerprint,
case when length(h) > 40 then regexp_replace(h[1:40], '[\\s.,;:]+$', '') || '…' else h end as excerpt from h""")
def x29_keys_and_slugs(t):
    h = F.col("text")
    return t.documents.select("doc_id", fn.key_form(h).alias("key"), fn.slug(h).alias("slug"), fn.header_fingerprint(h).alias("fingerprint"), fn.excerpt(h, 40).alias("excerpt"))


@query("""with h as (select doc_id, trim(string_split(text, chr(10))[1]) as h from documents)
select doc_id, regexp_matches(lower(h), '^(the|der|el|la)([^\\p{L}]|$)') or (length(h) <= 80 and len(regexp_extract_all(h, '\\p{L}')) > 0 and len(regexp_extract_all(h, '\\p{Lu}')) > 0.7 * len(regexp_extract_all(h, '\\p{L}'))) as heading from h""")
def x32_headings(t):
    return t.documents.select("doc_id", fn.is_heading(F.col("text"), ["the", "der", "el", "la"]).alias("heading"))


@query("""select doc_id, len(regexp_extract_all(text, '[A-Za-zÀ-ÖØ-öø-ÿĀ-ſ]'))::int as latin, len(regexp_extract_all(text, '[Ͱ-Ͽ]'))::int as greek, case when regexp_matches(text, '[A-Za-zÀ-ÖØ-öø-ÿĀ-ſ]') then 'lat' else 'und' end as language from documents""")
def x38_scripts(t):
    counts = fn.script_counts(F.col("text"))
    return t.documents.select("doc_id", counts["latin"].alias("latin"), counts["greek"].alias("greek"), fn.guess_language(F.col("text"), F.lit("")).alias("language"))


@query()
def x37_inferred_scripts(t):
    found = fn.infer_script(F.col("text"), F.lit("latin"))
    return t.documents.select("doc_id", found.alias("s"), fn.text_class(F.col("text"), F.lit(None)).alias("class"), fn.script_flags(F.col("text")).alias("flags")).select("doc_id", "s.*", "class", "flags")


@query("""with s as (select doc_id, lower(text[1:4000]) as s from documents) select doc_id, array_to_string(list_filter([case when regexp_matches(s, 'licen[sc]e') then 'legal' end, case when regexp_matches(s, '[|]') then 'table' end, case when regexp_matches(s, '^[^a-z]*index') then 'index' end, case when regexp_matches(s, '[0-9]{4,}') then 'numbers' end], lambda x: x is not null), ',') as kinds from s""")
def x42_page_kinds(t):
    patterns = {"legal": "licen[sc]e", "table": "[|]", "index": "^[^a-z]*index", "numbers": "[0-9]{4,}"}
    return t.documents.select("doc_id", F.array_join(fn.kinds(F.col("text"), patterns), ",").alias("kinds"))


@query("""with f as (select doc_id, length(text) as n, len(regexp_extract_all(text, '\\p{L}')) / length(text)::double as share, len(regexp_extract_all(text, '[0-9]')) / length(text)::double as digits, contains(text, '|') as tab from documents)
select doc_id, (case when n < 100 then 3 else 0 end + case when share < 0.6 then 2 else 0 end + case when digits > 0.1 then 2 else 0 end + case when tab then 1 else 0 end)::int as score,
array_to_string(list_filter([case when n < 100 then 'short' end, case when share < 0.6 then 'few_letters' end, case when digits > 0.1 then 'digits' end, case when tab then 'table' end], lambda x: x is not null), ',') as reasons from f""")
def x43_quality_score(t):
    text = F.col("text")
    rules = [("short", F.length(text) < 100, 3), ("few_letters", numbers.letter_share(text) < 0.6, 2), ("digits", F.regexp_count(text, F.lit("[0-9]")) / F.length(text) > 0.1, 2), ("table", F.contains(text, F.lit("|")), 1)]
    score = sum((F.when(c, w).otherwise(0) for _, c, w in rules), F.lit(0))
    return t.documents.select("doc_id", score.alias("score"), F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c, _ in rules])), ",").alias("reasons"))


@query("""select p_partkey, case when contains(trim(regexp_replace(p_type, '[\\s/,;.\\-]+', '_', 'g'), '_'), '_') then trim(regexp_replace(p_type, '[\\s/,;.\\-]+', '_', 'g'), '_') end as literal, array_to_string(list_filter([trim(p_name), case when trim(p_type) <> trim(p_name) then trim(p_type) end, case when trim(p_brand) not in (trim(p_name), trim(p_type)) then trim(p_brand) end], lambda x: x <> ''), ' ') as record from part""")
def x50_search_records(t):
    return t.part.select("p_partkey", fn.literal(F.col("p_type")).alias("literal"), fn.record_text(F.col("p_name"), F.col("p_type"), F.col("p_brand")).alias("record"))


@query("""with w as (select p_partkey, string_split(p_name || ' ' || p_type || ' ' || upper(p_name), ' ') as a from part) select p_partkey, list_filter(a, lambda x, i: list_position(list_transform(a, lambda y: lower(y)), lower(x)) = i) as words from w""")
def x55_dedupe_words(t):
    return t.part.select("p_partkey", fn.dedupe(F.split(F.concat_ws(" ", "p_name", "p_type", F.upper("p_name")), " ")).alias("words"))


@query("select doc_id, case when length(text) > 2000 then right(text, 2000) else text end as context from documents")
def x56_token_budget(t):
    return t.documents.select("doc_id", fn.budget(F.col("text"), 500).alias("context"))


@query("select doc_id, regexp_matches(text, '[|%$*&]') as banned from documents")
def x59_banned_characters(t):
    return t.documents.select("doc_id", fn.has_any_character(F.col("text"), list("|%$*&")).alias("banned"))


@query()
def x58_sane_marks(t):
    return t.documents.select("doc_id", fn.sane_marks(F.col("text")).alias("sane"))


@query("""with c as (select doc_id, length(text) as n, unnest(string_split(text, '')) as ch from documents), g as (select doc_id, any_value(n) as n, ch, count(*) as k from c group by doc_id, ch)
select doc_id, round(log2(any_value(n)::double) - sum(k * log2(k::double)) / any_value(n), 6) as entropy from g group by 1""")
def m01_entropy(t):
    return t.documents.select("doc_id", r6(numbers.entropy(F.col("text"))).alias("entropy"))


@query()
def m02_compression(t):
    return t.documents.select("doc_id", r6(numbers.compression(F.col("text"))).alias("ratio"))


@query("select doc_id, round(len(regexp_extract_all(text, '\\p{L}')) / length(text)::double, 6) as share from documents")
def m03_letter_share(t):
    return t.documents.select("doc_id", r6(numbers.letter_share(F.col("text"))).alias("share"))


@query("""select a.vec_id as a, b.vec_id as b, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 5) as cosine from embeddings a join embeddings b on b.vec_id = a.vec_id + 1""")
def m07_neighbour_cosine(t):
    right = t.embeddings.select((F.col("vec_id") - 1).alias("a"), F.col("vec_id").alias("b"), F.col("embedding").alias("f"))
    pairs = t.embeddings.select(F.col("vec_id").alias("a"), "embedding").join(right, "a")
    return pairs.select("a", "b", F.round(numbers.cosine(F.col("embedding"), F.col("f")), 5).alias("cosine"))


@query("""with w as (select item_id, list_filter(string_split_regex(lower(text), '\\s+'), lambda x: length(x) > 2) as ws from benchmark)
select item_id, doc_id, round(case when len(ws) > 0 then len(list_filter(ws, lambda x: contains(lower(text), x))) / len(ws)::double else 0 end, 6) as overlap from w join documents on doc_id = item_id""")
def m08_lexical_overlap(t):
    pairs = t.benchmark.select("item_id", F.col("text").alias("q")).join(t.documents, F.col("doc_id") == F.col("item_id"))
    return pairs.select("item_id", "doc_id", r6(numbers.lexical_overlap(F.col("q"), F.col("text"))).alias("overlap"))


@query("""select l_orderkey, l_linenumber, round(case when greatest(l_quantity, l_suppkey) > 0 then abs(l_quantity - l_suppkey) / greatest(l_quantity, l_suppkey) else 0 end, 6) as discrepance from lineitem""")
def m10_discrepance(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", r6(numbers.discrepance(F.col("l_quantity"), F.col("l_suppkey"))).alias("discrepance"))


@query("""select doc_id, sha256(text) as digest, sha256(strlen(source) || ':' || source || strlen(lang) || ':' || lang) as framed, sha256('7:' || doc_id)[1:16] as draw from documents""")
def m11_digests(t):
    return t.documents.select("doc_id", numbers.text_digest(F.col("text")).alias("digest"), numbers.framed_digest(F.col("source"), F.col("lang")).alias("framed"), numbers.draw("7", F.col("doc_id")).alias("draw"))


@query("""select l_orderkey, l_linenumber, (case when v >= 0 then 2 * v else -2 * v - 1 end)::int as zigzag, case when u < 128 then printf('%02X', u) when u < 16384 then printf('%02X%02X', (u % 128 + 128)::int, (u // 128)::int) else printf('%02X%02X%02X', (u % 128 + 128)::int, ((u // 128) % 128 + 128)::int, (u // 16384)::int) end as varuint
from (select l_orderkey, l_linenumber, (l_suppkey - l_quantity)::int as v, l_partkey as u from lineitem)""")
def m14_encodings(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", numbers.zigzag((F.col("l_suppkey") - F.col("l_quantity")).cast("int")).alias("zigzag"), numbers.varuint(F.col("l_partkey")).alias("varuint"))


@query("""select o_orderkey, strftime(p, '%Y-%m-%d') as day, epoch(p)::bigint as seconds from (select o_orderkey, case o_orderkey % 3 when 0 then date_trunc('day', o_orderdate) when 1 then o_orderdate else o_orderdate - interval 2 hour end as p from orders)""")
def m16_parsed_times(t):
    """A date, a time with Z and one with an offset, each through the parser."""
    form, time = F.col("o_orderkey") % 3, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(form == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(form == 1, F.concat(time, F.lit("Z"))).otherwise(F.concat(time, F.lit("+02:00")))
    parsed = t.orders.select("o_orderkey", numbers.to_utc(text).alias("p"))
    return parsed.select("o_orderkey", F.date_format("p", "yyyy-MM-dd").alias("day"), F.col("p").cast("long").alias("seconds"))


@query("select event_id, cast(props->>'$.k' as int) as k, case when cast(props->>'$.k' as int) > 50 then 'high' else 'low' end as level from events")
def n03_json_numbers(t):
    (k,) = nested.json_numbers(F.col("props"), "k")
    return t.events.select("event_id", k).withColumn("level", F.when(F.col("k") > 50, "high").otherwise("low"))


JSON_ITEMS = """select user_id, event_id, (i - 1)::int as pos, items[i] as item from (select user_id, event_id, items, unnest(range(1, len(items) + 1)) as i from (select user_id, event_id, [event_type, cast(props->>'$.k' as varchar)] as items from events))"""


@query(JSON_ITEMS)
def n01_json_positions(t):
    k = F.get_json_object("props", "$.k")
    doc = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(F.array("event_type", k).alias("keywords_ranking")))).otherwise(F.to_json(F.array("event_type", k)))
    return t.events.select("user_id", "event_id", F.posexplode(nested.json_items(doc, "keywords_ranking", "keywords")).alias("pos", "item"))


@query("select event_id, event_type in ('purchase', 'click') as found from events")
def n04_any_kind(t):
    evidence = F.to_json(F.array(F.struct(F.lit("none").alias("kind")), F.struct(F.col("event_type").alias("kind"))))
    return t.events.select("event_id", nested.any_kind(evidence, ["purchase", "click"]).alias("found"))


@query()
def n05_embedded_json(t):
    """The object in an answer with words around it."""
    answer = F.concat(F.lit("Sure: {not json} "), F.col("props"), F.lit(" - done"))
    return t.events.select("event_id", nested.json_object(answer).alias("object"))


@query("""with m as (select *, case event_type when 'view' then 'seen' when 'click' then 'pressed' end as fixed from events)
select event_id, '{"kind": "' || coalesce(fixed, ' ' || event_type) || '", "notes": ["a ' || coalesce(fixed, upper(event_type[1]) || event_type[2:]) || ', not a re' || event_type || ' of ' || user_id || '"]}' as replaced from m""")
def x52_replaced_strings(t):
    """Strings of JSON texts replaced as a whole or at whole words."""
    note = F.concat(F.lit("a "), F.initcap("event_type"), F.lit(", not a re"), "event_type", F.lit(" of "), F.col("user_id").cast("string"))
    text = F.to_json(F.struct(F.concat(F.lit(" "), "event_type").alias("kind"), F.array(note).alias("notes")))
    return t.events.select("event_id", nested.replace_strings(text, {"view ": "seen", "Click": "pressed"}).alias("replaced"))


@query("""select event_id, list_transform(range((event_id % 9 + 1)::bigint, (event_id % 9 + 4)::bigint), lambda x: x::int) || [(event_id % 9 + 7)::int] as verses from events""")
def n06_expanded_ranges(t):
    a = F.col("event_id") % 9
    return t.events.select("event_id", nested.expand_range(F.concat((a + 1).cast("string"), F.lit("-"), (a + 3).cast("string"), F.lit(", "), (a + 7).cast("string"))).alias("verses"))


@query("select l_orderkey, string_agg(cast(l_partkey as varchar), ',' order by l_linenumber, l_partkey) as labels from lineitem group by 1")
def n07_page_labels(t):
    ordered = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey")))
    return t.lineitem.groupBy("l_orderkey").agg(F.array_join(F.transform(ordered, lambda x: x["l_partkey"].cast("string")), ",").alias("labels"))


@query("select event_id, cast(props->>'$.k' as varchar) as k from events")
def n08_registered_function(t):
    nested.register(t.spark)
    t.events.createOrReplaceTempView("quarry_events")
    return t.spark.sql("select event_id, get_json_object(decode_json(props), '$.k') as k from quarry_events")
