"""Queries of readers and writers over the given tables (S, K rows); files themselves are covered by tests."""

from pyspark.sql import functions as F

from ..sources import readers, writers
from .registry import query


def candidates(t):
    """Documents as files of a source's pages; some with a canonical name, some with another, some pages with both."""
    page = (F.col("doc_id") / 40).cast("int")
    canonical = F.concat("source", F.lit("-"), F.lpad(page.cast("string"), 3, "0"))
    other = F.concat(F.lit("scan"), F.col("doc_id").cast("string"), F.lit("-"), page.cast("string"))
    return t.documents.select(F.col("source").alias("volume"), page.alias("page_num"), F.when(F.col("doc_id") % 3 == 0, canonical).otherwise(other).alias("stem"), "doc_id")


CANDIDATES = """c as (select source as volume, (doc_id // 40)::int as page_num, case when doc_id % 3 = 0 then source || '-' || lpad((doc_id // 40)::varchar, 3, '0') else 'scan' || doc_id || '-' || (doc_id // 40) end as stem, doc_id % 3 = 0 as canon from documents)"""


@query(f"""with {CANDIDATES}, g as (select volume, page_num, min(case when canon then stem end) as c, sum(canon::int) as n, count(*) as k, min(stem) as o from c group by 1, 2)
select volume, page_num, case when n = 1 then c when k = 1 then o end as chosen, (case when n = 1 then c when k = 1 then o end) is null as ambiguous from g""")
def s02_chosen_pages(t):
    return readers.chosen_pages(candidates(t))


@query(f"""with {CANDIDATES}, g as (select volume, page_num from c group by 1, 2 having sum(canon::int) = 1 or count(*) = 1) select volume, page_num, coalesce(min(case when canon then stem end), min(stem)) as chosen, false as ambiguous from c semi join g using (volume, page_num) group by 1, 2""")
def s03_unique_pages(t):
    settled = readers.chosen_pages(candidates(t)).where(~F.col("ambiguous")).select("volume", "page_num")
    return readers.unique_pages(candidates(t).join(settled, ["volume", "page_num"], "left_semi"))


@query("select p_partkey, case p_size % 3 when 0 then 'PG' when 1 then 'PL' else 'PO' end as series, p_size as number, case when p_partkey % 2 = 0 then 'b' else '' end as suffix from part")
def s06_volume_parts(t):
    series = F.element_at(F.array(F.lit("PG"), F.lit("PL"), F.lit("PO")), F.col("p_size") % 3 + 1)
    name = F.concat(series, F.lpad(F.col("p_size").cast("string"), 3, "0"), F.when(F.col("p_partkey") % 2 == 0, "b").otherwise(""))
    return t.part.select("p_partkey", readers.volume_parts(name).alias("v")).select("p_partkey", "v.*")


@query("""select doc_id, lang as type, case when doc_id % 4 = 0 then 'plain' when contains(split_part(text, chr(10), 1), '&') then 'repaired' else 'xml' end as how from documents""")
def s07_page_xml(t):
    line = F.translate(F.split("text", "\n")[0], "<>", "  ")
    xml = F.concat(F.lit('<pagina estado="ok" tipo="'), "lang", F.lit('"><bloco tipo="texto" script="latino">'), line, F.lit("</bloco></pagina>"))
    raw = F.when(F.col("doc_id") % 4 == 0, line).otherwise(xml)
    return t.documents.select("doc_id", "lang", readers.page_xml(raw).alias("p")).select("doc_id", F.coalesce("p.type", "lang").alias("type"), "p.how")


@query("select page_id, len(regexp_extract_all(html, '(?s)<p\\b[^>]*>(.*?)</p>'))::int as n_blocks from pages")
def s08_pattern_blocks(t):
    xml = F.regexp_replace(F.regexp_replace("html", "(?i)<p\\b[^>]*>", "<bloco>"), "(?i)</p>", "</bloco>")
    return t.pages.select("page_id", F.size(readers.blocks_by_pattern(xml)).alias("n_blocks"))


@query()
def s09_page_texts(t):
    xml = F.concat(F.lit('<pagina estado="ok"><bloco tipo="texto">'), F.translate(F.col("text"), "<>&", "   "), F.lit('</bloco><bloco script="grego">λόγος</bloco></pagina>'))
    return t.documents.select("doc_id", readers.page_text(readers.page_xml(xml)).alias("t")).select("doc_id", F.sha2("t.text", 256).alias("digest"), "t.non_latin_only")


@query("""with tr as (select o_custkey % 1500 + 1 as g, case o_orderpriority when '1-URGENT' then 'en' when '2-HIGH' then 'fr' else 'it' end as locale, o_orderkey as id, o_orderstatus as text from orders where o_orderstatus <> 'P')
select c_custkey as page_id, case when c_custkey % 3 = 0 then c_name else c_mktsegment end as summary, max_by(text, id) filter (locale = 'en' and c_custkey % 3 = 0) as en, max_by(text, id) filter (locale = 'fr' and c_custkey % 3 = 0) as fr, max_by(text, id) filter (locale = 'it' and c_custkey % 3 = 0) as it
from customer left join tr on g = c_custkey group by c_custkey, c_name, c_mktsegment""")
def s11_with_translations(t):
    legacy = t.customer.select(F.col("c_custkey").alias("page_id"), F.col("c_mktsegment").alias("summary"))
    generations = t.customer.select(F.col("c_custkey").alias("page_id"), F.col("c_custkey").alias("generation_id"), F.col("c_name").alias("summary"), (F.col("c_custkey") % 3 == 0).alias("is_current"))
    locale = F.when(F.col("o_orderpriority") == "1-URGENT", "en").when(F.col("o_orderpriority") == "2-HIGH", "fr").otherwise("it")
    status = F.when(F.col("o_orderstatus") == "P", "running").otherwise("completed")
    translations = t.orders.select((F.col("o_custkey") % 1500 + 1).alias("generation_id"), locale.alias("locale"), F.col("o_orderkey").alias("id"), status.alias("status"), F.col("o_orderstatus").alias("text"))
    return readers.with_translations(legacy, generations, translations, ["en", "fr", "it"]).select("page_id", "summary", "en", "fr", "it")


@query("select vec_id, round(list_sum(embedding::double[]), 4) as total from embeddings")
def s12_unpacked_embeddings(t):
    from pyspark.sql.types import BinaryType

    import pandas as pd

    @F.pandas_udf(BinaryType())
    def packed(v: pd.Series) -> pd.Series:
        import numpy as np

        return v.map(lambda x: np.asarray(x, "<f4").tobytes())

    blobs = t.embeddings.select("vec_id", packed("embedding").alias("blob"), F.size("embedding").alias("dim"))
    vectors = readers.embeddings(blobs, "vec_id", "blob", "dim")
    return vectors.select("vec_id", F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("total"))


@query("""with w as (select l_orderkey as page, l_suppkey % 3 as block, l_linenumber as line, string_agg(l_returnflag || l_linestatus, ' ' order by l_partkey, l_returnflag || l_linestatus) as t, min(l_quantity::int) as x1, min(l_partkey % 90) as y1, max(l_quantity::int + 10) as x2, max(l_partkey % 90 + 12) as y2 from lineitem group by 1, 2, 3)
select page, block, min(x1) || ',' || min(y1) || ',' || max(x2) || ',' || max(y2) as bbox, string_agg(t, chr(10) order by line, t) as text from w group by 1, 2""")
def s15_word_blocks(t):
    words = t.lineitem.select(F.col("l_orderkey").alias("page"), (F.col("l_suppkey") % 3).alias("block"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("word"), F.col("l_quantity").cast("int").alias("left"), (F.col("l_partkey") % 90).alias("top"), F.lit(10).alias("width"), F.lit(12).alias("height"), F.concat("l_returnflag", "l_linestatus").alias("text"))
    return readers.word_blocks(words, ["page"])


@query("select l_partkey, l_orderkey, l_linenumber, sum(l_suppkey) over (partition by l_partkey order by l_orderkey, l_linenumber, l_suppkey rows unbounded preceding)::bigint as page from lineitem")
def s17_running_sums(t):
    from pyspark.sql import Window

    # Lines of one order and number may repeat; the sum then counts row by row.
    per = Window.partitionBy("l_partkey").orderBy("l_orderkey", "l_linenumber", "l_suppkey").rowsBetween(Window.unboundedPreceding, 0)
    return t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", F.sum("l_suppkey").over(per).alias("page"))


@query("""with p as (select *, (row_number() over (partition by source order by doc_id) - 1) // 20 as block from documents) select source, block::int as block, min(doc_id) as first, max(doc_id) as last, count(*) as n, string_agg(doc_id::varchar, ',' order by doc_id) as items from p group by 1, 2""")
def k03_paged_blocks(t):
    return writers.paged(t.documents, ["source"], ["doc_id"], 20, F.col("doc_id").cast("string")).withColumn("items", F.array_join("items", ","))


@query("select source, (doc_id // 100)::int as block from documents where doc_id // 100 > 7 group by 1, 2")
def k04_stale_blocks(t):
    rows = t.documents.select("source", F.floor(F.col("doc_id") / 100).cast("int").alias("block")).distinct()
    return writers.stale_blocks(rows, rows.where("block <= 7"), ["source", "block"])


@query()
def k05_shard_digests(t):
    return writers.shard_digests(t.documents, "source", ["doc_id"])


@query("""with recursive o as (select source, doc_id, n_chars, row_number() over (partition by source order by doc_id) as i from documents), r as (select source, doc_id, i, n_chars as held, 0 as shard from o where i = 1
union all select o.source, o.doc_id, o.i, case when r.held > 0 and r.held + o.n_chars > 20000 then o.n_chars else r.held + o.n_chars end, case when r.held > 0 and r.held + o.n_chars > 20000 then r.shard + 1 else r.shard end from r join o on o.source = r.source and o.i = r.i + 1) select source, doc_id, shard from r""")
def k06_balanced_shards(t):
    return writers.balanced(t.documents.select("source", "doc_id", "n_chars"), "source", "doc_id", "n_chars", 20000).select("source", "doc_id", "shard")


@query("""with p as (select p_brand, (row_number() over (partition by p_brand order by p_name, p_partkey) - 1) // 15 as block, p_name, p_partkey from part), b as (select p_brand, block::int as block, min_by(p_name, (p_name, p_partkey)) as first, max_by(p_name, (p_name, p_partkey)) as last, count(*) as n from p group by 1, 2)
select *, lag(block) over (partition by p_brand order by block) as previous, lead(block) over (partition by p_brand order by block) as next from b""")
def k07_linked_pages(t):
    pages = writers.paged(t.part, ["p_brand"], ["p_name", "p_partkey"], 15, F.col("p_name")).drop("items")
    return writers.linked(pages, "p_brand", "block")


@query("""with n as (select p_brand, (row_number() over (order by p_brand) - 1)::int as volume_no from (select distinct p_brand from part)) select p_partkey, volume_no, coalesce(nullif(trim(case when p_size % 2 = 0 then p_name else ' ' end), ''), p_type) as shown from part join n using (p_brand)""")
def k09_coded_volumes(t):
    rows = t.part.withColumn("title", F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(" "))
    return writers.coded_volumes(rows, "p_brand", "title", "p_type").select("p_partkey", "volume_no", "shown")


@query()
def k10_side_files(t):
    rows = t.lineitem.select(F.col("l_linenumber").alias("book"), F.col("l_suppkey").cast("string").alias("volume"), F.col("l_partkey").alias("page"), F.col("l_orderkey").alias("doc"))
    return writers.side_files(rows, "book", "volume", "page", "doc").select("book", "n", F.sha2("payload", 256).alias("digest"))


@query("select user_id, string_agg('=== ' || event_id || ' ===' || chr(10) || event_type, chr(10) order by event_id) as text from events group by 1")
def k11_concatenated(t):
    return writers.concatenated(t.events, "user_id", "event_id", "event_type", headers=True)


@query("select o_orderkey, case when o_orderkey % 10 = 1 then 'new' else o_orderstatus end as o_orderstatus from orders union all select -o_orderkey, 'new' from orders where o_orderkey % 100 = 1")
def k14_upserted(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    fresh = t.orders.where("o_orderkey % 10 = 1").select("o_orderkey", F.lit("new").alias("o_orderstatus")).unionByName(t.orders.where("o_orderkey % 100 = 1").select((-F.col("o_orderkey")).alias("o_orderkey"), F.lit("new").alias("o_orderstatus")))
    return writers.upserted(rows, fresh, ["o_orderkey"])


HISTORY = """h as (select o_custkey as page, o_orderpriority || o_orderstatus as hash, o_orderkey as id from orders where o_orderkey % 2 = 0), n as (select o_custkey as page, o_orderpriority || o_orderstatus as hash, min(o_orderkey) + 1000000 as id from orders where o_orderkey % 2 = 1 group by 1, 2),
f as (select n.* from n where not exists (select 1 from h where h.page = n.page and h.hash = n.hash)), e as (select * from h union all select * from f)"""


@query(f"with {HISTORY} select page, hash, id, row_number() over (partition by page order by id desc) = 1 as is_current from e")
def k16_appended_versions(t):
    hashed = t.orders.select(F.col("o_custkey").alias("page"), F.concat("o_orderpriority", "o_orderstatus").alias("hash"), F.col("o_orderkey").alias("id"))
    history = hashed.where("id % 2 = 0").withColumn("is_current", F.lit(False))
    new = hashed.where("id % 2 = 1").groupBy("page", "hash").agg((F.min("id") + 1000000).alias("id"))
    return writers.appended(history, new, ["page"], ["hash"], ["id"])


@query(f"with {HISTORY}, c as (select *, row_number() over (partition by page order by id desc) = 1 as cur from h), k as (select page, id as chosen from h where id = (select min(id) from h)) select h2.page, hash, id, case when k.page is not null then id = chosen else cur end as is_current from c h2 left join k on k.page = h2.page")
def k17_reverted(t):
    history = t.orders.where("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("page"), F.concat("o_orderpriority", "o_orderstatus").alias("hash"), F.col("o_orderkey").alias("id"))
    current = writers.appended(history.withColumn("is_current", F.lit(False)), history.limit(0), ["page"], ["hash"], ["id"])
    return writers.reverted(current, ["page"], "id", history.agg(F.min("id")).first()[0])
