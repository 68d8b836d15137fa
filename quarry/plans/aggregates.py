"""Aggregate queries."""

from pyspark.sql import functions as F

from ..operators import aggregates as ops
from .registry import query

r6 = lambda c: F.round(c, 6)


@query("""with p as (select distinct source, doc_id from documents), n as (select source, doc_id, lead(doc_id) over (partition by source order by doc_id) as nx from p)
select source, unnest(range(doc_id + 1, nx)) as missing from n where nx > doc_id + 1""")
def a01_missing_pages(t):
    return ops.missing_pages(t.documents, "source", "doc_id")


@query("""with p as (select distinct source, doc_id from documents), n as (select source, doc_id, lead(doc_id) over (partition by source order by doc_id) as nx from p)
select source, doc_id + 1 as first_missing, nx - 1 as last_missing, nx - doc_id - 1 as n_missing,
       case when doc_id + 1 = nx - 1 then cast(doc_id + 1 as varchar) else (doc_id + 1) || '-' || (nx - 1) end as label from n where nx > doc_id + 1""")
def a01_gap_ranges(t):
    return ops.missing_ranges(t.documents, "source", "doc_id")


@query("""select source, min(doc_id) as first_page, max(doc_id) as last_page, count(*) as n_rows, max(doc_id) - min(doc_id) + 1 - count(*) as n_gap
from documents group by source having max(doc_id) - min(doc_id) + 1 - count(*) > 0""")
def a02_documents_with_gaps(t):
    return ops.documents_with_gaps(t.documents, "source", "doc_id")


@query("select l_partkey, round(sum(1.0 / (60.0 + l_linenumber)), 6) as score, count(*) as n_occurrences from lineitem group by l_partkey")
def a03_keyword_rank_score(t):
    return ops.rank_score(t.lineitem, "l_partkey", "l_linenumber").withColumn("score", r6("score"))


@query("""select p_brand, round(sum(s), 5) as mass from (select l_partkey, sum(1.0::double / (60 + l_linenumber)) as s from lineitem group by 1) join part on l_partkey = p_partkey group by 1""")
def a04_group_mass(t):
    scores = ops.rank_score(t.lineitem, "l_partkey", "l_linenumber").withColumnRenamed("l_partkey", "p_partkey")
    return ops.group_mass(scores, t.part, "p_partkey", "p_brand").withColumn("mass", F.round("mass", 5))


@query("select p_brand, count(distinct l_orderkey) as n_pages from lineitem join part on l_partkey = p_partkey group by 1")
def a05_group_distinct_pages(t):
    return ops.distinct_pages(t.lineitem.withColumnRenamed("l_partkey", "p_partkey"), t.part, "p_partkey", "p_brand", "l_orderkey")


@query("""with c as (select p_brand, p_partkey, count(*) as n from lineitem join part on l_partkey = p_partkey group by all having count(*) >= 3),
r as (select *, row_number() over (partition by p_brand order by n desc, p_partkey) as rk, sum(n) over (partition by p_brand) as tot from c)
select p_brand, tot::bigint as group_total, string_agg(cast(p_partkey as varchar), ',' order by rk) as members from r where rk <= 5 group by 1, 2""")
def a06_top_members(t):
    counts = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", "p_partkey").agg(F.count("*").alias("n"))
    return ops.top_members(counts, "p_brand", "p_partkey", "n", 5, 3)


@query("""with c as (select p_brand, p_partkey, p_name, p_size / 50.0::double as prob, count(l_orderkey) as pages from part left join lineitem on l_partkey = p_partkey group by all),
s as (select *, ln(1 + pages) + 1.5 * prob - 0.12 * len(string_split(p_name, ' ')) - 0.01 * length(p_name) as score from c)
select p_brand, p_partkey as keyword_id, p_name as label, pages as page_count, round(score, 6) as score
from s qualify row_number() over (partition by p_brand order by score desc, pages desc, p_partkey) = 1""")
def a07_canonical_names(t):
    rows = t.part.join(t.lineitem, F.col("l_partkey") == F.col("p_partkey"), "left").groupBy("p_brand", "p_partkey", "p_name", "p_size").agg(F.count("l_orderkey").alias("pages"))
    rows = rows.withColumn("score", ops.label_score(F.col("pages"), F.col("p_size") / 50.0, F.col("p_name")))
    value = {"keyword_id": F.col("p_partkey"), "label": F.col("p_name"), "page_count": F.col("pages"), "score": r6("score")}
    return ops.argmax(rows, "p_brand", [F.col("score"), F.col("pages"), -F.col("p_partkey")], value)


@query("""select o_orderpriority, count(*) as n_versions, sum(case when o_orderstatus = 'F' then 1 else 0 end)::bigint as n_current, count(distinct o_custkey) as n_pages from orders group by 1""")
def a08_engine_stats(t):
    return t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n_versions"), F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("n_current"), F.countDistinct("o_custkey").alias("n_pages"))


@query("select o_custkey, count(*) as n_versions from orders group by 1 having count(*) > 1 order by 2 desc, 1 limit 10")
def a08_most_versions(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n_versions")).where("n_versions > 1").orderBy(F.desc("n_versions"), "o_custkey").limit(10)


@query("""select l_partkey, l_suppkey, bit_or(case l_returnflag when 'A' then 1 when 'N' then 2 else 4 end)::bigint as mask, count(*) as n_mentions from lineitem group by 1, 2""")
def a09_origin_masks(t):
    bit = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(4).cast("long")
    return ops.origin_masks(t.lineitem, ["l_partkey", "l_suppkey"], bit)


@query("""select term, count(*) as df from (select doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]{3,}'))) as term from documents) group by 1""")
def a10_document_frequency(t):
    return ops.frequencies(t.documents.select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0)).alias("terms")), "doc_id", "terms")


@query("""with w as (select doc_id, regexp_extract_all(lower(text), '[a-z]{3,}') as w from documents),
s as (select doc_id, unnest(list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)])) as term from w where len(w) >= 4)
select term, count(*) as df from s group by 1""")
def a10_shingle_frequency(t):
    from ..functions.text import shingles

    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))
    return ops.frequencies(t.documents.select("doc_id", words.alias("w")).select("doc_id", shingles(F.col("w"), 4).alias("terms")), "doc_id", "terms")


@query("""select word, count(*) as n from (select unnest(regexp_extract_all(translate(lower(text), 'áàâäãéèêëíìîïóòôöõúùûüçñ', 'aaaaaeeeeiiiiooooouuuucn'), '[a-z]+')) as word from documents) group by 1""")
def a11_word_counts(t):
    from ..functions.text import fold_latin

    words = F.regexp_extract_all(fold_latin(F.col("text")), F.lit("[a-z]+"), F.lit(0))
    return t.documents.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


@query("""select 'lang' as dimension, lang as value, count(*) as n from documents group by 2 union all select 'source', source, count(*) from documents group by 2
union all select 'size_class', cast(floor(n_chars / 1000)::bigint as varchar), count(*) from documents group by 2""")
def a12_profile(t):
    return ops.profile(t.documents.withColumn("size_class", F.floor(F.col("n_chars") / 1000)), ["lang", "source", "size_class"])


@query("""select o_orderstatus, o_orderpriority, grouping(o_orderstatus)::int as g_status, grouping(o_orderpriority)::int as g_priority, count(*) as n, count(distinct o_custkey) as n_customers
from orders group by grouping sets ((o_orderstatus, o_orderpriority), (o_orderstatus), (o_orderpriority), ())""")
def a13_distributions(t):
    sets = [["o_orderstatus", "o_orderpriority"], ["o_orderstatus"], ["o_orderpriority"], []]
    return t.orders.groupingSets(sets, "o_orderstatus", "o_orderpriority").agg(
        F.grouping("o_orderstatus").cast("int").alias("g_status"), F.grouping("o_orderpriority").cast("int").alias("g_priority"), F.count("*").alias("n"), F.countDistinct("o_custkey").alias("n_customers")
    )


@query("select source, sum(n - 1)::bigint as surplus from (select source, text, lang, count(*) as n from documents group by all having count(*) > 1) group by 1")
def a14_duplicate_surplus(t):
    return ops.duplicate_surplus(t.documents.select("source", "lang", F.sha2("text", 256).alias("digest")), "source", ["lang", "digest"])


@query("select o_custkey, count(distinct o_orderpriority) as n_members from orders group by 1 having count(distinct o_orderpriority) between 1 and 4")
def a15_partial_sets(t):
    return ops.partial_sets(t.orders, "o_custkey", "o_orderpriority", 5)


@query("select count(*) as n_without from customer where not exists (select 1 from orders where o_custkey = c_custkey)")
def a15_without_any(t):
    return t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left_anti").agg(F.count("*").alias("n_without"))


@query("""select c_mktsegment, count(*) as total, sum(case when n > 0 then 1 else 0 end)::bigint as n_covered, round(sum(case when n > 0 then 1 else 0 end) / count(*)::double, 4) as ratio
from (select c_custkey, c_mktsegment, count(o_orderkey) as n from customer left join orders on o_custkey = c_custkey group by 1, 2) group by 1""")
def a16_coverage(t):
    rows = t.customer.join(t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n")), "c_custkey", "left")
    return ops.coverage(rows, "c_mktsegment", F.col("n") > 0)


@query("select user_id, count(*) as n, min(event_id) as first_page, max(event_id) as last_page, max(ts) as last_ts from events group by 1")
def a17_document_listing(t):
    return t.events.groupBy("user_id").agg(F.count("*").alias("n"), F.min("event_id").alias("first_page"), F.max("event_id").alias("last_page"), F.max("ts").alias("last_ts"))


@query("select l_orderkey, min(l_partkey) as target from lineitem group by 1 having count(*) = 1")
def a18_single_links(t):
    return ops.single_links(t.lineitem, "l_orderkey", "l_partkey")


@query("""with p as (select p_brand, quantile_cont(p_retailprice, 0.8) as p80, max_by(p_name, (p_retailprice, -p_partkey)) as label from part group by 1)
select p_brand, label, round(p80, 6) as p80, sum(case when p_retailprice >= p80 then 1 else 0 end)::bigint as n_relevant, sum(case when p_retailprice < p80 then 1 else 0 end)::bigint as n_noise from part join p using (p_brand) group by 1, 2, 3""")
def a19_cluster_labels(t):
    best = t.part.groupBy("p_brand").agg(F.percentile("p_retailprice", 0.8).alias("p80"), F.max_by("p_name", F.struct(F.col("p_retailprice"), -F.col("p_partkey"))).alias("label"))
    split = lambda c: F.sum(F.when(c, 1).otherwise(0))
    found = t.part.join(best, "p_brand").groupBy("p_brand", "label", "p80").agg(split(F.col("p_retailprice") >= F.col("p80")).alias("n_relevant"), split(F.col("p_retailprice") < F.col("p80")).alias("n_noise"))
    return found.withColumn("p80", r6("p80"))


@query("select round(sum(case when label = 0 then 1 else 0 end) / count(*)::double, 6) as noise_ratio, count(distinct case when label <> 0 then label end) as n_clusters, count(*) as n from embeddings")
def a20_cluster_summary(t):
    noise = F.sum(F.when(F.col("label") == 0, 1).otherwise(0)) / F.count("*")
    return t.embeddings.agg(r6(noise).alias("noise_ratio"), F.countDistinct(F.when(F.col("label") != 0, F.col("label"))).alias("n_clusters"), F.count("*").alias("n"))


@query("select label, count(*) as n from embeddings where label <> 0 group by 1 order by 2 desc, 1 limit 10")
def a20_largest_clusters(t):
    return t.embeddings.where("label <> 0").groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(10)


@query("""with l as (select distinct source, doc_id, trim(regexp_replace(regexp_replace(lower(string_split(text, chr(10))[1]), '[0-9]+', '#', 'g'), '[^a-z0-9#]+', ' ', 'g')) as line from documents),
n as (select source, count(distinct doc_id) as pages from documents group by 1)
select source, line, count(*) as n_pages from l join n using (source) where length(line) between 1 and 240 group by source, line, pages having count(*) >= greatest(3, ceil(pages * 0.05))""")
def a21_running_headers(t):
    from ..functions.text import header_fingerprint

    return ops.running_lines(t.documents, "source", "doc_id", header_fingerprint(F.split("text", "\n")[0]))


@query("""with l as (select distinct source, doc_id, trim(string_split(text, chr(10))[1]) as line from documents), n as (select source, count(distinct doc_id) as pages from documents group by 1)
select source, line, count(*) as n_pages from l join n using (source) where length(line) between 1 and 240 group by source, line, pages having count(*) >= greatest(3, ceil(pages * 0.05))""")
def a22_repeated_headers(t):
    return ops.running_lines(t.documents, "source", "doc_id", F.trim(F.split("text", "\n")[0]))


@query("""with f as (select label, vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as i from embeddings),
nn as (select vec_id, sqrt(sum(x * x)) as n from f group by 1), u as (select label, i, avg(x / n) as m, count(*) as n from f join nn using (vec_id) where n > 0 group by 1, 2),
c as (select label, sqrt(sum(m * m)) as cn from u group by 1)
select u.label, (i - 1)::int as pos, round(m / cn, 5) as value, u.n from u join c using (label)""")
def a24_centroids(t):
    found = ops.centroids(t.embeddings, ["label"], "embedding")
    return found.select("label", "n", F.posexplode("centroid").alias("pos", "value")).withColumn("value", F.round("value", 5))


@query()
def a23_two_level_centroids(t):
    """Unit vectors to groups of 8 ids (units), to labels (pages); each unit weighs the same."""
    units = ops.centroids(t.embeddings.withColumn("unit", F.floor(F.col("vec_id") / 8)), ["label", "unit"], "embedding")
    pages = ops.centroids(units, ["label"], "centroid")
    return pages.select("label", F.col("n").alias("n_units"), F.transform("centroid", lambda x: F.round(x, 6)).alias("centroid"))


@query("select l_orderkey, l_partkey, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def a25_duplicate_keys(t):
    return t.lineitem.groupBy("l_orderkey", "l_partkey").agg(F.count("*").alias("n")).where("n > 1")


@query("""with s as (select o_orderkey, o_totalprice, unnest(['all', 'p:' || o_orderpriority, 's:' || o_orderstatus]) as stratum from orders)
select stratum, round(avg(o_totalprice), 4) as mean_value, count(*) as n from s group by 1""")
def a26_metrics_by_stratum(t):
    strata = F.array(F.lit("all"), F.concat(F.lit("p:"), "o_orderpriority"), F.concat(F.lit("s:"), "o_orderstatus"))
    return t.orders.select("o_totalprice", F.explode(strata).alias("stratum")).groupBy("stratum").agg(F.round(F.avg("o_totalprice"), 4).alias("mean_value"), F.count("*").alias("n"))


@query("""with s as (select l_partkey, l_returnflag as tx, sum(l_quantity) as w, max(l_discount) as best from lineitem group by 1, 2), tt as (select l_partkey, sum(w) as tot, count(*) as n_texts from s group by 1)
select s.l_partkey, tx as winner, round(w / tot, 6) as agreement, best as best_score, n_texts from s join tt using (l_partkey) qualify row_number() over (partition by s.l_partkey order by w desc, best desc, tx desc) = 1""")
def a27_weighted_vote(t):
    return ops.weighted_vote(t.lineitem, "l_partkey", "l_returnflag", F.col("l_quantity"), "l_discount").withColumn("agreement", r6("agreement"))


@query("select event_type, value > 50 as is_current, count(*) as n from events group by 1, 2")
def a28_status_report(t):
    return t.events.groupBy("event_type", (F.col("value") > 50).alias("is_current")).agg(F.count("*").alias("n"))


@query("""select o_orderpriority, sum((o_orderstatus = 'F')::int)::bigint as n_done, sum((o_totalprice > 100000)::int)::bigint as n_large, sum((o_orderstatus = 'F' and o_totalprice > 100000)::int)::bigint as n_both from orders group by 1""")
def a29_boolean_sums(t):
    done, large = F.col("o_orderstatus") == "F", F.col("o_totalprice") > 100000
    return t.orders.groupBy("o_orderpriority").agg(*[F.sum(c.cast("int")).alias(n) for n, c in (("n_done", done), ("n_large", large), ("n_both", done & large))])


@query("select n_regionkey, string_agg(trim(n_name), '; ' order by n_nationkey) as joined from nation where trim(n_name) <> '' group by 1")
def a30_ordered_concat(t):
    return ops.ordered_concat(t.nation, "n_regionkey", F.col("n_name"), ["n_nationkey"])
