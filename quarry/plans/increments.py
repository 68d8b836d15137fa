"""Queries of incremental processing, chunks and keyword checks (I, D rows and X33 - X60)."""

from pyspark.sql import functions as F

from ..functions import chunks, integrity
from ..streaming import incremental as ops
from .registry import query


@query("""with known as (select o_orderkey as path, case when o_orderkey % 11 = 0 then 'old' else o_orderstatus end as mark from orders where o_orderkey % 5 <> 0) select o_orderkey as path, o_orderstatus as mark from orders where not exists (select 1 from known where path = o_orderkey and mark = o_orderstatus)""")
def i01_changed_files(t):
    files = t.orders.select(F.col("o_orderkey").alias("path"), F.col("o_orderstatus").alias("mark"))
    known = t.orders.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("path"), F.when(F.col("o_orderkey") % 11 == 0, "old").otherwise(F.col("o_orderstatus")).alias("mark"))
    return ops.changed(files, known, "path", ["mark"])


@query("""select o_orderkey as path, o_orderstatus as mark, case when o_orderkey % 5 <> 0 and o_orderkey % 11 <> 0 then 'kept' else 'scanned' end as how from orders""")
def i02_refreshed(t):
    files = t.orders.select(F.col("o_orderkey").alias("path"), F.col("o_orderstatus").alias("mark"))
    gone = t.orders.select((-1 - F.col("o_orderkey")).alias("path"), F.col("o_orderstatus").alias("mark"), F.lit("kept").alias("how"))
    known = t.orders.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("path"), F.when(F.col("o_orderkey") % 11 == 0, "old").otherwise(F.col("o_orderstatus")).alias("mark"), F.lit("kept").alias("how")).unionByName(gone)
    scanned = ops.changed(files, known, "path", ["mark"]).withColumn("how", F.lit("scanned"))
    return ops.refreshed(known, files, scanned, "path", ["mark"])


@query("select source as volume, doc_id as page from documents where source = (select min(source) from documents where lang <> 'en') and lang <> 'en' order by doc_id limit 10")
def s20_next_jobs(t):
    pages = t.documents.select(F.col("source").alias("volume"), F.col("doc_id").alias("page"), "lang")
    return ops.next_jobs(pages.drop("lang"), pages.where("lang = 'en'"), "volume", "page", 10)


@query("""select event_id, case when event_type = 'view' and event_id % 3 = 0 then 'done' when event_type = 'view' then 'pending' when event_type = 'error' then 'pending' else event_type end as status from events""")
def i04_recovered(t):
    jobs = t.events.select("event_id", F.when(F.col("event_type") == "view", "running").otherwise(F.col("event_type")).alias("status"))
    return ops.recovered(jobs, t.events.where("event_id % 3 = 0").select("event_id"), "event_id", "status", retry=True)


@query("""select l_orderkey, l_linenumber, l_partkey, case when o_custkey = 7 and o_orderkey between 0 and 5000 then 'stale' else 'current' end as status from lineitem left join orders on l_orderkey = o_orderkey""")
def i06_invalidated(t):
    rows = t.orders.select(F.col("o_custkey").cast("string").alias("doc"), F.col("o_orderkey").alias("page"), F.col("o_orderkey").alias("key"), F.lit("current").alias("status"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("key"), "l_linenumber", "l_partkey", F.lit("current").alias("status"))
    _, dependent = ops.invalidated(rows, lines, "doc", "page", "key", "7", 0, 5000)
    return dependent.withColumnRenamed("key", "l_orderkey")


@query("""select o_orderkey, coalesce(n = 3 and valid, false) as promote from orders left join (select l_orderkey, count(distinct l_linenumber) as n, bool_and(l_discount < 0.09) as valid from lineitem group by 1) on l_orderkey = o_orderkey""")
def i07_promotable(t):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    return ops.promotable(t.orders.select("o_orderkey", F.lit(3).alias("expected")), lines, "o_orderkey", "expected", "l_linenumber", F.col("l_discount") < 0.09)


@query("""with m as (select user_id, event_id, case when event_type = 'purchase' then 'w' || event_id when event_type = 'error' then '' end as mark from events) select user_id, event_id, nullif(last_value(mark ignore nulls) over (partition by user_id order by event_id), '') as active from m""")
def i08_carried_work(t):
    rows = t.events.select("user_id", "event_id", F.when(F.col("event_type") == "purchase", F.concat(F.lit("w"), F.col("event_id").cast("string"))).alias("named"), "event_type")
    return ops.carried(rows, "user_id", "event_id", "named", F.col("event_type") == "error").select("user_id", "event_id", "active")


@query("""with recursive o as (select user_id, event_id, event_type, row_number() over (partition by user_id order by event_id) as i from events), r as (select user_id, event_id, i, sha256(':' || event_type) as chain from o where i = 1 union all select o.user_id, o.event_id, o.i, sha256(r.chain || ':' || o.event_type) from r join o on o.user_id = r.user_id and o.i = r.i + 1) select user_id, event_id, chain from r""")
def i09_chained(t):
    return ops.chained(t.events.select("user_id", "event_id", "event_type"), "user_id", "event_id", "event_type").select("user_id", "event_id", "chain")


@query("""with f as (select l_orderkey, min(l_linenumber) as first from lineitem where l_returnflag = 'R' group by 1) select l_orderkey, l_linenumber, l_suppkey, case when coalesce(l_linenumber > first, false) then 'stale' else l_linestatus end as status from lineitem left join f using (l_orderkey)""")
def i10_downstream_stale(t):
    stages = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_linestatus").alias("status"))
    return ops.downstream_stale(stages, t.lineitem.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber"), "l_orderkey", "l_linenumber", "status")


@query("select o_custkey, o_orderpriority as stage, sha256(o_orderkey::varchar) as fingerprint, 'running' as state from orders")
def i11_begun_stages(t):
    return ops.begun(t.orders.withColumnRenamed("o_orderpriority", "stage"), "o_custkey", "stage", F.sha2(F.col("o_orderkey").cast("string"), 256))


@query("select doc_id, source from documents where not exists (select 1 from labels where labels.doc_id = documents.doc_id)")
def i13_not_done(t):
    return ops.not_done(t.documents.select("doc_id", "source"), t.labels, ["doc_id"])


@query("select time_bucket(interval '1 hour', ts) as start, event_type, count(*) as n from events group by 1, 2")
def i03_windowed_counts(t):
    return ops.windowed_counts(t.events, "ts", "event_type")


@query()
def x33_packed_sentences(t):
    return t.documents.select("doc_id", F.posexplode(chunks.packed(F.col("text"), 800)).alias("pos", "piece"))


@query()
def x35_text_windows(t):
    found = t.documents.select("doc_id", F.explode(chunks.text_windows(F.col("text"), 1000, 120, True)).alias("w"))
    return found.select("doc_id", "w.start", "w.end", F.sha2("w.text", 256).alias("digest"))


@query()
def x45_located_quotes(t):
    """60 characters from the middle of each text, in capitals or with two letters lost, looked for in the whole text."""
    at = F.greatest(F.floor(F.length("text") / 2).cast("int"), F.lit(1))
    part = F.trim(F.substr("text", at, F.lit(60)))
    quote = F.when(F.col("doc_id") % 2 == 0, F.upper(part)).otherwise(F.concat(F.substring(part, 1, 20), F.substr(part, F.lit(22), F.lit(20)), F.substr(part, F.lit(43), F.lit(18))))
    found = t.documents.where("text is not null").select("doc_id", chunks.located(quote, F.col("text")).alias("m"))
    return found.select("doc_id", "m.kind", "m.start", "m.end", F.round("m.score", 6).alias("score"))


@query()
def x44_column_counts(t):
    boxes = F.collect_list(F.array((F.col("l_quantity") * 15), F.col("l_quantity") * 15 + 100.0))
    return t.lineitem.groupBy("l_orderkey").agg(boxes.alias("b")).select("l_orderkey", chunks.columns_of(F.col("b"), F.lit(1000.0)).alias("n_columns"))


@query()
def x49_compared_pages(t):
    """Each whole text against itself as a scanner might misread it: some letters, some words lost, some broken."""
    read = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", r"\bt(\w*)rn", "t$1m"), r"\b(\w{9})(\w+)", "$1 $2"), r"\be\w{2} ", "")
    rows = t.documents.where("text is not null").select("doc_id", chunks.compared_pages(read, F.col("text")).alias("c"))
    return rows.select("doc_id", "c.n_same", "c.n_changed", "c.n_omitted", "c.n_added", "c.n_unresolved", F.round("c.coverage", 6).alias("coverage"))


@query()
def x60_excerpts(t):
    return t.documents.select("doc_id", chunks.excerpts(F.col("text"), F.split("text", "\n")[0], 300).alias("excerpt"))


@query()
def x11_sanitized_keywords(t):
    """Each sentence of each whole text as a keyword."""
    sentences = t.documents.select("doc_id", F.posexplode(F.split("text", "[.\n]")).alias("place", "sentence"))
    raw = F.concat(F.lit("**Keywords: "), "sentence", F.lit("**"))
    return sentences.select("doc_id", "place", integrity.sanitized(raw).alias("s")).select("doc_id", "place", "s.value", F.array_join("s.issues", ",").alias("issues"))


@query()
def d03_keyword_status(t):
    lexicon = frozenset({"large", "small", "economy", "standard", "promo", "medium", "steel", "brass", "copper", "tin", "nickel", "part"})
    return t.part.select("p_partkey", integrity.checked(F.lower("p_type"), lexicon, frozenset({"the", "of", "and"})).alias("status"))
