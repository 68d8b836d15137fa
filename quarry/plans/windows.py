"""Window queries."""

from pyspark.sql import functions as F

from ..operators import windows as ops
from .registry import query


@query("""with s as (select o_custkey, min(o_orderkey) as break_page from (select *, max(o_orderdate) over (partition by o_custkey order by o_orderkey rows between unbounded preceding and 1 preceding) as high from orders) where o_orderdate < high group by 1) select * from s""")
def w01_order_breaks(t):
    return ops.time_breaks(t.orders, "o_custkey", "o_orderkey", "o_orderdate")


@query("""with g as (select l_partkey, l_returnflag || l_linestatus as text, count(distinct l_suppkey) as n_engines, coalesce(max(l_discount), -1) as best from lineitem group by 1, 2),
r as (select *, sum(n_engines) over (partition by l_partkey) as tot, count(*) over (partition by l_partkey, n_engines) as n_ties, row_number() over (partition by l_partkey order by n_engines desc, best desc, length(text) desc, text) as rk from g)
select l_partkey, text, n_engines, tot::bigint as total_engines, round(n_engines / tot::double, 6) as ratio, round(n_engines * n_engines / tot::double, 6) as score, n_ties,
case when n_ties > 1 then 'conflict' when n_engines = tot and tot > 1 then 'high' when n_engines >= greatest(2, ceil(tot * 0.6)) then 'medium' else 'low' end as label from r where rk = 1""")
def w02_line_consensus(t):
    found = ops.consensus(t.lineitem.withColumn("text", F.concat("l_returnflag", "l_linestatus")), "l_partkey", "text", F.col("l_suppkey"), "l_discount")
    return found.withColumn("ratio", F.round("ratio", 6)).withColumn("score", F.round("score", 6))


@query("""select * from (select o_custkey, o_orderkey, o_orderstatus, count(*) over (partition by o_custkey) as n_versions, o_orderdate from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1) where o_orderdate >= timestamp '1997-01-01'""")
def w03_latest_since(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return ops.latest(rows, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], F.col("o_orderdate") >= F.to_timestamp(F.lit("1997-01-01")))


@query("select o_custkey, coalesce(max(case when o_orderstatus = 'F' then o_orderkey end), max(o_orderkey)) as chosen from orders group by 1")
def w04_prefer_current(t):
    return ops.preferred(t.orders, "o_custkey", "o_orderkey", F.col("o_orderstatus") == "F")


@query("select user_id, max_by(event_type, event_id) as status, max(event_id) as event_id from events group by 1")
def w05_latest_status(t):
    return t.events.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("status"), F.max("event_id").alias("event_id"))


@query("""with p as (select source, doc_id, lang, n_chars, (row_number() over (partition by source order by doc_id) - 1) // 10 as group_no from documents)
select source, group_no, count(*) as n_pages, min(doc_id) as first_page, max(doc_id) as last_page from p group by 1, 2""")
def w06_page_groups(t):
    groups = ops.page_groups(t.documents, "source", "doc_id", 10)
    return groups.groupBy("source", "group_no").agg(F.count("*").alias("n_pages"), F.min("doc_id").alias("first_page"), F.max("doc_id").alias("last_page"))


@query("""with d as (select source, doc_id, case when doc_id % 7 = 0 then n_chars // 1000 end as tome, lang as series, case when n_chars % 3 = 0 then n_chars % 5 end as part from documents),
f as (select *, last_value(case when tome is not null then series end ignore nulls) over w as full_series, last_value(tome ignore nulls) over w as full_tome from d window w as (partition by source order by doc_id)),
c as (select *, sum(case when coalesce(full_tome <> lag_tome, full_tome is not null) then 1 else 0 end) over (partition by source order by doc_id) as run from (select *, lag(full_tome) over (partition by source order by doc_id) as lag_tome from f))
select source, doc_id, full_series, full_tome, last_value(case when tome is not null then part end ignore nulls) over (partition by source, run order by doc_id) as full_part from c""")
def w06_fill_identity(t):
    rows = t.documents.select(
        "source", "doc_id", F.when(F.col("doc_id") % 7 == 0, F.floor(F.col("n_chars") / 1000)).alias("tome"), F.col("lang").alias("series"), F.when(F.col("n_chars") % 3 == 0, F.col("n_chars") % 5).alias("part")
    )
    return ops.fill_identity(rows, "source", "doc_id", "series", "tome", "part").select("source", "doc_id", "full_series", "full_tome", "full_part")


@query("""with m as (select source, doc_id, lang, case when row_number() over w = 1 or lang is distinct from lag(lang) over w then 1 else 0 end as b from documents window w as (partition by source order by doc_id)),
s as (select *, sum(b) over (partition by source order by doc_id) as segment from m)
select source, segment::bigint as segment, any_value(lang) as lang, min(doc_id) as first, max(doc_id) as last, count(*) as n from s group by 1, 2""")
def w07_segments(t):
    return ops.segments(t.documents, "source", "doc_id", "lang")


@query("""with e as (select user_id, event_id, event_type, floor(value / 25)::bigint as section, case when event_type <> 'view' then event_type || ':' || event_id end as target, event_type = 'view' as ibid, event_id // 40 as file from events),
b as (select *, case when coalesce(file - lag(file) over w > 2, false) or coalesce(section <> lag(section) over w, false) then 1 else 0 end as br from e window w as (partition by user_id order by event_id)),
r as (select *, sum(br) over (partition by user_id order by event_id) as run from b)
select user_id, event_id, case when ibid then last_value(case when not ibid then target end ignore nulls) over (partition by user_id, run order by event_id) end as inherited from r""")
def w08_inherit(t):
    rows = t.events.select(
        "user_id", "event_id", "event_type", F.floor(F.col("value") / 25).alias("section"), F.floor(F.col("event_id") / 40).alias("file"),
        F.when(F.col("event_type") != "view", F.concat_ws(":", "event_type", F.col("event_id").cast("string"))).alias("target"),
    )
    return ops.inherit(rows, "user_id", ["event_id"], "file", "section", "target", F.col("event_type") == "view").select("user_id", "event_id", "inherited")


PRINTED = """p as (select source, doc_id, case when n_chars % 3 = 0 then 2 * doc_id + n_chars % 4 end as v from documents)"""


def printed(t):
    """Documents as pages of a source with a printed number on some."""
    return t.documents.select("source", "doc_id", F.when(F.col("n_chars") % 3 == 0, 2 * F.col("doc_id") + F.col("n_chars") % 4).alias("v"))




@query(f"""with {PRINTED}, s as (select source, doc_id + d as doc_id, v + 2 * d as candidate, 1.5::double / abs(d) as w from p, (select unnest(range(-20, 21)) as d) where v is not null and d <> 0),
g as (select source, doc_id, candidate, sum(w) as votes from s group by all)
select source, doc_id, candidate, round(votes, 6) as votes from g semi join p using (source, doc_id)""")
def w09_neighbour_votes(t):
    return ops.neighbour_votes(printed(t), "source", "doc_id", "v", 20, 2).withColumn("votes", F.round("votes", 6))


@query(f"""with {PRINTED}, k as (select source, doc_id as i, v - 2 * doc_id as off from p where v is not null),
n as (select p.source, p.doc_id, off, i - p.doc_id as d from p join k on p.source = k.source and i between p.doc_id - 64 and p.doc_id + 64 and i <> p.doc_id),
g as (select source, doc_id, off, count(*) as n, max(case when d < 0 then 1 else 0 end) as b, max(case when d > 0 then 1 else 0 end) as a from n group by 1, 2, 3)
select source, doc_id, off as "offset", n, round(8 + least(2.0::double, 0.25 * n), 6) as weight from g where n >= 3 and a = 1 and b = 1""")
def w10_bracketed_offsets(t):
    return ops.bracketed_offsets(printed(t), "source", "doc_id", "v", 64).withColumn("weight", F.round("weight", 6))


@query(f"""with {PRINTED}, k as (select source, doc_id as i, v - 2 * doc_id as off from p where v is not null),
n as (select p.source, p.doc_id, off, i - p.doc_id as d from p join k on p.source = k.source and i between p.doc_id - 64 and p.doc_id + 64 and i <> p.doc_id),
g as (select source, doc_id, off from n group by 1, 2, 3 having sum((d < 0)::int) >= 2 and sum((d > 0)::int) >= 2), st as (select source, doc_id, count(*) as c, max(off) as m from g group by 1, 2)
select p.source, p.doc_id, p.v, coalesce(c = 1 and m = v - 2 * p.doc_id, false) as valid from p left join st using (source, doc_id)""")
def w11_validated_numbers(t):
    return ops.validated(printed(t), "source", "doc_id", "v", 64)


#: Documents as pages with the numbers of their first line, their last line and their whole text; ``v``: all votes; ``g``: by candidate.
VOTES = """p as (select source, doc_id, row_number() over (partition by source order by doc_id) - 1 as i, count(*) over (partition by source) as n,
  list_transform(regexp_extract_all(string_split(text, chr(10))[1], '[0-9]+'), lambda x: x[1:9]::bigint) as header,
  list_transform(regexp_extract_all(string_split(text, chr(10))[-1], '[0-9]+'), lambda x: x[1:9]::bigint) as footer,
  list_transform(regexp_extract_all(text, '[0-9]+'), lambda x: x[1:9]::bigint) as body from documents where text is not null),
c as (select *, list_filter(case when len(header) + len(footer) > 0 then header || footer else body[1:4] end, lambda x: x > 0 and x < 10000)[1:4] as cand from p),
k as (select source, i, doc_id, cand[j] as x, j from (select *, unnest(range(1, len(cand) + 1)) as j from c)),
v as (select source, i, unnest(header[1:4]) as candidate, 4.0::double as w from c union all select source, i, unnest(footer[1:4]), 3.0 from c union all select source, i, unnest(body[1:4]), 1.0 from c
  union all select source, i + d, x + d, 1.5::double / abs(d) from k, (select unnest([-4, -3, -2, -1, 1, 2, 3, 4]) as d)
  union all select a.source, a.i + d, a.x + d, 2.5::double / d from k a, (select unnest([1, 2, 3, 4]) as d), k b where a.source = b.source and b.i = a.i + 2 * d and a.j = b.j and b.doc_id - a.doc_id = b.x - a.x),
g as (select c.source, c.doc_id, candidate, round(sum(w), 9) as votes from v join c using (source, i) where candidate > 0 and candidate < 10000 group by all)"""


def numbered(t):
    """Documents as pages with the numbers of their first line, their last line and their whole text."""
    found = lambda text: F.transform(F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0)), lambda x: F.substring(x, 1, 9).cast("long"))
    lines = F.split("text", "\n")
    return t.documents.where("text is not null").select("source", "doc_id", found(lines[0]).alias("header"), found(F.element_at(lines, -1)).alias("footer"), found(F.col("text")).alias("body"))


@query(f"""with {VOTES}, r as (select *, sum(votes) over (partition by source, doc_id) as total, lead(votes) over w as second, row_number() over w as rk from g window w as (partition by source, doc_id order by votes desc, candidate))
select source, doc_id, candidate, round(votes, 6) as votes, round(least(1.0::double, 0.15 + 0.55 * votes / total + least(0.3::double, (votes - coalesce(second, 0)) / 6)), 6) as confidence from r where rk = 1""")
def w12_inferred_numbers(t):
    votes = ops.number_votes(numbered(t), "source", "doc_id")
    found = ops.inferred_numbers(votes, ["source", "doc_id"])
    return found.withColumn("votes", F.round("votes", 6)).withColumn("confidence", F.round("confidence", 6))


@query(f"with {VOTES} select source, doc_id, candidate, round(votes, 6) as votes from g")
def w13_number_votes(t):
    return ops.number_votes(numbered(t), "source", "doc_id").withColumn("votes", F.round("votes", 6))


@query("""with g as (select l_orderkey, l_extendedprice + l_quantity as e, lead(l_extendedprice) over (partition by l_orderkey order by l_extendedprice, l_quantity) - (l_extendedprice + l_quantity) as gap from lineitem),
m as (select *, e + gap / 2 as mid from g where gap >= 100 and abs(e + gap / 2 - 25000) <= 20000)
select l_orderkey, round(mid, 4) as split_at, round(gap, 4) as gap from m qualify row_number() over (partition by l_orderkey order by gap desc, mid) = 1""")
def w14_column_gap(t):
    found = ops.widest_gap(t.lineitem, ["l_orderkey"], "l_extendedprice", "l_quantity", F.lit(25000.0), 20000, 100)
    return found.withColumn("split_at", F.round("split_at", 4)).withColumn("gap", F.round("gap", 4))


@query("""with recursive o as (select l_orderkey, l_quantity as y, l_linenumber, row_number() over (partition by l_orderkey order by l_quantity, l_linenumber) as i from lineitem),
r as (select l_orderkey, l_linenumber, i, y as anchor, 0 as line_no from o where i = 1
union all select o.l_orderkey, o.l_linenumber, o.i, case when o.y - r.anchor > 8 then o.y else r.anchor end, case when o.y - r.anchor > 8 then r.line_no + 1 else r.line_no end from r join o on o.l_orderkey = r.l_orderkey and o.i = r.i + 1)
select l_orderkey, l_linenumber, line_no from r""")
def w15_line_sessions(t):
    return ops.line_sessions(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), ["l_orderkey"], "l_quantity", "l_linenumber", 8.0).select("l_orderkey", "l_linenumber", "line_no")


@query()
def w16_version_diffs(t):
    """Documents of a source as versions of one text."""
    return ops.version_diffs(t.documents, ["source"], ["doc_id"], "text")


@query("select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc)::int as version from orders")
def w17_history(t):
    from pyspark.sql import Window

    return t.orders.select("o_custkey", "o_orderkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))).alias("version"))


@query("""with p as (select l_suppkey, l_partkey, count(*) as n, max(l_discount * 10) as c from lineitem group by 1, 2)
select l_suppkey, l_partkey, min(case when n = 1 and c >= 0.7 then l_partkey end) over (partition by l_suppkey order by l_partkey rows between 1 following and unbounded following) as next_start from p""")
def w18_next_trusted(t):
    return ops.next_trusted(t.lineitem.withColumn("c", F.col("l_discount") * 10), "l_suppkey", "l_partkey", "c")
