"""Queries through the search facade."""

from pyspark.sql import functions as F

from ..api import Corpus
from .registry import query
from .search import POSTINGS


def corpus(t) -> Corpus:
    return Corpus(t.spark, t.folder)


@query("select source as volume, count(*) as n_pages, min(doc_id) as first_page, max(doc_id) as last_page from documents group by 1")
def r18_list_volumes(t):
    return corpus(t).list_volumes()


@query(f"with {POSTINGS} select doc, round(score, 6) as score from sc order by round(score, 6) desc, doc limit 20")
def r18_search_corpus(t):
    return corpus(t).search_corpus(["the", "idiot", "thing", "license"])


@query()
def r18_search_scripture(t):
    """Whole texts, each with a citation at its end (the given ones have none)."""
    text = F.concat(F.col("text"), F.lit("\nGen "), (F.col("doc_id") % 50 + 1).cast("string"), F.lit(":1"))
    return corpus(t).search_scripture("gen 1 || rom 8", t.documents.withColumn("text", text))


@query("select source as volume, doc_id as page, lang, n_chars, case when length(h) > 80 then regexp_replace(h[1:80], '[\\s.,;:]+$', '') || '…' else h end as excerpt from (select *, string_split(text, chr(10))[1] as h from documents)")
def r18_page_metadata(t):
    return corpus(t).page_metadata()


@query("select doc_id as page, text from documents where source = 'src3' and doc_id between 0 and 500")
def r18_page_text(t):
    return corpus(t).page_text("src3", 0, 500)


@query(f"with {POSTINGS}, d as (select term, count(*) as df from tf group by 1) select term, df from d where starts_with(term, 'lic') order by df desc, term limit 32")
def r18_search_index(t):
    return corpus(t).search_index("lic")


@query(f"""with {POSTINGS}, d as (select term, count(distinct doc) as df from tf join documents on doc = doc_id where source = 'src3' group by 1), n as (select count(*)::double as n from documents where source = 'src3') select term, df, n / df as importance from d, n where n / df >= 2.01""")
def r18_volume_index(t):
    return corpus(t).volume_index("src3")
