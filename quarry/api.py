"""The search facade: one object for one build of a corpus, whose methods return DataFrames.

A build is a folder of tables and never changes under a reader; a new build is a new folder.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.scripture import find_citations
from .functions.text import excerpt
from .operators import search

try:  # one writer for each folder, where the platform has file locks
    import fcntl
except ImportError:
    fcntl = None


@dataclass
class Corpus:
    """``spark`` and the folder of a build; ``documents`` has doc_id, source (volume), text, lang, n_chars."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def list_volumes(self) -> DataFrame:
        """volume, n_pages, first_page, last_page."""
        pages = self.table("documents")
        return pages.groupBy(F.col("source").alias("volume")).agg(F.count("*").alias("n_pages"), F.min("doc_id").alias("first_page"), F.max("doc_id").alias("last_page"))

    def search_corpus(self, words: list[str], volumes: list[str] | None = None, limit: int = 20, every: bool = False) -> DataFrame:
        """doc, score of the best pages by BM25; the scope is applied before anything is ranked."""
        pages = self.table("documents")
        if volumes:
            pages = pages.where(F.col("source").isin(*volumes))
        index = search.index(pages, "doc_id", F.col("text"))
        found = search.bm25(index, words, *search.mean_length(pages, F.col("text")), every=every)
        return search.top(found.select("doc", F.round("score", 6).alias("score")), limit, "doc")

    def search_scripture(self, query: str, documents: DataFrame | None = None) -> DataFrame:
        """volume, page, references: pages that cite what a boolean query of references (``gen 1 && rom 8``) asks for.

        ``documents`` stands for the folder's table of that name.
        """
        pages = (self.table("documents") if documents is None else documents).select(F.col("source").alias("volume"), F.col("doc_id").alias("page"), F.explode(find_citations(F.col("text"))).alias("c"))
        postings = pages.select(F.concat_ws(" ", "c.book", "c.chapter").alias("reference"), "volume", "page", F.lit(4).cast("long").alias("mask"))
        return search.evaluate_boolean(search.parse_boolean(query), postings, ["volume", "page"]).drop("mask")

    def page_metadata(self, volume: str | None = None) -> DataFrame:
        """volume, page, lang, n_chars, excerpt."""
        pages = self.table("documents")
        pages = pages.where(F.col("source") == volume) if volume else pages
        return pages.select(F.col("source").alias("volume"), F.col("doc_id").alias("page"), "lang", "n_chars", excerpt(F.split("text", "\n")[0], 80).alias("excerpt"))

    def page_text(self, volume: str, first: int, last: int) -> DataFrame:
        """page, text of a range of a volume's pages."""
        return self.table("documents").where((F.col("source") == volume) & F.col("doc_id").between(first, last)).select(F.col("doc_id").alias("page"), "text")

    def search_index(self, prefix: str, limit: int = 32) -> DataFrame:
        """term, df: index entries that begin so."""
        index = search.index(self.table("documents"), "doc_id", F.col("text")).groupBy("term").agg(F.count("*").alias("df"))
        return search.prefix_terms(index, prefix, limit)

    def volume_index(self, volume: str, least: float = 2.01) -> DataFrame:
        """term, df, importance in one volume."""
        pages = self.table("documents").where(F.col("source") == volume)
        return search.importance(search.index(pages, "doc_id", F.col("text")), pages.count(), least)


class VolumeLock:
    """One writer for a volume (I12): ``with VolumeLock(folder, volume): ...``; a second one raises BlockingIOError.

    For drivers that share a file system; Spark's committers and one job for each partition need no lock.
    """

    def __init__(self, folder: str, volume: str):
        self.path = os.path.join(folder, f".{volume}.lock")

    def __enter__(self):
        self.file = open(self.path, "w")
        if fcntl:
            try:
                fcntl.flock(self.file, fcntl.LOCK_EX | fcntl.LOCK_NB)
            except BlockingIOError:
                self.file.close()
                raise
        return self

    def __exit__(self, *_):
        self.file.close()
