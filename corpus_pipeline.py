"""A training corpus from raw documents: clean, unique, free of benchmark passages and secrets, packed into windows.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next stage's docs.
All but the last return the columns of ``documents``.

Null, empty and blank texts are kept by the filters as one near copy of each other; rows with a null id stay in all stages and have
pieces with a null id; repeated rows fare alike in the filters, and near_duplicates keeps one of them; an empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.base import crc_of_id, drop_kept, keep, table
from quarry.llm.copies import drop_near_copies
from quarry.llm.decontaminate import drop_contaminated
from quarry.llm.packing import SUMS, pack
from quarry.llm.secrets import redact_secrets
from quarry.llm.toxicity import drop_toxic, learn


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.7 stay; learnt from labelled ids whose crc32 mod 3 is not 1."""
    labels = table(spark, sf_dir, "labels").where(crc_of_id("doc_id") % 3 != 1)
    return drop_toxic(docs, learn(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of a Jaccard of 0.8 or more over shingles of five words connect that of the smallest id stays."""
    return drop_near_copies(docs, width=5, threshold=0.8)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a 10-word window of a benchmark item stay; each is decided by its own text."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; each secret's span becomes [SECRET]."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of windows of 1024 tokens."""
    return pack(docs, carry=SUMS)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("secrets", secrets), ("packing", packing)]

#: Learning, tokens and windows cannot be said in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what lies between them is in the shared checkpoint folder until the next stage is written, the
    last stage's input until the driver ends."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
        if before is not None:
            drop_kept(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
