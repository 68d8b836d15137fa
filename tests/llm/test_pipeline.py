"""Each stage against a plain version, and the whole over the smallest tables."""

import corpus_pipeline as c

from quarry.llm import secrets as s
from quarry.llm.packing import pack_shard

from .test_copies import slow_copies
from .test_decontaminate import brute as leaks


def test_stages_in_order(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    assert [n for n, _ in c.STAGES] == ["toxicity", "near_duplicates", "decontaminate", "secrets", "packing"]
    items = [tuple(r) for r in spark.read.parquet(f"{tables}/benchmark.parquet").select("item_id", "text").collect()]
    toxic = {r.doc_id for r in spark.read.parquet(f"{tables}/labels.parquet").where("toxic = 1").collect()}

    one = c.toxicity(spark, docs, tables).cache()
    assert one.columns == docs.columns
    kept = {r.doc_id for r in one.select("doc_id").collect()}
    gone = {r.doc_id for r in docs.select("doc_id").collect()} - kept
    assert gone and len(gone) < 0.3 * docs.count() and len(toxic & gone) >= 0.5 * len(toxic)

    two = c.near_duplicates(spark, one, tables).cache()
    first = set(slow_copies([(r.doc_id, r.text) for r in one.collect()]).values())
    assert two.columns == docs.columns and sorted(r.doc_id for r in two.collect()) == sorted(first)

    three = c.decontaminate(spark, two, tables).cache()
    texts = {r.doc_id: r.text for r in two.collect()}
    clean = {i for i, (_, hit, _) in zip(texts, leaks(texts.values(), items)) if not hit}
    assert three.columns == docs.columns and {r.doc_id for r in three.collect()} == clean

    four = c.secrets(spark, three, tables).cache()
    assert four.columns == docs.columns and four.count() == three.count()
    before = {r.doc_id: r.text for r in three.collect()}
    for r in four.collect():
        assert r.text == before[r.doc_id] or s.base_spans(before[r.doc_id]) and not s.base_spans(r.text)

    five = c.packing(spark, four, tables)
    assert {r.doc_id for r in five.collect()} == clean and five.count() >= len(pack_shard([1] * 3, 1024))


def test_run(spark, tables):
    rows = c.run(spark, tables)
    assert rows.count() > 0 and rows.columns[0] == "doc_id"


def test_messy_documents(spark, messy, empty, tables):
    for docs in (messy, empty):
        for _, stage in c.STAGES[:-1]:
            out = stage(spark, docs, tables)
            assert out.columns == docs.columns
            out.collect()
        assert c.packing(spark, docs, tables).count() >= docs.count()
