"""Benchmark decontamination through FM-indexes of training shards.

A shard is the part of the documents that a task holds at once. Only words of the benchmark matter, so its text is the runs of
such words that are as long as the shortest window; an occurrence of a window lies within one run. The windows are searched
backward, their occurrences located by sampled suffix positions, and the covered words merged into removal spans.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import item_words, slices, table
from .fmindex import FmIndex


@dataclass
class Windows:
    """Distinct windows of a block of items: word numbers from 1, rows filled from the left, and the items of each."""

    words: dict[bytes, int]
    rows: np.ndarray
    lengths: np.ndarray
    items: list[list[int]]


def windows_of(items: list[tuple[int | None, bytes | None]], width: int) -> Windows:
    """Of ``width`` consecutive words; an item of fewer words, but not none, is one window. A null id takes part without being listed."""
    words: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set] = {}
    for item_id, text in items:
        numbers = [words.setdefault(w, len(words) + 1) for w in item_words(text)]
        for start in range(max(1, len(numbers) - width + 1)) if numbers else ():
            found.setdefault(tuple(numbers[start : start + width]), set()).add(item_id)
    rows = np.zeros((len(found), width), np.int32)
    lengths = np.array([len(w) for w in found], np.int64)
    for i, window in enumerate(found):
        rows[i, : len(window)] = window
    return Windows(words, rows, lengths, [sorted(x for x in ids if x is not None) for ids in found.values()])


def scan_shard(texts: list[bytes | None], windows: Windows) -> list[tuple[int, list[tuple[int, int]], list[int]]]:
    """For each text: its words, the merged spans (start, end) of hit words, and the items with occurring windows, sorted."""
    counts, pieces, where = [], [], []
    least = int(windows.lengths.min(initial=1 << 30))
    look = windows.words.get
    for n, text in enumerate(texts):
        own = item_words(text)
        counts.append(len(own))
        numbers = np.fromiter(map(look, own, repeat(0)), np.int32, len(own))
        cuts = np.flatnonzero(np.r_[0, numbers, 0] == 0)
        for i in np.flatnonzero(np.diff(cuts) > least).tolist():
            start, end = int(cuts[i]), int(cuts[i + 1]) - 1
            pieces += [numbers[start:end], np.zeros(1, np.int32)]
            where.append((n, start, end - start + 1))
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[int]] = [set() for _ in texts]
    if pieces:
        index = FmIndex(np.concatenate(pieces))
        low, high = index.search(windows.rows, windows.lengths)
        owner = np.repeat(np.arange(len(low)), high - low)
        rows = low[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
        text_of, start_of, size_of = (np.array(x) for x in zip(*where))
        begin = np.cumsum(size_of) - size_of
        at = index.locate(rows)
        run = np.searchsorted(begin, at, side="right") - 1
        first = at - begin[run] + start_of[run]
        order = np.lexsort((first, text_of[run]))
        for n, start, w in zip(text_of[run][order].tolist(), first[order].tolist(), owner[order].tolist()):
            end = start + int(windows.lengths[w])
            items[n].update(windows.items[w])
            if spans[n] and start <= spans[n][-1][1]:
                spans[n][-1] = (spans[n][-1][0], max(end, spans[n][-1][1]))
            else:
                spans[n].append((start, end))
    return [(c, s, sorted(i)) for c, s, i in zip(counts, spans, items)]


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """The items, in blocks by a hash of the text so that a block holds about ``block_bytes``; one block if all fit."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("text")).where("length(text) > 0")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    return [items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == i) if blocks > 1 else items for i in range(blocks)]


def _scan(docs: DataFrame, windows: Windows, id_col: str, text_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(windows))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), F.xxhash64(F.col(text_col)).alias("text_hash"))

    def run(batches):
        own = pickle.loads(shared.value)
        for part in slices(batches, 1):
            found = scan_shard(part.column(1).to_pylist(), own)
            spans = [[{"start": a, "end": b} for a, b in s] for _, s, _ in found]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [part.column(0), part.column(2), pa.array([n for n, _, _ in found], pa.int64()), pa.array(spans, kind), pa.array([i for _, _, i in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n_words", "spans", "items"])

    return source.mapInArrow(run, "doc_id long, text_hash long, n_words long, spans array<struct<start:long,end:long>>, items array<long>")


def _merge(found: list[DataFrame]) -> DataFrame:
    """The results of several blocks in one row for each document row; rows that repeat an id and a text repeat the result."""
    keys = ["doc_id", "text_hash", "n_words"]
    parts = [f.withColumn("block", F.lit(i)) for i, f in enumerate(found)]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    rows = union.groupBy(*keys).agg(
        F.sum(F.when(F.col("block") == 0, 1)).alias("copies"),
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    joined = F.expr("""aggregate(spans, cast(array() as array<struct<start:long,end:long>>), (done, s) ->
        if(size(done) > 0 and element_at(done, -1).end >= s.start,
           concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start, 'end', greatest(element_at(done, -1).end, s.end)))),
           concat(done, array(s))))""")
    return rows.withColumn("spans", joined).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copy", "copies")


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, n_words, spans (merged word spans of occurrences, ends exclusive), items (sorted ids of items with occurring windows).

    Words are lower-cased ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Null and empty texts have no words. One row for each row of
    ``docs``. The items are sent to the tasks in blocks of about ``block_bytes``; each block is one pass over ``docs``, and the
    passes are merged by document. Without items no word is hit.
    """
    found = []
    for block in item_blocks(benchmark, item_col, item_text_col, block_bytes):
        items = [(r["item_id"], bytes(r["text"])) for r in block.collect()]  # bounded by block_bytes
        found.append(_scan(docs, windows_of(items, width), id_col, text_col))
    return (found[0] if len(found) == 1 else _merge(found)).drop("text_hash").withColumn("items", F.array_sort("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs, with all their columns.

    Each row is decided by its own text where it is read: nothing is joined or shuffled, and repeated rows fare alike, with an id or
    without. Null and empty texts stay. Each block of items is one filter; what one drops the next does not see.
    """
    at = docs.columns.index(text_col)
    schema = docs.schema

    def clean(windows):
        shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(windows))

        def run(batches):
            own = pickle.loads(shared.value)
            for batch in slices(batches, at):
                texts = [t.encode() if t else None for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array([not spans for _, spans, _ in scan_shard(texts, own)]))

        return run

    for block in item_blocks(benchmark, item_col, item_text_col, block_bytes):
        items = [(r["item_id"], bytes(r["text"])) for r in block.collect()]  # bounded by block_bytes
        docs = docs.mapInArrow(clean(windows_of(items, width)), schema)
    return docs


def op7_decontaminate(spark, sf_dir) -> DataFrame:
    """Windows of 10 words of ``benchmark`` in ``documents``."""
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def op7_sql(width: int = 10) -> str:
    """The same by joins of windows; DuckDB."""
    return f"""
with d as (select doc_id, row_number() over () as rid, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as w from documents),
b as (select item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') as w from benchmark),
bw as (select distinct item_id, least(len(w), {width}) as n, array_to_string(w[i:i + {width} - 1], ' ') as win from (select item_id, w, unnest(range(1, greatest(len(w) - {width} + 1, 1) + 1)) as i from b where len(w) > 0)),
sizes as (select distinct n from bw),
dw as (select rid, n, i, array_to_string(w[i:i + n - 1], ' ') as win from (select rid, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)),
occ as (select rid, i, dw.n, item_id from dw join bw on dw.win = bw.win and dw.n = bw.n),
hits as (select rid, count(distinct j) as n_hit from (select rid, unnest(range(i, i + n)) as j from occ) group by rid),
its as (select rid, count(*) as n_items, string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from (select distinct rid, item_id from occ) group by rid)
select d.doc_id, coalesce(len(d.w), 0)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hits using (rid) left join its using (rid)"""
