"""Incremental processing: what is new or changed, runs and stages, promotion, ordered state, streams of files and events."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def changed(files: DataFrame, known: DataFrame, path: str, marks: list[str]) -> DataFrame:
    """The files that are new, or of which a mark (size, time, version) differs from what is known."""
    return files.join(known.select(path, *marks), [path, *marks], "left_anti")


def vanished(files: DataFrame, known: DataFrame, path: str) -> DataFrame:
    """What is known of files that are there no more (I02: the prune step)."""
    return known.join(files.select(path), path, "left_anti")


def refreshed(known: DataFrame, files: DataFrame, scanned: DataFrame, path: str, marks: list[str]) -> DataFrame:
    """The result rows after a run: those of unchanged files, and those scanned anew."""
    kept = known.join(files.select(path, *marks), [path, *marks], "left_semi")
    return kept.unionByName(scanned)


def not_done(keys: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """The keys without a result."""
    return keys.join(done.select(*on), on, "left_anti")


def next_jobs(pages: DataFrame, jobs: DataFrame, volume: str, page: str, size: int) -> DataFrame:
    """The next ``size`` pages without a job of the first volume that has any."""
    open_pages = not_done(pages, jobs, [volume, page])
    first = open_pages.agg(F.min(volume).alias(volume))
    return open_pages.join(F.broadcast(first), volume, "left_semi").orderBy(page).limit(size)


def recovered(jobs: DataFrame, results: DataFrame, key: str, status: str, retry: bool = False) -> DataFrame:
    """Interrupted jobs made done if they have a result, else pending; failed ones too if asked."""
    has = results.select(key, F.lit(True).alias("_has")).distinct()
    state = F.col(status)
    new = F.when((state == "running") & F.col("_has"), "done").when(state == "running", "pending")
    if retry:
        new = new.when(state == "error", "pending")
    return jobs.join(has, key, "left").withColumn(status, new.otherwise(state)).drop("_has")


def invalidated(rows: DataFrame, dependent: DataFrame, doc: str, page: str, key: str, which: str, first: int, last: int, status: str = "status") -> tuple[DataFrame, DataFrame]:
    """A range of pages made stale, and what depends on those rows."""
    hit = (F.col(doc) == which) & F.col(page).between(first, last)
    stale = rows.where(hit).select(key, F.lit(True).alias("_stale"))
    mark = lambda df: df.withColumn(status, F.when(F.col("_stale"), "stale").otherwise(F.col(status))).drop("_stale")
    return rows.withColumn(status, F.when(hit, "stale").otherwise(F.col(status))), mark(dependent.join(stale, key, "left"))


def promotable(segments: DataFrame, generations: DataFrame, segment: str, expected: str, page: str, valid: Column) -> DataFrame:
    """segment, promote: whether a segment has all its pages, each once and valid (I07: all or nothing)."""
    found = generations.groupBy(segment).agg(F.countDistinct(page).alias("_n"), F.every(valid).alias("_valid"))
    return segments.join(found, segment, "left").select(segment, (F.coalesce("_n", F.lit(0)) == F.col(expected)).alias("_c"), "_valid").select(segment, F.coalesce(F.col("_c") & F.col("_valid"), F.lit(False)).alias("promote"))


def carried(pages: DataFrame, doc: str, page: str, named: str, ends: Column) -> DataFrame:
    """The pages with ``active``: the last name given at or before a page, none after an end until the next name."""
    per = Window.partitionBy(doc).orderBy(page)
    mark = F.when(F.col(named).isNotNull(), F.col(named)).when(ends, F.lit(""))
    return pages.withColumn("active", F.nullif(F.last(mark, ignorenulls=True).over(per), F.lit("")))


def chained(pages: DataFrame, doc: str, page: str, digest: str) -> DataFrame:
    """The pages with ``chain``: sha256 of the chain before and the page's digest.

    Each link needs the one before; pages are read in order as a stream, of which only the last link is held.
    """
    schema = StructType([*pages.schema.fields, StructField("chain", StringType())])

    def link(batches):
        now, last = None, ""
        for batch in batches:
            out = []
            for d, value in zip(batch[doc], batch[digest]):
                if d != now:
                    now, last = d, ""
                last = hashlib.sha256(f"{last}:{value}".encode()).hexdigest()
                out.append(last)
            yield batch.assign(chain=pd.Series(out, dtype="object", index=batch.index))

    return pages.repartition(doc).sortWithinPartitions(doc, page).mapInPandas(link, schema)


def downstream_stale(stages: DataFrame, changes: DataFrame, volume: str, place: str, status: str) -> DataFrame:
    """Stages after the earliest changed one of a volume made stale (I10). ``changes``: volume, place."""
    first = changes.groupBy(volume).agg(F.min(place).alias("_first"))
    late = F.col(place) > F.col("_first")
    return stages.join(first, volume, "left").withColumn(status, F.when(F.coalesce(late, F.lit(False)), "stale").otherwise(F.col(status))).drop("_first")


def begun(stages: DataFrame, volume: str, stage: str, fingerprint: Column) -> DataFrame:
    """A run row for each stage: its input's fingerprint and the state running."""
    return stages.select(volume, stage, fingerprint.alias("fingerprint"), F.lit("running").alias("state"))


# --- streams


def follow_files(spark: SparkSession, folder: str, schema: str, checkpoint: str, sink, available: bool = True, interval: str = "10 seconds", kind: str = "json"):
    """A query that hands each batch of new files to ``sink(frame, batch_id)``; its place is kept in ``checkpoint``.

    ``available``: what is there, then stop; else look again each interval. A restarted query goes on where it was.
    """
    rows = spark.readStream.schema(schema).format(kind).load(folder)
    writer = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available else writer.trigger(processingTime=interval)).start()


def windowed_counts(events: DataFrame, ts: str, key: str, length: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """start, key, n: counts by time window; of a stream, rows later than the watermark are passed over. The session's zone is UTC."""
    kind = events.schema[ts].dataType.simpleString()
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    counts = timed.groupBy(F.window(ts, length).alias("w"), key).agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").cast(kind).alias("start"), key, "n")


def chained_stream(pages: DataFrame, doc: str, digest: str) -> DataFrame:
    """doc, pages, chain after each batch of a stream: the state of a document is its last link (I08, I09). Pages come in order."""

    def link(key, frames, state):
        last, n = state.get if state.exists else ("", 0)
        for frame in frames:
            for value in frame[digest]:
                last, n = hashlib.sha256(f"{last}:{value}".encode()).hexdigest(), n + 1
        state.update((last, n))
        yield pd.DataFrame({doc: [key[0]], "pages": [n], "chain": [last]})

    kind = pages.schema[doc].dataType.simpleString()
    return pages.groupBy(doc).applyInPandasWithState(link, f"{doc} {kind}, pages long, chain string", "chain string, pages long", "update", "NoTimeout")
