"""Streams give what the batch functions give."""

from quarry.streaming import incremental as ops


def test_followed_files_are_read_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    seen = []
    sink = lambda frame, batch: seen.extend(r.k for r in frame.collect())

    def run():
        ops.follow_files(spark, f"file://{folder}", "k int", f"file://{tmp_path}/state", sink).awaitTermination(60)

    (folder / "a.json").write_text('{"k": 1}\n')
    run()
    (folder / "b.json").write_text('{"k": 2}\n')
    run()
    assert sorted(seen) == [1, 2]


def test_chains_of_a_stream(spark, tmp_path):
    rows = [("d", 1, "x"), ("d", 2, "y"), ("e", 1, "z")]
    pages = spark.createDataFrame(rows, "doc string, page int, digest string")
    batch = {r.doc: r.chain for r in ops.chained(pages, "doc", "page", "digest").orderBy("doc", "page").collect()}
    pages.coalesce(1).sortWithinPartitions("doc", "page").write.json(f"file://{tmp_path}/in")
    found = {}
    stream = ops.chained_stream(spark.readStream.schema(pages.schema).json(f"file://{tmp_path}/in"), "doc", "digest")
    sink = lambda frame, _: found.update({r.doc: r.chain for r in frame.collect()})
    stream.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"file://{tmp_path}/state").trigger(availableNow=True).start().awaitTermination(120)
    assert found == batch


def test_windowed_counts_of_a_stream(spark, tables, tmp_path):
    events = spark.read.parquet(f"{tables}/events.parquet")
    whole = {(r.start, r.event_type): r.n for r in ops.windowed_counts(events, "ts", "event_type").collect()}
    events.coalesce(1).write.parquet(f"file://{tmp_path}/in")
    found = {}
    stream = ops.windowed_counts(spark.readStream.schema(events.schema).parquet(f"file://{tmp_path}/in"), "ts", "event_type")
    sink = lambda frame, _: found.update({(r.start, r.event_type): r.n for r in frame.collect()})
    stream.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"file://{tmp_path}/state").trigger(availableNow=True).start().awaitTermination(120)
    assert found == whole


def test_interrupted_jobs(spark):
    jobs = spark.createDataFrame([(1, "running"), (2, "running"), (3, "error"), (4, "done")], "k int, status string")
    results = spark.createDataFrame([(1,), (1,)], "k int")
    assert {r.k: r.status for r in ops.recovered(jobs, results, "k", "status").collect()} == {1: "done", 2: "pending", 3: "error", 4: "done"}


def test_vanished(spark):
    known, files = spark.createDataFrame([(1,), (2,)], "path int"), spark.createDataFrame([(2,)], "path int")
    assert [r.path for r in ops.vanished(files, known, "path").collect()] == [1]
