"""Streams give what their batch twins give."""

from pyspark.sql import functions as F

from taskcurate.streaming import jobs

from .conftest import SF_DIR


def _pair(spark, views):
    events = views.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    stream = jobs.read_stream(spark, SF_DIR, "events.parquet", views.table("events").schema)
    return events, stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _rows(df):
    return sorted(tuple(str(round(x, 6)) if isinstance(x, float) else str(x) for x in r) for r in df.collect())


def test_new_records(spark, views):
    events, stream = _pair(spark, views)
    got = jobs.run_available(jobs.new_records(stream.select("event_id", "ts")), "t1")
    assert _rows(got) == _rows(jobs.new_records_batch(events.select("event_id", "ts")))


def test_windows(spark, views):
    events, stream = _pair(spark, views)
    for slide in (None, "30 minutes"):
        got = jobs.run_available(jobs.outcome_counts(stream, slide=slide), "t2")
        assert _rows(got) == _rows(jobs.outcome_counts_batch(events, slide=slide))


def test_sessions(spark, views):
    events, stream = _pair(spark, views)
    got = jobs.run_available(jobs.activity_sessions(stream, "2 hours"), "t3")
    assert _rows(got) == _rows(jobs.activity_sessions_batch(events, "2 hours"))


def _stored(spark, folder):
    return sorted((r.event_id, r.v) for r in jobs.ingested(spark, folder, "event_id long, ts timestamp, v string").collect())


def test_a_batch_run_again_adds_nothing(spark, tmp_path):
    batch = lambda *rows: spark.createDataFrame(rows, "event_id long, ts string, v string").withColumn("ts", F.col("ts").cast("timestamp"))
    folder = str(tmp_path / "store")
    jobs.store_new(batch((1, "2024-01-01", "a"), (2, "2024-01-01", "b"), (1, "2023-01-01", "first")), folder, 0)
    jobs.store_new(batch((2, "2024-02-01", "late"), (3, "2024-02-01", "c"), (None, "2024-02-01", "no id")), folder, 1)
    want = [(1, "first"), (2, "b"), (3, "c")]
    assert _stored(spark, folder) == want
    jobs.store_new(batch((2, "2024-02-01", "late"), (3, "2024-02-01", "c")), folder, 1)  # after a restart
    assert _stored(spark, folder) == want
    # far older than any watermark, and another writer with the same batch number
    jobs.store_new(batch((1, "2030-01-01", "again"), (4, "2000-01-01", "d")), folder, 1, writer="other")
    assert _stored(spark, folder) == [*want, (4, "d")]


def test_a_batch_that_failed_half_way(spark, tmp_path):
    folder = str(tmp_path / "store")
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "event_id long, v string").withColumn("ts", F.lit("2024-01-01").cast("timestamp")).select("event_id", "ts", "v")
    jobs.store_new(batch, folder, 0)
    batch.withColumn("event_id", F.col("event_id") + 1).write.parquet(f"{folder}/rows/writer=main/batch=1")  # rows without their ids
    jobs.store_new(batch.withColumn("event_id", F.col("event_id") + 1), folder, 1)
    assert _stored(spark, folder) == [(1, "a"), (2, "b"), (3, "b")]


def test_ingest_goes_on_where_it_was(spark, tmp_path):
    schema, folder, source = "event_id long, ts timestamp, v string", str(tmp_path / "store"), str(tmp_path / "in")
    for n in (0, 1):
        spark.range(n * 5, n * 5 + 8).selectExpr("id AS event_id", "timestamp'2024-01-01' AS ts", f"'{n}' AS v").write.mode("append").parquet(source)
        jobs.ingest(spark.readStream.schema(schema).parquet(source), folder)
    assert _stored(spark, folder) == [(i, "0" if i < 8 else "1") for i in range(13)]
