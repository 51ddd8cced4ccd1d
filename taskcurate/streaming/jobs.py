"""Stream jobs and their batch twins.

The twins apply the rule by which a stream finishes a result: a window or
session counts once the watermark (latest event time minus the allowed delay)
has passed its end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import keep_first
from ..sources.scratch import has_files, scratch_path


def read_stream(spark: SparkSession, folder: str, file_glob: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", file_glob).parquet(folder)


def new_records(stream: DataFrame, key: str = "event_id", time: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """First record of each id; the state is bounded by the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def new_records_batch(df: DataFrame, key: str = "event_id") -> DataFrame:
    return df.dropDuplicates([key])


def store_new(batch: DataFrame, folder: str, batch_id: int, writer: str = "main", key: str = "event_id", time: str = "ts") -> None:
    """Write the rows of a batch whose id no other batch has brought; the earliest row of an id counts.

    The ids seen so far are a table in ``folder`` beside the rows, both with one
    part per (writer, batch).  A batch that is run again leaves its own part out of
    what was seen and replaces it, so it adds nothing, and ids of any age are known.
    """
    spark = batch.sparkSession
    first = keep_first(batch.filter(F.col(key).isNotNull()), [key], [F.col(time)])
    part = f"writer={writer}/batch={batch_id}"
    if has_files(spark, f"{folder}/ids"):
        id_type = dict(batch.dtypes)[key]
        seen = spark.read.schema(f"`{key}` {id_type}, writer string, batch long").parquet(f"{folder}/ids")
        first = first.join(seen.filter((F.col("writer") != writer) | (F.col("batch") != batch_id)).select(key), key, "left_anti")
    first.select(*batch.columns).write.mode("overwrite").parquet(f"{folder}/rows/{part}")
    # the ids follow the rows: a failure in between leaves a batch that is run again
    spark.read.schema(batch.schema).parquet(f"{folder}/rows/{part}").select(key).write.mode("overwrite").parquet(f"{folder}/ids/{part}")


def ingest(stream: DataFrame, folder: str, writer: str = "main", key: str = "event_id", time: str = "ts", progress: str | None = None) -> None:
    """Run a stream over what is there, each batch through :func:`store_new`; ``progress`` is its checkpoint (below ``folder`` if not given)."""
    job = (
        stream.writeStream.foreachBatch(lambda batch, i: store_new(batch, folder, i, writer, key, time))
        .option("checkpointLocation", progress or f"{folder}/progress/{writer}").trigger(availableNow=True).start()
    )
    job.awaitTermination()


def ingested(spark: SparkSession, folder: str, schema) -> DataFrame:
    """All rows that :func:`ingest` has stored."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{folder}/rows")


def _outcomes(df: DataFrame, window: Column) -> DataFrame:
    out = df.groupBy(window.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", "total")


def _sessions(df: DataFrame, gap: str) -> DataFrame:
    out = df.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("steps"), F.sum("value").alias("total"))
    return out.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "steps", "total")


def _closed(df: DataFrame, source: DataFrame, delay: str) -> DataFrame:
    mark = source.agg(F.date_trunc("millisecond", F.max("ts")) - F.expr(f"INTERVAL {delay}")).scalar()
    return df.filter(F.col("end") <= mark)


def outcome_counts(stream: DataFrame, size: str = "1 hour", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Outcomes per tumbling (or, with ``slide``, sliding) window; late rows are dropped."""
    timed = stream.withWatermark("ts", delay)
    return _outcomes(timed, F.window("ts", size, slide) if slide else F.window("ts", size))


def outcome_counts_batch(df: DataFrame, size: str = "1 hour", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    return _closed(_outcomes(df, F.window("ts", size, slide) if slide else F.window("ts", size)), df, delay)


def activity_sessions(stream: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Sessions per actor: events closer together than ``gap``.

    Run it in a session with
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` on
    (``session.local_session`` does): sessions are then merged inside each input
    partition first, so a busy actor is reduced before the shuffle.
    """
    return _sessions(stream.withWatermark("ts", delay), gap)


def activity_sessions_batch(df: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    return _closed(_sessions(df, gap), df, delay)


def run_available(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there, into a parquet table in the shared folder, and read it back."""
    spark = df.sparkSession
    out = scratch_path(spark, name)
    job = (
        df.writeStream.format("parquet").outputMode("append").option("path", f"{out}/table")
        .option("checkpointLocation", f"{out}/progress").trigger(availableNow=True).start()
    )
    job.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{out}/table")
