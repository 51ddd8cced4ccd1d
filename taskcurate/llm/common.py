"""Helpers shared by the text operators: shared folder, written tables, row keys, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors see.

    Only a local session, as in tests, may leave that setting unset; a
    temporary folder is used then.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table of the shared folder and read again: lineage ends here, and a lost executor costs no recomputation."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the folder of a :func:`stored` table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers started elsewhere than in this folder still find the package; installed packages need no such help
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: Column) -> Column:
    """64 bits of a text; with ``doc_id`` the key of a row. Rows that agree in both are repeats of one row."""
    return F.xxhash64(text)


def join_texts(docs: DataFrame, rows: DataFrame, how: str = "inner") -> DataFrame:
    """``docs`` joined with ``rows`` (d__, k__ and more), which are keyed by doc_id and text key.

    Always by shuffle and merge: what the rows hold grows with the documents, so
    a plan that turns to a broadcast on little data would say nothing about much.
    """
    return docs.join(rows.hint("merge"), F.col("doc_id").cast("long").eqNullSafe(F.col("d__")) & (text_key(F.col("text")) == F.col("k__")), how)


def per_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType) -> DataFrame:
    """``fn`` on each Arrow batch of ``df``; batches are bounded in bytes by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield fn(b)

    return df.mapInArrow(run, schema)


def lists(rows: list, kind: pa.DataType) -> pa.ListArray:
    """A list column from Python sequences."""
    offsets, flat = [0], []
    for r in rows:
        flat.extend(r)
        offsets.append(len(flat))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))
