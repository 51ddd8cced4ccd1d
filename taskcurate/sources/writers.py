"""Sinks.  Every output is a folder written by all tasks under Spark's commit protocol.

An output that is replaced is first written beside the old one, as a whole, and
then takes its name: a job that fails leaves the old output as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F

from ..operators.reports import review_sheet
from .scratch import put_in_place


def _replace(df: DataFrame, path: str, kind: str, prepare=lambda w: w) -> None:
    new = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    writer: DataFrameWriter = prepare(df.write)
    writer.format(kind).save(new)
    put_in_place(df.sparkSession, new, path)


def write_replacing(df: DataFrame, path: str, manifest: str | None = None) -> int:
    """Replace the JSON-lines output; the row count, observed while writing, goes to the manifest."""
    seen = Observation("rows")
    _replace(df.observe(seen, F.count(F.lit(1)).alias("n")), path, "json")
    n = seen.get["n"]
    if manifest is not None:
        row = df.sparkSession.createDataFrame([(path, n)], "path string, n_rows bigint")
        row.write.mode("append").json(manifest)
    return n


def write_appending(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_table(df: DataFrame, path: str) -> None:
    _replace(df, path, "parquet")


def write_split(df: DataFrame, path: str, by: str = "verdict") -> None:
    """Kept and rejected rows side by side, one folder per verdict."""
    _replace(df.withColumn("_split", F.col(by)), path, "json", lambda w: w.partitionBy("_split"))


def write_review_sheet(df: DataFrame, path: str) -> None:
    _replace(review_sheet(df), path, "csv", lambda w: w.option("header", True).option("quoteAll", True).option("escape", '"'))


def write_training(rows: DataFrame, path_all: str, path_solved: str) -> None:
    """All histories, and those of solved runs, as JSON lines."""
    _replace(rows.select("line"), path_all, "text")
    _replace(rows.filter("solved").select("line"), path_solved, "text")


def write_submission(df: DataFrame, path: str) -> None:
    _replace(df.select("instance_id", "model_name_or_path", "model_patch"), path, "json")
