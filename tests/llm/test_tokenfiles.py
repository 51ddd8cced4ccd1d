"""Flat token files that no single cell could hold."""

import os

import numpy as np

from taskcurate.llm import catalog, tokenfiles


def test_ranges_of_a_file_too_long_for_a_cell(spark, tmp_path):
    """The cell limit, 2 GiB by default, is set below the file's length."""
    ids = np.arange(1000) % 10
    ids.astype("<u2").tofile(tmp_path / "long")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 100)
    try:
        rows = tokenfiles.token_counts(spark, str(tmp_path), eod=9, block=64).collect()
        tasks = tokenfiles.blocks(spark, str(tmp_path), eod=9, block=64).selectExpr("spark_partition_id() AS p").distinct().count()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert sorted((r.doc_no, r.start, r.n_tokens, r.closed) for r in rows) == [(i, 10 * i, 9, True) for i in range(100)]
    assert tasks > 1


def test_files_are_bounded_in_bytes(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"w{i} " * 200) for i in range(40)], "doc_id long, text string").coalesce(1)
    tokenfiles.write(docs, str(tmp_path / "f"), catalog.BYTE_BPE, bytes_per_file=4000)
    sizes = [os.path.getsize(tmp_path / "f" / x) for x in os.listdir(tmp_path / "f") if x.startswith("part-")]
    assert len(sizes) > 10 and max(sizes) <= 4000
