"""Token counts by a separator scan of flat token files.

A flat file holds the ids of one document after another as little-endian
unsigned 16- or 32-bit integers, each document closed by the end-of-document
id, and no index.  Files are cut, by their lengths, into blocks of ``BLOCK`` ids
that are dealt over all tasks; a task reads only the bytes of its blocks from the
shared file, and one vectorised comparison finds the separators of a block.  A document that crosses blocks
begins behind the last separator before its block: a running last over the
block rows of a file (and a running count for its number) stitches the ends.

A file is a stream of its own; ids behind its last separator are a document
without end.  Empty documents count 0 tokens.  An empty file holds none.
``write`` bounds files by ``DOCS_PER_FILE`` documents and ``BYTES_PER_FILE``
bytes (a longer document has a file of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import codec, text_runs
from .common import stored

BLOCK, DOCS_PER_FILE, BYTES_PER_FILE, EOD = 1 << 20, 8192, 1 << 30, 50256


def write(docs: DataFrame, path: str, file: str, eod: int = EOD, width: int = 2, docs_per_file: int = DOCS_PER_FILE, bytes_per_file: int = BYTES_PER_FILE) -> None:
    """Flat token files of all texts (null: empty), below ``path``.

    Strings of added tokens are ordinary text here, so only the end of a
    document gives ``eod``.  Spark's text writer takes the ids as raw bytes and
    the separator's bytes as line end; a failed task's file is never kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(file)
        for b in batches:
            for texts in text_runs(b):
                ids = [np.frombuffer(x, "<u4").astype(f"<u{width}").tobytes() for x in c.encode_texts(texts, added=False)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    # a token stands for one byte of the text at least
    longest = docs.agg(F.max(F.octet_length("text"))).first()[0] or 0
    docs_per_file = max(1, min(docs_per_file, bytes_per_file // (width * (longest + 1))))
    end = eod.to_bytes(width, "little").decode("latin-1")
    out = docs.select("text").mapInArrow(run, "ids binary").select(F.col("ids").cast("string").alias("value"))
    out.write.option("lineSep", end).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", docs_per_file).text(path)


def blocks(spark: SparkSession, path: str, eod: int = EOD, width: int = 2, block: int = BLOCK) -> DataFrame:
    """(path, block, tokens, ends): the places, in the file, of the separators of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, i in zip(b.column("path").to_pylist(), b.column("block").to_pylist(), strict=True):
                with _opened(name) as f:
                    part = np.frombuffer(f.read_at(min(block * width, f.size() - i * block * width), i * block * width), f"<u{width}")
                ends = pa.array([np.flatnonzero(part == eod) + i * block], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([i], pa.int64()), pa.array([len(part)], pa.int64()), ends], ["path", "block", "tokens", "ends"])

    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")  # lengths only, no content
    places = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / (block * width)))).alias("block"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # given as a number, as rows this short would be put together again
    return places.repartition(tasks, "path", "block").mapInArrow(run, "path string, block long, tokens long, ends array<long>")


def _opened(name: str) -> pa.NativeFile:
    """A file of a store that all executors see, by Spark's name of it."""
    if name.startswith("file:"):
        return pyarrow.fs.LocalFileSystem().open_input_file("/" + name.removeprefix("file:").lstrip("/"))
    store, path = pyarrow.fs.FileSystem.from_uri(name)
    return store.open_input_file(path)


def token_counts(spark: SparkSession, path: str, eod: int = EOD, width: int = 2, block: int = BLOCK) -> DataFrame:
    """(path, doc_no, start, n_tokens, closed) of each document, numbered from 0 in its file."""
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    last = F.element_at(F.col("ends"), -1)
    scanned = stored(blocks(spark, path, eod, width, block))
    # one short row per block is all that a file's window holds
    found = scanned.select(
        "path", "block", "tokens", F.size("ends").alias("n_ends"), F.when(F.size("ends") > 0, last).alias("last"), F.row_number().over(Window.partitionBy("path").orderBy(F.desc("block"))).alias("from_end")
    )
    stitched = found.select(
        "path", "block", "from_end", (F.coalesce(F.last("last", ignorenulls=True).over(before), F.lit(-1)) + 1).alias("begin"),
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("n_before"), F.sum("tokens").over(whole).alias("total"),
    ).join(scanned.select("path", "block", "ends"), ["path", "block"])
    starts = F.concat(F.array("begin"), F.transform("ends", lambda e: e + 1))  # of each document that ends here, and of what is left
    closed = stitched.select("path", "n_before", F.posexplode(F.arrays_zip(F.slice(starts, 1, F.size("ends")).alias("start"), F.col("ends").alias("stop"))).alias("i", "d")).select(
        "path", (F.col("n_before") + F.col("i")).alias("doc_no"), F.col("d.start").alias("start"), (F.col("d.stop") - F.col("d.start")).alias("n_tokens"), F.lit(True).alias("closed")
    )
    rest = F.element_at(starts, -1)
    opened = stitched.where((F.col("from_end") == 1) & (rest < F.col("total"))).select(
        "path", (F.col("n_before") + F.size("ends")).alias("doc_no"), rest.alias("start"), (F.col("total") - rest).alias("n_tokens"), F.lit(False).alias("closed")
    )
    return closed.union(opened)
