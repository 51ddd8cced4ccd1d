"""Target-distribution importance resampling by bit-sliced aggregation.

The features of a text are its runs of 1 to ``RUN`` words; each falls into one of
``BUCKETS`` buckets by its CRC32.  The counts of a document are held as bit
planes: plane i has bit b set if bit i of the count of bucket b is set.  The
gain of a bucket, floor(1000 ln of the ratio of its smoothed shares in the target
and in the documents), is held as planes too, in two's complement: the last
plane counts negative.  A document's sum of gains is then exact and made of
whole words only: AND of every count plane with every gain plane, population
count, times two to the power of both plane numbers.

The planes of all documents are a table; the bucket totals are summed from them,
one array for each task, and only these ``BUCKETS`` numbers reach the driver.
Documents are drawn by their mean gain plus Gumbel noise from a digest of the
``doc_id``, so the highest scores are a sample without replacement.  Ranks come
from counts per score, blockwise: no task sorts more than the documents of one
score.

Null texts have no words.  A document without features has weight 0 and still a
score.  Rows that repeat are documents of their own with equal scores.  A null
``doc_id`` counts as an empty string in the digest and as the largest in ties.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taskcurate.operators.ordered import numbered

from .common import join_texts, shared_folder, text_key

BUCKETS, RUN, LEAST_WORDS, PERCENT, SALT = 10_000, 1, 20, 10, "2024"
#: Words whose buckets a worker remembers; then it starts anew.
MAX_KNOWN = 1 << 18
_SPACES = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8: A-Z in lower case, cut at all ASCII but letters and digits."""
    return (text or "").encode().lower().translate(_SPACES).split()


def bucket_counts(found: list[bytes], run: int, buckets: int, known: dict[bytes, int]) -> np.ndarray:
    """How many features of a text fall into each bucket."""
    counts = np.zeros(buckets, np.int64)
    for n in range(1, run + 1):
        held = Counter(found if n == 1 else (b" ".join(found[i : i + n]) for i in range(len(found) - n + 1)))
        if len(known) > MAX_KNOWN:
            known.clear()
        for x in held:
            if x not in known:
                known[x] = zlib.crc32(x) % buckets
        np.add.at(counts, np.fromiter(map(known.__getitem__, held), np.int64, len(held)), np.fromiter(held.values(), np.int64, len(held)))
    return counts


def count_planes(counts: np.ndarray) -> bytes:
    """The bit planes of counts, lowest first, each in whole 64-bit words."""
    return b"".join(_plane(counts >> i & 1) for i in range(int(counts.max(initial=0)).bit_length()))


def _plane(bits: np.ndarray) -> bytes:
    packed = np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()
    return packed + bytes(-len(packed) % 8)


def words_of(planes: bytes, buckets: int) -> np.ndarray:
    """Planes as rows of 64-bit words."""
    return np.frombuffer(planes, np.uint64).reshape(-1, -(-buckets // 64))


def gain_planes(gains: list[int]) -> np.ndarray:
    """Gains in two's complement: rows of 64-bit words, the last one negative."""
    g = np.array(gains, np.int64)
    n = max(int(np.abs(g).max(initial=0)).bit_length(), 1) + 1
    return np.concatenate([words_of(_plane(g >> j & 1), len(gains)) for j in range(n)])


def weighted_sum(counts: np.ndarray, gains: np.ndarray) -> int:
    """Exact sum of count times gain over the buckets, from the planes of both."""
    total, last = 0, len(gains) - 1
    for i, plane in enumerate(counts):
        for j, ones in enumerate(np.bitwise_count(plane & gains).sum(axis=1, dtype=np.int64).tolist()):
            total += ones << i + j if j < last else -(ones << i + j)
    return total


def planes(texts: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, key, n_words, n_features, planes) of each row of ``texts`` (doc_id, text), stored."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for b in batches:
            out = []
            for text in b.column("text"):  # one text at a time in Python's memory
                found = words(text.as_py())
                counts = bucket_counts(found, run, buckets, known)
                out.append((len(found), int(counts.sum()), count_planes(counts)))
            cols = [pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), *cols], ["doc_id", "key", "n_words", "n_features", "planes"])

    slim = texts.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), "text")
    path = shared_folder(texts.sparkSession)
    out = slim.mapInArrow(cut, "doc_id long, key long, n_words long, n_features long, planes binary")
    out.write.option("compression", "zstd").parquet(path)  # mostly zeros
    return texts.sparkSession.read.schema(out.schema).parquet(path)


def totals(table: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows in each bucket; a task sends one number for each bucket that it met."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for held in b.column("planes"):
                for i, plane in enumerate(words_of(held.as_py(), buckets)):
                    total += np.unpackbits(plane.view(np.uint8), count=buckets, bitorder="little").astype(np.int64) << i
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in table.select("planes").mapInArrow(add, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of each bucket, in doubles."""
    b = len(documents)
    over, under = float(int(documents.sum()) + b), float(int(target.sum()) + b)
    return [math.floor(1000 * math.log((t + 1.0) * over / ((s + 1.0) * under))) for s, t in zip(documents.tolist(), target.tolist(), strict=True)]


def noise(doc_id: Column, salt: str = SALT) -> Column:
    """floor(1000 x Gumbel noise) from the first 32 bits of sha256(``salt:doc_id``)."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def scored(docs: DataFrame, target: DataFrame, run: int = RUN, buckets: int = BUCKETS, salt: str = SALT) -> DataFrame:
    """(doc_id, key, n_words, n_features, weight, score) of each row of ``docs``; ``target`` has a text column."""
    held = planes(docs, run, buckets)
    wanted = planes(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), run, buckets)
    gain = gain_planes(gains(totals(held, buckets), totals(wanted, buckets)))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = [weighted_sum(words_of(x.as_py(), buckets), gain) for x in b.column("planes")]
            weights = [s // n if n else 0 for s, n in zip(sums, b.column("n_features").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "key", "n_words", "n_features")), pa.array(weights, pa.int64())], ["doc_id", "key", "n_words", "n_features", "weight"])

    weighed = held.mapInArrow(weigh, "doc_id long, key long, n_words long, n_features long, weight long")
    return weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), salt))


def ranked(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS, run: int = RUN, buckets: int = BUCKETS, salt: str = SALT) -> DataFrame:
    """The columns of :func:`scored` and ``rank``: 1, 2, 3... for the drawn, null for the others.

    Of the N rows of ``least`` words or more, floor(``percent`` N / 100) are drawn: the highest
    scores, ties to the smaller ``doc_id``, then key.
    """
    rows = scored(docs, target, run, buckets, salt)
    path = shared_folder(docs.sparkSession)
    rows.write.parquet(path)
    rows = docs.sparkSession.read.schema(rows.schema).parquet(path)
    score, enough = F.col("score"), F.col("n_words") >= least
    drawn = rows.where(enough).count() * percent // 100
    order = [score.desc(), F.col("doc_id").asc_nulls_last(), F.col("key"), F.col("n_features")]
    # scores are whole thousandths within some ten thousands, however many rows there are
    placed = numbered(rows.where(enough), [], order, [F.floor(-score / 256), -score], "rank")
    placed = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return placed.union(rows.where(~enough).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn rows of ``docs``, all columns; a row that repeats comes with all its copies if one is drawn."""
    drawn = ranked(docs, target, **settings).where(F.col("rank").isNotNull())
    return join_texts(docs, drawn.select(F.col("doc_id").alias("d__"), F.col("key").alias("k__")).distinct(), "left_semi")
