"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has 64 bits: a bit is 1 if it is set in over half of the XXH64
hashes (seed 42) of the word shingles, repeats included.  Fingerprints at
``RADIUS`` = 3 or fewer differing bits link.  The 64 bits are cut into two
segments of 32, so one segment differs by one bit at most, and two such
segments agree once the right bit is left out: each fingerprint is indexed
under its 2 x 32 one-wildcard variants, equal keys meet, and the pairs are
verified on all bits.

Only distinct fingerprints are indexed, so copies cost nothing.  A bucket of
more than ``CROWDED`` fingerprints is cut again by the same rule (the other
segment in halves of 16 bits, one wildcard); after that 18 bits are free, which
bounds a bucket at 2^18 fingerprints.  A bucket yields at most one link per
member (to the smallest member of its local component), never all pairs.

Null and empty texts have fingerprint zero and link like any other.  Rows
without ``doc_id`` take part but never name a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import per_batch, stored, text_key
from .components import components

RADIUS, CROWDED, SHINGLE, SEED = 3, 256, 3, 42
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text: str | None, size: int) -> Iterator[bytes]:
    """Word shingles of a text (all words of a shorter one); words are runs of other than ASCII white space, ASCII letters lowered."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(0, len(words) - size)
    for a, b in zip(starts[: last + 1].tolist(), ends[min(size, len(words)) - 1 :].tolist(), strict=True):
        yield joined[a:b]


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Signed 64 bits of a text."""
    ones, digest, step = np.zeros(64, np.int64), xxhash.xxh64_digest, 1 << 15
    hashes = [digest(s, SEED) for s in shingles(text, size)]
    for i in range(0, len(hashes), step):
        ones += np.unpackbits(np.frombuffer(b"".join(hashes[i : i + step]), np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def _print_batch(size: int):
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array([fingerprint(t, size) for t in b.column("text").to_pylist()], pa.int64())
        return pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), found], ["doc_id", "key", "print"])

    return run


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, key, print) of each row."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), "text")
    return per_batch(slim, _print_batch(size), "doc_id long, key long, print long")


def local_links(prints: np.ndarray) -> list[tuple[int, int]]:
    """(member, smallest member) within each component, at RADIUS, of one bucket of distinct fingerprints."""
    rest, out = np.sort(prints), []
    while len(rest) > 1:
        root, todo, rest = int(rest[0]), [rest[0]], rest[1:]
        while todo and len(rest):
            near = np.bitwise_count((rest ^ todo.pop()).view(np.uint64)) <= RADIUS
            if near.any():
                out += [(x, root) for x in rest[near].tolist()]
                todo += list(rest[near])
                rest = rest[~near]
    return out


def _link_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of buckets; the rows of a bucket follow one another and may span batches."""

    def links(buckets: list[np.ndarray]) -> pa.RecordBatch:
        found = {x for b in buckets for x in local_links(b)}
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    at, held = None, []
    for b in batches:
        keys, prints = (np.stack([b.column(c).to_numpy() for c in ("bucket", "part")]), b.column("print").to_numpy())
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        parts, whole = np.split(prints, cuts), []
        for first, p in zip([0, *cuts.tolist()], parts, strict=True):
            if len(p):
                if at != (key := tuple(keys[:, first].tolist())):
                    whole += [np.concatenate(held)] if held else []
                    at, held = key, []
                held.append(p)
        yield links(whole)
    if held:
        yield links([np.concatenate(held)])


def _variants(segments: list[Column], bits: int) -> Column:
    """Keys of each segment with one bit left out: segment number, bit and rest as one number."""
    return F.array(*(segment.bitwiseAND(F.lit((1 << bits) - 1 ^ 1 << i)) + F.lit((k << 40) + (i << 32)) for k, segment in enumerate(segments) for i in range(bits)))


def links(prints: DataFrame) -> DataFrame:
    """(a, b) links of distinct fingerprints (column ``print``) that connect exactly what lies within RADIUS."""
    low, high = F.col("print").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned("print", 32)
    indexed = prints.select("print", F.explode(_variants([low, high], 32)).alias("bucket"))
    met = stored(indexed.withColumn("n", F.count("*").over(Window.partitionBy("bucket"))).where("n > 1"))
    few = met.where(F.col("n") <= CROWDED).select("bucket", F.lit(-1).cast("long").alias("part"), "print")
    other = F.when(F.col("bucket") < F.lit(1 << 40), high).otherwise(low)
    quarters = [other.bitwiseAND(F.lit((1 << 16) - 1)), F.shiftrightunsigned(other, 16)]
    many = met.where(F.col("n") > CROWDED).select("bucket", F.explode(_variants(quarters, 16)).alias("part"), "print")
    dealt = few.union(many).repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    return dealt.mapInArrow(_link_buckets, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, key, print, component_id, stays) of each row; ``stays`` marks the row of a component to keep."""
    found = stored(fingerprints(docs, size))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")
    each = stored(found.groupBy("print").agg(first))
    roots = stored(components(links(each.select("print"))))
    grouped = each.join(roots, F.col("print") == F.col("node"), "left").select("print", "first", F.coalesce("root", "print").alias("root"))
    named = grouped.join(grouped.groupBy("root").agg(F.min("first").alias("head")), "root").select("print", "head")
    return found.join(named, "print").select(
        "doc_id", "key", "print", F.col("head.doc_id").alias("component_id"), (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("key") == F.col("head.key"))).alias("stays")
    )


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with the rows that ``found`` (doc_id, key, stays) marks, each once."""
    stay = found.where("stays").select(F.col("doc_id").alias("d__"), F.col("key").alias("k__")).distinct()
    kept = docs.withColumn("k0__", text_key(F.col("text"))).join(stay.hint("merge"), F.col("doc_id").cast("long").eqNullSafe(F.col("d__")) & (F.col("k0__") == F.col("k__")), "left_semi")
    return kept.dropDuplicates(["doc_id", "k0__"]).select(*docs.columns)


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest ``doc_id``."""
    return keep_first(docs, near_duplicates(docs, size))
