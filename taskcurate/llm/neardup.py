"""Near-duplicates by exact shingle similarity, with SimHash to thin out the candidates.

Texts are linked if their sets of ``SHINGLE`` = 5 word shingles (all words of a
shorter text) have a Jaccard similarity of ``MIN_ALIKE`` = 0.8 or more.  Sets of
that similarity differ in 10 of 64 SimHash bits on average, where wildcard
variants of segments no longer tell texts apart; so the keys that bring
candidates together come from the smallest hashes under ``BANDS`` x ``ROWS``
permutations (a pair of similarity 0.8 meets under one key with probability
1 - (1 - 0.8^5)^20 = 0.9996), and the fingerprint is the first test of those
that meet:

1. Equal sets are one node, so copies cost nothing.
2. Nodes with an equal band key meet.  A pair is a candidate if sizes, fingerprint
   (``radius`` bits) and 500 bits of the smallest hashes (five of each; at similarity 0.8 they
   differ in 50 bits on average, deviation 11) allow ``min_alike``.
3. Every candidate is verified on both shingle sets before it is a link.
4. A bucket of up to ``FEW`` nodes is held against itself.  In a larger one every
   node is held against ``HEADS`` heads, which connects a group of copies with
   a few pairs a node; then a bucket of up to ``MANY`` nodes is held against
   itself where nodes are still in different components.
5. What is left of a bucket with more nodes than that is split by a further band: its nodes
   meet again where a second key agrees too (probability 0.996 at similarity 0.8), and so on
   by rising band.  Each split is one more round of steps 4 and 5, so a bucket of
   n nodes whose pairs agree in a key with probability p takes log n / log 1/p of
   them, and never more than ``BANDS``.

Null and empty texts have the empty set and link.  Rows without ``doc_id`` take
part but never name a component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, join_texts, lists, per_batch, stored, text_key
from .components import components
from .simhash import SEED, keep_first, shingles

SHINGLE, MIN_ALIKE, RADIUS, BANDS, ROWS = 5, 0.8, 26, 20, 5
FEW, HEADS, MANY = 16, 4, 256
#: Bits kept of each smallest hash, and how many of them may differ: five deviations above the mean at similarity 0.8.
KEPT_BITS, MOST_UNLIKE = 5, 104
_FACTORS, _SHIFTS = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 1 << 12


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles(text, size)), np.uint64))


def set_print(hashes: np.ndarray) -> int:
    """SimHash of a set, as signed 64 bits."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _STEP):
        ones += np.unpackbits(hashes[i : i + _STEP].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def smallest(hashes: np.ndarray) -> np.ndarray:
    """The smallest hash under each of BANDS x ROWS permutations."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), _STEP):
        low = np.minimum(low, (hashes[i : i + _STEP, None] * _FACTORS + _SHIFTS).min(axis=0))
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), k) for k, r in enumerate(low.reshape(BANDS, ROWS))], np.uint64).view(np.int64)


def kept_bits(low: np.ndarray) -> np.ndarray:
    """``KEPT_BITS`` low bits of each smallest hash, as 64-bit words."""
    bits = np.unpackbits((low & np.uint64((1 << KEPT_BITS) - 1)).astype(np.uint8)[:, None], axis=1)[:, -KEPT_BITS:].ravel()
    return np.packbits(np.pad(bits, (0, -len(bits) % 64))).view(np.int64)


def _node_batch(size: int):
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for t in b.column("text").to_pylist():
            s = shingle_set(t, size)
            low = smallest(s)
            out.append((int(np.uint64(xxhash.xxh64_intdigest(s.tobytes())).view(np.int64)), len(s), set_print(s), band_keys(low), kept_bits(low)))
        cols = [pa.array([x[i] for x in out], pa.int64()) for i in range(3)] + [lists([x[i] for x in out], pa.int64()) for i in (3, 4)]
        return pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), *cols], ["doc_id", "key", "node", "size", "print", "bands", "low"])

    return run


def _set_batch(size: int):
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column("node"), lists([shingle_set(t, size).view(np.int64) for t in b.column("text").to_pylist()], pa.int64())], ["node", "hs"])

    return run


_WORDS = -(-BANDS * ROWS * KEPT_BITS // 64)


def _candidates(x: str, y: str, radius: int, min_alike: float) -> Column:
    """Whether two structs (node, size, print, low) may be of two alike sets."""
    x, y = F.col(x), F.col(y)
    unlike = sum((F.bit_count(x["low"][i].bitwiseXOR(y["low"][i])) for i in range(_WORDS)), F.lit(0))
    near = F.bit_count(x["print"].bitwiseXOR(y["print"])) <= radius
    return near & (F.least(x["size"], y["size"]) >= min_alike * F.greatest(x["size"], y["size"])) & (unlike <= MOST_UNLIKE)


def _verified(pairs: DataFrame, sets: DataFrame, min_alike: float) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity."""
    both = pairs.join(sets.toDF("a", "hs_a").hint("merge"), "a").join(sets.toDF("b", "hs_b").hint("merge"), "b")
    shared = F.size(F.array_intersect("hs_a", "hs_b"))
    return stored(both.where(shared >= min_alike * (F.size("hs_a") + F.size("hs_b") - shared)).select("a", "b"))


def _pairs(x: DataFrame, y: DataFrame, condition: Column) -> DataFrame:
    """Distinct pairs (a, b) of rows (bucket, x) and (bucket, y) of one bucket that meet the condition."""
    met = x.join(y, (x["bucket"] == y["bucket"]) & condition)
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _crowds(keyed: DataFrame, kept: list[str]) -> DataFrame:
    """Rows (bucket, node...) of buckets with more than one node, and their number n; counted before rows move."""
    counts = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    return keyed.join(counts, "bucket").select("bucket", "n", *kept)


def similar_groups(nodes: DataFrame, sets_of, radius: int = RADIUS, min_alike: float = MIN_ALIKE) -> DataFrame:
    """(node, root) of the nodes that are connected by verified links.

    ``nodes`` has node, size, print, bands and low; ``sets_of`` gives (node, hs) for a table of nodes.
    """
    info = F.struct("node", "size", "print", "low")
    about = nodes.select(info.alias("of"), F.col("node").alias("node__"))
    met = stored(_crowds(nodes.select(F.posexplode("bands").alias("band", "bucket"), "node"), ["band", "node"]))
    sets = stored(sets_of(met.select("node").distinct()))
    roots = None

    def side(rows: DataFrame, name: str, *more: str) -> DataFrame:
        return rows.join(about, F.col("node") == F.col("node__")).select("bucket", F.col("of").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in more])

    def connected(links: DataFrame) -> DataFrame:
        before = roots.select("node", "root").where("node <> root").toDF("a", "b") if roots is not None else links
        out = stored(components(links.union(before)))
        for old in (links, roots):
            if old is not None:
                discard(old)
        return out

    def open_buckets(rows: DataFrame) -> DataFrame:
        """``rows`` with root, of buckets whose nodes are in more than one component."""
        named = rows.join(roots.withColumnRenamed("node", "node__"), F.col("node") == F.col("node__"), "left").withColumn("root", F.coalesce("root", "node")).drop("node__")
        several = named.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("bucket")
        return stored(named.join(several, "bucket", "left_semi"))

    alike = _candidates("x", "y", radius, min_alike)
    while True:
        few, more = met.where(F.col("n") <= FEW), met.where(F.col("n") > FEW)
        heads = more.groupBy("bucket", F.pmod("node", F.lit(HEADS)).alias("head")).agg(F.min("node").alias("node"))
        pairs = _pairs(side(few, "x"), side(few, "y"), alike & (F.col("x.node") < F.col("y.node")))
        stars = _pairs(side(more, "x"), side(heads, "y"), alike & (F.col("x.node") != F.col("y.node")))
        roots = connected(_verified(pairs.union(stars).distinct(), sets, min_alike))
        rest = open_buckets(more)
        middle = rest.where(F.col("n") <= MANY)
        apart = alike & (F.col("x.node") < F.col("y.node")) & (F.col("x_root") != F.col("y_root"))
        roots = connected(_verified(_pairs(side(middle, "x", "root"), side(middle, "y", "root"), apart), sets, min_alike))
        left = open_buckets(rest.where(F.col("n") > MANY).drop("root"))
        discard(met)
        discard(rest)
        if left.isEmpty():
            discard(left)
            return roots
        bands = nodes.select(F.col("node").alias("node__"), F.posexplode("bands").alias("further", "key"))
        split = left.join(bands, (F.col("node") == F.col("node__")) & (F.col("further") > F.col("band")))
        met = stored(_crowds(split.select(F.xxhash64("bucket", "key").alias("bucket"), F.col("further").alias("band"), "node"), ["band", "node"]))
        discard(left)


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, min_alike: float = MIN_ALIKE) -> DataFrame:
    """(doc_id, key, component_id, stays) of each row; ``stays`` marks the row of a component to keep."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), "text")
    found = stored(per_batch(slim, _node_batch(size), "doc_id long, key long, node long, size long, print long, bands array<long>, low array<long>"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")
    each = stored(found.groupBy("node").agg(first, *(F.first(c).alias(c) for c in ("size", "print", "bands", "low"))))

    def sets_of(wanted: DataFrame) -> DataFrame:
        rows = each.join(wanted, "node").select("node", F.col("first.doc_id").alias("d__"), F.col("first.key").alias("k__"))
        texts = join_texts(slim, rows).select("node", "text")
        return per_batch(texts, _set_batch(size), "node long, hs array<long>").dropDuplicates(["node"])  # repeated rows

    roots = similar_groups(each.select("node", "size", "print", "bands", "low"), sets_of, radius, min_alike).withColumnRenamed("node", "node__")
    grouped = each.join(roots, F.col("node") == F.col("node__"), "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    named = grouped.join(grouped.groupBy("root").agg(F.min("first").alias("head")), "root").select("node", "head")
    return found.join(named, "node").select(
        "doc_id", "key", F.col("head.doc_id").alias("component_id"), (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("key").eqNullSafe(F.col("head.key")))).alias("stays")
    )


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, min_alike: float = MIN_ALIKE) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest ``doc_id``."""
    return keep_first(docs, near_duplicates(docs, size, radius, min_alike))
