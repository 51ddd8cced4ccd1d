"""Benchmark decontamination, in DataFrame functions only.

Words are runs of letters, marks and digits, lowered; a shingle is five words
(all words of a shorter text).  A window has as many words as the benchmark
item that it is held against (a shorter document is one window).  A document
leaks an item if a window has a weighted shingle similarity, the sum of the
smaller counts over the sum of the larger ones, of ``MIN_ALIKE`` = 0.8 or more.

1. Windows start where a shingle of an item of their size stands: a window
   without one has similarity 0, and moving a window forward to its first such
   shingle (or to the end of the text) never lowers its similarity.
2. Each window and item gets a 64-bit SimHash over its weighted shingles.
3. Multi-index: eight blocks of eight bits. Within ``RADIUS`` = 23 bits one
   block differs by two bits at most, so items are indexed under the 37 values
   that near each of their blocks, and windows of the same size probe by
   equality. All fingerprints within the radius meet. Shingle sets of
   similarity 0.8 differ in 10 of 64 bits on average, 23 is over four standard
   deviations away.
4. The exact similarity of each pair within the radius decides.

The benchmark is the query set; its shingles are broadcast only if there are at
most ``MAX_BROADCAST`` of them, beyond that they are joined by shuffle.

Null and empty texts, of documents and of items, hold no words and match
nothing.  Items without ``item_id`` are reported with null.  Repeated rows give
the same pairs once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_texts, stored, text_key

SHINGLE, MIN_ALIKE, RADIUS, BLOCKS, MAX_BROADCAST = 5, 0.8, 23, 8, 500_000
#: Values of one byte with two bits set at most: what two equal-position blocks may differ by.
NEAR_BYTES = [x for x in range(256) if bin(x).count("1") <= 2]


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def with_shingles(df: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``hs``: the 64-bit hashes of the shingles of ``text``, in order.

    The word array is a column of its own: it is made once, not once for each shingle.
    """
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w__") - SHINGLE + 1, F.lit(1))), lambda i: F.xxhash64(F.slice("w__", i, SHINGLE)))
    return df.select(*keep, words(F.col("text")).alias("w__")).select(*keep, F.when(F.size("w__") > 0, cut).otherwise(F.array().cast("array<bigint>")).alias("hs"), F.size("w__").alias("n_words"))


def with_simhash(weighted: DataFrame, keys: list[str], width: int) -> DataFrame:
    """(keys, h, n) -> (keys, print, total): majority bits of the hashes, each counting n times.

    A sum holds 64 / width counters of ``width`` bits; a window holds fewer than 2^width shingles.
    """
    sums, places = range(width), range(64 // width)
    lane, full = sum(1 << (width * j) for j in places), (1 << width) - 1
    packed = weighted.groupBy(*keys).agg(*(F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(lane)) * F.col("n")).alias(f"s{k}") for k in sums), F.sum("n").alias("total"))
    bit = lambda k, j: F.shiftleft((2 * F.shiftrightunsigned(f"s{k}", width * j).bitwiseAND(F.lit(full)) > F.col("total")).cast("long"), width * j + k)
    return packed.select(*keys, reduce(Column.bitwiseOR, [bit(k, j) for k in sums for j in places]).alias("print"), "total")


def _blocks(value: Column) -> Column:
    return F.array(*(F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(value, 8 * i).bitwiseAND(F.lit(255)).alias("bits")) for i in range(BLOCKS)))


def _blocks_nearby(value: Column) -> Column:
    near = F.array(*map(F.lit, NEAR_BYTES))
    return F.flatten(F.transform(_blocks(value), lambda b: F.transform(near, lambda x: F.struct(b["block"].alias("block"), b["bits"].bitwiseXOR(x.cast("long")).alias("bits")))))


def leaks(docs: DataFrame, items: DataFrame, min_alike: float = MIN_ALIKE, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """(doc_id, key, item_id, start, similarity): the best window (ties: the first) of each leaking document and item."""
    item = with_shingles(items.select("item_id", "text"), "item_id").where("n_words > 0")
    item = stored(item.select(F.xxhash64("hs", "n_words").alias("item"), "item_id", F.col("n_words").alias("len"), "hs").distinct())
    item_rows = item.select("item", "len", "hs").distinct().select("item", "len", F.explode("hs").alias("h")).groupBy("item", "len", "h").agg(F.count("*").alias("n"))
    wanted = item_rows.select("h", "len").distinct()
    if wanted.count() <= max_broadcast:
        wanted = F.broadcast(wanted)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), "text")
    # the outer forms keep the optimizer from testing the array's size below, where it would be made anew for each shingle
    hashed = with_shingles(slim, "doc_id", "key")
    seeds = hashed.select("doc_id", "key", "n_words", F.posexplode_outer("hs").alias("pos", "h")).join(wanted, "h")
    # the last full window starts len words before the end; a shorter text is one window
    starts = stored(seeds.select("doc_id", "key", F.least("pos", F.greatest(F.col("n_words") - F.col("len"), F.lit(0))).alias("start"), "len").distinct())

    windows = starts.groupBy("doc_id", "key").agg(F.collect_set(F.struct("start", "len")).alias("windows")).select(F.col("doc_id").alias("d__"), F.col("key").alias("k__"), "windows")
    met = with_shingles(join_texts(slim, windows), "doc_id", "key", "windows")
    cut = met.select("doc_id", "key", "hs", F.explode("windows").alias("w")).select(
        "doc_id", "key", F.col("w.start").alias("start"), F.col("w.len").alias("len"), F.explode_outer(F.slice("hs", F.col("w.start") + 1, F.greatest(F.col("w.len") - SHINGLE + 1, F.lit(1)))).alias("h")
    )
    at = ["doc_id", "key", "start", "len"]
    weighted = stored(cut.groupBy(*at, "h").agg(F.count("*").alias("n")))
    width = 16 if (item.agg(F.max("len")).first()[0] or 0) < 1 << 16 else 32
    prints = stored(with_simhash(weighted, at, width))
    item_prints = stored(with_simhash(item_rows, ["item", "len"], width))

    probes = prints.select(*at, "print", F.col("total").alias("w_total"), F.inline(_blocks(F.col("print"))))
    index = item_prints.select("item", "len", F.col("print").alias("item_print"), F.col("total").alias("i_total"), F.inline(_blocks_nearby(F.col("print"))))
    close = probes.join(index, ["len", "block", "bits"]).where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
    pairs = close.select(*at, "item", "w_total", "i_total").distinct()

    # the overlap is computed for the pairs of the index alone: their windows' shingles, then the item's
    close = pairs.withColumnsRenamed({c: f"{c}__" for c in at})
    of_window = weighted.join(close, [weighted["doc_id"].eqNullSafe(F.col("doc_id__")), *(weighted[c] == F.col(f"{c}__") for c in at if c != "doc_id")]).drop(*(f"{c}__" for c in at))
    shared = of_window.join(item_rows.withColumnRenamed("n", "m"), ["item", "len", "h"]).groupBy(*at, "item", "w_total", "i_total").agg(F.sum(F.least("n", "m")).alias("both"))
    found = shared.select("doc_id", "key", "start", "item", (F.col("both") / (F.col("w_total") + F.col("i_total") - F.col("both"))).alias("similarity"))
    best = found.where(F.col("similarity") >= min_alike).groupBy("doc_id", "key", "item").agg(F.max_by(F.struct("start", "similarity"), F.struct("similarity", -F.col("start"))).alias("best"))
    return best.join(item.select("item", "item_id"), "item").select("doc_id", "key", "item_id", "best.start", "best.similarity")


def decontaminate(docs: DataFrame, items: DataFrame, min_alike: float = MIN_ALIKE) -> DataFrame:
    """``docs`` without the documents that leak an item."""
    out = leaks(docs, items, min_alike).select(F.col("doc_id").alias("d__"), F.col("key").alias("k__")).distinct()
    return join_texts(docs, out, "left_anti")
