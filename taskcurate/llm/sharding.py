"""Sharding by a minimax contiguous partition, in DataFrame functions only.

Law ``bytes``: rows with equal texts form one atomic group, groups stand in the
order of their key (SHA-256 of the text), and consecutive groups go into at
most ``shards`` shards so that the largest shard is as small as possible.  The
smallest feasible capacity is found by binary search; a capacity is checked
greedily, filling each shard as far as the groups allow.

A greedy check only needs, for a byte position, the last group end at or before
it.  Of the group ends, the driver holds the first and the last of each bucket
of positions (about ``BUCKETS`` buckets, whatever the input), which bounds every
answer from both sides.  Capacities that pass with the lower bounds are
feasible, those that fail with the upper bounds are not; the stretches in
which the two still differ are bucketed anew, each round some twenty times
finer, until one capacity and exact cuts are left.

Among partitions with that largest shard, cuts are moved to even out the rest:
a shard stops at its share of what remains wherever the rest still fits.

Null and empty texts have no bytes (size 16 each) and form one group.  Repeated
rows are rows: each gets a slot.  An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SHARDS, ROW_BYTES, BUCKETS, RUN = 40, 16, 1 << 15, 10


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, group (digest, and its first 12 bits), and two levels of runs of neighbouring ids, of each row."""
    raw = F.coalesce(F.col("text"), F.lit(""))
    digest = F.sha2(raw.cast("binary"), 256)
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"), F.crc32(raw.cast("binary")).alias("text_crc32"),
        F.unhex(digest).alias("grp"), F.conv(F.substring(digest, 1, 3), 16, 10).cast("int").alias("lead"),
        F.shiftright(number, 2 * RUN).alias("long_run"), F.shiftright(number, RUN).alias("run"),
    )


def with_ends(groups: DataFrame) -> DataFrame:
    """(lead, grp, bytes, n) -> grp, bytes and n, and both summed up to the end of the group; leads are summed apart, then put one after another."""
    totals = groups.groupBy("lead").agg(F.sum("bytes").alias("lead_bytes"), F.sum("n").alias("lead_n"))
    over = Window.orderBy("lead").rowsBetween(Window.unboundedPreceding, -1)  # 4,096 rows at most
    before = totals.select("lead", *(F.coalesce(F.sum(f"lead_{c}").over(over), F.lit(0)).alias(f"{c}_before") for c in ("bytes", "n")))
    inside = Window.partitionBy("lead").orderBy("grp").rowsBetween(Window.unboundedPreceding, 0)
    summed = groups.select("*", F.sum("bytes").over(inside).alias("b"), F.sum("n").over(inside).alias("r"))
    return summed.join(before, "lead").select("grp", "bytes", "n", (F.col("bytes_before") + F.col("b")).alias("stop"), (F.col("n_before") + F.col("r")).alias("row_stop"))


class Ends:
    """Group ends by buckets of positions: the first and the last end of each, in order."""

    def __init__(self, buckets: list[tuple[int, int]], total: int):
        self.buckets, self.total = buckets, total
        self.firsts = [a for a, _ in buckets]

    def at_most(self, x: int) -> tuple[int, int]:
        """Bounds of the last end <= x; the lower one is an end."""
        i = bisect_right(self.firsts, x) - 1
        if i < 0:
            return 0, 0
        first, last = self.buckets[i]
        return (last, last) if last <= x else (first, x if last > first else first)

    def filled(self, capacity: int, shards: int, side: int, at: int = 0) -> list[tuple[int, int]]:
        """Bounds of the ends of greedily filled shards, each filled from the lower (0) or upper (1) bound of the one before."""
        out: list[tuple[int, int]] = []
        while at < self.total and len(out) < shards:
            out.append(self.at_most(at + capacity))
            at = out[-1][side]
        return out

    def fits(self, capacity: int, shards: int, side: int, at: int = 0) -> bool:
        return at >= self.total or bool(shards) and self.filled(capacity, shards, side, at)[-1][side] >= self.total


def smallest(holds, below: int, enough: int) -> int:
    """Binary search: the smallest value above ``below`` that ``holds``; ``enough`` does."""
    while enough - below > 1:
        middle = (below + enough) // 2
        below, enough = (below, middle) if holds(middle) else (middle, enough)
    return enough


def capacity_and_ends(groups: DataFrame, shards: int, total: int, largest: int, buckets: int = BUCKETS) -> tuple[int, Ends]:
    """The smallest feasible capacity, with group ends known well enough to cut there."""
    parts, known, width = [(0, total)], [], total
    while True:
        width = max(1, min(-(-sum(b - a for a, b in parts) // buckets), -(-width // 2)))
        part = F.lit(None).cast("int")
        for i, (a, b) in enumerate(parts):
            part = F.when((F.col("stop") > a) & (F.col("stop") <= b), i).otherwise(part)
        found = groups.select("stop", part.alias("part")).where("part is not null").groupBy("part", F.floor(F.col("stop") / width).alias("b")).agg(F.min("stop"), F.max("stop")).collect()
        known = sorted([k for k in known if not any(a < k[1] <= b for a, b in parts)] + [(r[2], r[3]) for r in found])
        ends = Ends(known, total)
        below = max(largest, -(-total // shards)) - 1
        sure = smallest(lambda c: ends.fits(c, shards, 0), below, total)
        maybe = smallest(lambda c: ends.fits(c, shards, 1), below, total)
        cuts = ends.filled(sure, shards, 0)
        if sure == maybe and all(a == b for a, b in cuts):
            return sure, ends
        low, high = [a for a, _ in ends.filled(maybe, shards, 0)], [b for _, b in ends.filled(sure, shards, 1)]
        high += [total] * (len(low) - len(high))
        parts = []
        for a, b in zip(low, high, strict=False):  # every greedy cut of a capacity from maybe to sure lies in its stretch
            i, j = max(0, bisect_right(ends.firsts, a) - 1), bisect_right(ends.firsts, b) - 1
            a, b = known[i][0] - 1, known[max(i, j)][1]
            if parts and parts[-1][1] >= a:
                a, b = parts[-1][0], max(b, parts.pop()[1])
            parts.append((a, b))


def even_cuts(ends: Ends, capacity: int, shards: int) -> list[int]:
    """Shard ends within the capacity, each at its share of the rest where the rest still fits, else filled."""
    at, out = 0, []
    while at < ends.total:
        left = shards - len(out)
        cut = ends.at_most(at - (at - ends.total) // left)[0]
        if cut <= at or not ends.fits(capacity, left - 1, 0, cut):
            cut = ends.at_most(at + capacity)[0]
        out.append(cut)
        at = cut
    return out


def shards_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of each row, and the capacity (bytes of the largest shard allowed)."""
    rows = stored(sized(docs))
    runs = stored(rows.groupBy("grp", "lead", "long_run", "run").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")))
    groups = stored(with_ends(runs.groupBy("grp", "lead").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))))
    total, largest = groups.agg(F.sum("bytes"), F.max("bytes")).first()
    capacity, cuts = 0, []
    if total:
        capacity, ends = capacity_and_ends(groups, shards, total, largest)
        cuts = even_cuts(ends, capacity, shards)
    shard: Column = F.lit(0)
    for c in cuts[:-1]:
        shard = shard + (F.col("stop") > c).cast("int")
    placed = groups.select("grp", shard.alias("shard"), (F.col("row_stop") - F.col("n")).alias("row_start"))
    starts = placed.groupBy("shard").agg(F.min("row_start").alias("shard_start"))
    placed = placed.join(F.broadcast(starts), "shard").select("grp", "shard", (F.col("row_start") - F.col("shard_start")).alias("slot_start"))  # at most `shards` rows

    def before(*keys: str) -> Window:
        return Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)

    longs = runs.groupBy("grp", "long_run").agg(F.sum("n").alias("n")).select("grp", "long_run", F.coalesce(F.sum("n").over(before("grp", "long_run")), F.lit(0)).alias("long_before"))
    shorts = runs.select("grp", "long_run", "run", F.coalesce(F.sum("n").over(before("grp", "long_run", "run")), F.lit(0)).alias("run_before"))
    offsets = shorts.join(longs.join(placed, "grp"), ["grp", "long_run"]).select("grp", "run", "shard", (F.col("slot_start") + F.col("long_before") + F.col("run_before")).alias("offset"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("grp", "run").orderBy("doc_id")))
    return ranked.join(offsets, ["grp", "run"]).select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("rank") - 1).cast("long").alias("slot"), F.lit(capacity).cast("long").alias("capacity"))
