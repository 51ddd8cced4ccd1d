"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

A document is its token ids and an end token.  One that is longer than a
sequence is cut into pieces of a whole sequence; only the first may be shorter.

Pieces of one length are interchangeable, so an instance of any size is a count
for each length, at most ``SEQUENCE`` numbers, and a solution is a list of genes: a
pattern of lengths and the number of bins that hold it.  A gene is a group of
equal bins, the unit that the algorithm handles:

* Crossover injects whole well-filled genes of one parent, drops from the other
  parent's genes what would use a piece twice, and places the displaced pieces
  by best fit, longest first.
* Displaced pieces first take the place of one or two shorter ones where that fills
  a bin better; those are displaced instead.
* Mutation empties some genes, poorly filled ones first, and places their pieces
  by best fit in a shuffled order.
* Fitness is the number of bins, then the mean square of their fill.

Each island is a group of a Spark job and evolves its own population; between
epochs, written to the shared folder, the elite of an island moves to the next
one.  Seeds depend on island and epoch only, so a lost island evolves alike
again.  An island with a solution at the lower bound stops.

The best solution (some thousand genes) is turned into ranges: pieces of a length
are numbered blockwise, and a number's range tells its pattern, bin and offset.
No task holds more than a block of pieces of one length.

Null texts are empty: the end token alone.  Rows that repeat are packed each.
"""

from __future__ import annotations

import base64
import bisect
import functools
import json
import random
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taskcurate.operators.ordered import id_blocks, numbered

from .bpe import PATTERN, text_runs
from .common import lists, stored, text_key

SEQUENCE, END = 1024, 2
#: Fixed value: the added token of the vocabulary and its id.
ADDED = {"<|endoftext|>": 50256}
ISLANDS, EPOCHS, GENERATIONS, POPULATION, ELITE, WELL_FILLED = 6, 3, 12, 8, 2, 0.97

Pattern = tuple[tuple[int, int], ...]  # (length, pieces of it in a bin), longest first
Genes = list[tuple[Pattern, int]]  # and the number of such bins


@functools.lru_cache(maxsize=2)
def encoder(ranks: str) -> tiktoken.Encoding:
    """The byte-level vocabulary in ``ranks``, once for each worker process."""
    with open(ranks, "rb") as f:
        known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=known, special_tokens=ADDED)


def pieces(docs: DataFrame, ranks: str, size: int = SEQUENCE, end: int = END, keep_ids: bool = False) -> DataFrame:
    """(doc_id, key, piece, start, length, ids_crc32[, ids]) of all documents; ``ranks`` is readable on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(ranks)
        for b in batches:
            at = 0
            for texts in text_runs(b):
                rows, out, ids = [], [], []
                for i, text in enumerate(texts):
                    every = np.append(e.encode_to_numpy(text or "", allowed_special="all"), np.uint32(end)).astype("<u4")
                    cuts = [0, *range((len(every) - 1) % size + 1, len(every) + 1, size)]
                    for k, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        rows.append(at + i)
                        out.append((k, x, y - x, zlib.crc32(every[x:y])))
                        ids.append(every[x:y])
                cols = [pa.array([r[j] for r in out], kind) for j, kind in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                cols += [lists(ids, pa.int64())] if keep_ids else []
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(rows, pa.int32())) for c in ("doc_id", "key")), *cols], names)
                at += len(texts)

    names = ["doc_id", "key", "piece", "start", "length", "ids_crc32", "ids"][: 6 + keep_ids]
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), "text")
    return slim.mapInArrow(run, "doc_id long, key long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * keep_ids)


class Bins:
    """Genes open for best fit: by room left, with a bit for every room there is."""

    def __init__(self, size: int, genes: Genes = ()):
        self.size, self.by_room, self.rooms = size, {}, 0
        for pattern, n in genes:
            self.add(pattern, n)

    def add(self, pattern: Pattern, n: int) -> None:
        room = self.size - sum(s * c for s, c in pattern)
        held = self.by_room.setdefault(room, {})
        held[pattern] = held.get(pattern, 0) + n
        self.rooms |= 1 << room

    def place(self, length: int, n: int) -> None:
        """``n`` pieces, each into the open bin with the least room that takes it, or else into a new one."""
        while n:
            fits = self.rooms >> length
            if not fits:
                pattern, there, room = (), n, self.size
            else:
                room = length + (fits & -fits).bit_length() - 1
                held = self.by_room[room]
                pattern, there = held.popitem()
                if not held:
                    self.rooms ^= 1 << room
            each = room // length  # a bin stays the best one for as long as it takes more
            full = min(there, n // each)
            if full:
                self.add(with_more(pattern, length, each), full)
                n, there = n - full * each, there - full
            if n and there and n < each:
                self.add(with_more(pattern, length, n), 1)
                n, there = 0, there - 1
            if there and pattern:
                self.add(pattern, there)

    def genes(self) -> Genes:
        return [(p, n) for room in sorted(self.by_room) for p, n in sorted(self.by_room[room].items())]


def with_more(pattern: Pattern, length: int, n: int) -> Pattern:
    held = dict(pattern)
    held[length] = held.get(length, 0) + n
    return tuple(sorted(held.items(), reverse=True))


def best_fit(counts: dict[int, int], size: int, genes: Genes = (), shuffle: random.Random | None = None) -> Genes:
    """``genes`` with the pieces of ``counts`` placed too: longest first, or in an order shuffled over near lengths."""
    bins = Bins(size, genes)
    for length in sorted(counts, key=(lambda s: -s * shuffle.uniform(0.7, 1)) if shuffle else lambda s: -s):
        bins.place(length, counts[length])
    return bins.genes()


def filled(pattern: Pattern) -> int:
    return sum(s * c for s, c in pattern)


def fitness(genes: Genes, size: int) -> tuple[int, float]:
    """Number of bins, and mean square of their fill, negative: less is better."""
    bins = sum(n for _, n in genes)
    return bins, -sum(n * (filled(p) / size) ** 2 for p, n in genes) / max(bins, 1)


def swapped(counts: dict[int, int], genes: Genes, size: int) -> tuple[dict[int, int], Genes]:
    """Displaced pieces in place of one or two shorter ones of a bin, while that fills the bin better."""
    left, lengths, out = dict(counts), sorted(counts), []
    for pattern, n in genes:
        room = size - filled(pattern)
        pairs = [(s,) for s, _ in pattern] + [(a, b) for a, i in pattern for b, _ in pattern if a > b or (a == b and i > 1)]
        for gone in pairs if room else ():
            low = sum(gone)
            at = bisect.bisect_right(lengths, low + room) - 1
            if at >= 0 and lengths[at] > low:
                new = lengths[at]
                m = min(n, left[new])
                held = Counter(dict(pattern))
                held.subtract(gone)
                held[new] += 1
                out.append((tuple(sorted(((s, c) for s, c in held.items() if c), reverse=True)), m))
                left[new] -= m
                if not left[new]:
                    lengths.pop(at)
                for s in gone:
                    if not left.get(s):
                        bisect.insort(lengths, s)
                    left[s] = left.get(s, 0) + m
                n -= m
                if not n:
                    break
        if n:
            out.append((pattern, n))
    return {s: n for s, n in left.items() if n}, out


def crossover(one: Genes, other: Genes, counts: dict[int, int], size: int, r: random.Random) -> Genes:
    """A child of both: well-filled genes of ``other`` go in whole, then what of ``one`` uses no piece twice, the rest by best fit."""
    left, child = dict(counts), []
    injected = [g for g in other if filled(g[0]) >= WELL_FILLED * size and r.random() < 0.5]
    kept = list(one)
    r.shuffle(kept)
    kept.sort(key=lambda g: -(filled(g[0]) >= WELL_FILLED * size))
    for pattern, n in [*injected, *kept]:
        n = min([n, *(left[s] // c for s, c in pattern)])
        if n > 0:
            child.append((pattern, n))
            for s, c in pattern:
                left[s] -= n * c
    left, child = swapped({s: n for s, n in left.items() if n}, child, size)
    return best_fit(left, size, child)


def mutated(genes: Genes, size: int, r: random.Random) -> Genes:
    """Some genes emptied, poorly filled ones more often, and their pieces placed in a shuffled order."""
    kept, out = [], {}
    for pattern, n in genes:
        if r.random() < (0.04 if filled(pattern) >= WELL_FILLED * size else 0.5):
            for s, c in pattern:
                out[s] = out.get(s, 0) + n * c
        else:
            kept.append((pattern, n))
    r.shuffle(kept)
    out, kept = swapped(out, kept, size)
    return best_fit(out, size, kept, r if r.random() < 0.5 else None)


def evolve(population: list[Genes], counts: dict[int, int], size: int, r: random.Random, generations: int = GENERATIONS) -> list[Genes]:
    """The population after some generations, the best first; its best is never lost."""
    least = -(-sum(s * n for s, n in counts.items()) // size)
    key = lambda genes: (*fitness(genes, size), genes)
    while len(population) < POPULATION:
        population.append(best_fit(counts, size, (), r if population else None))
    population.sort(key=key)
    for _ in range(generations):
        if fitness(population[0], size)[0] <= least:
            break
        children = []
        for _ in range(POPULATION // 2):
            one, other = (min(r.sample(population, 2), key=key) for _ in range(2))  # the better of two
            children.append(mutated(crossover(one, other, counts, size, r), size, r) if r.random() < 0.5 else crossover(one, other, counts, size, r))
        unlike = {tuple(g): g for g in population + children}  # no clones
        population = sorted(unlike.values(), key=key)[:POPULATION]
    return population


def solution(spark: SparkSession, counts: dict[int, int], size: int = SEQUENCE, islands: int = ISLANDS, epochs: int = EPOCHS, generations: int = GENERATIONS) -> Genes:
    """The best genes of all islands for ``counts`` pieces of each length."""
    def island(epoch: int):
        def run(rows: pd.DataFrame) -> pd.DataFrame:
            name = int(rows["island"].iloc[0])
            found = [_genes(g) for g in sorted(rows["genes"]) if g]
            best = evolve(found, counts, size, random.Random(f"{name} {epoch}"), generations)
            cost = [fitness(g, size) for g in best]
            return pd.DataFrame({"island": name, "place": range(len(best)), "bins": [c[0] for c in cost], "spread": [c[1] for c in cost], "genes": [json.dumps(g) for g in best]})

        return run

    state = spark.range(islands).select(F.col("id").cast("int").alias("island"), F.lit(0).alias("place"), F.lit("").alias("genes"))
    for epoch in range(epochs):
        state = stored(state.repartition(islands, "island").groupBy("island").applyInPandas(island(epoch), "island int, place int, bins long, spread double, genes string"))
        if epoch + 1 < epochs:  # the elite moves on to the next island, where it takes the place of the worst
            elite = state.where(F.col("place") < ELITE).withColumn("island", (F.col("island") + 1) % islands)
            state = state.where(F.col("place") < POPULATION - ELITE).union(elite).select("island", "place", "genes")
    best = state.orderBy("bins", "spread", "island", "place").select("genes").first()
    return _genes(best[0])


def _genes(text: str) -> Genes:
    return [(tuple(map(tuple, p)), n) for p, n in json.loads(text)]


def packed(docs: DataFrame, ranks: str, size: int = SEQUENCE, end: int = END, keep_ids: bool = False) -> DataFrame:
    """The columns of :func:`pieces` and sequence_id, offset: where each piece lies."""
    spark = docs.sparkSession
    found = stored(pieces(docs, ranks, size, end, keep_ids))
    counts = {r.length: r.n for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``size`` rows
    ranges, taken, first = [], {}, 0
    for pattern, n in solution(spark, counts, size) if counts else ():
        offset = 0
        for s, c in pattern:
            ranges.append((s, taken.get(s, 0), c, first, offset))
            taken[s] = taken.get(s, 0) + n * c
            offset += s * c
        first += n
    table = np.array(sorted(ranges), np.int64).reshape(-1, 5)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, at = b.column("length").to_numpy(), b.column("number").to_numpy() - 1
            row = table[np.searchsorted(_key(table[:, 0], table[:, 1]), _key(length, at), "right") - 1] if len(table) else table
            nth = at - row[:, 1]
            yield b.append_column("sequence_id", pa.array(row[:, 3] + nth // row[:, 2])).append_column("offset", pa.array(row[:, 4] + nth % row[:, 2] * length))

    order = [F.col("doc_id"), F.col("key"), F.col("piece")]
    counted = numbered(found.drop("ids"), ["length"], order, id_blocks(F.col("doc_id")), "number")
    kinds = ", ".join(f"{c} {t}" for c, t in counted.dtypes)
    out = counted.mapInArrow(place, f"{kinds}, sequence_id long, offset long").drop("number")
    if keep_ids:
        same = [F.col(c).eqNullSafe(F.col(f"{c}__")) for c in ("doc_id", "key", "piece")]
        out = out.join(found.select(*(F.col(c).alias(f"{c}__") for c in ("doc_id", "key", "piece")), "ids").dropDuplicates(["doc_id__", "key__", "piece__"]), functools.reduce(lambda x, y: x & y, same)).drop("doc_id__", "key__", "piece__")
    return out


def _key(length: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One number that orders by length, then by place among the pieces of a length (below 2^48)."""
    return length.astype(np.int64) << np.int64(48) | at
