"""Dedup of long repeats by a logarithmic family of sorted block indexes.

The suffix array of the method is replaced: no suffix is ordered by its bytes (see the
README for figures of one that is).

Every byte covered by a ``LENGTH``-byte string that also starts earlier (in a
document with a smaller doc_id, or earlier in the same one) is removed; strings
are judged on the input.

*Sampled suffixes.*  Of each window of ``LENGTH`` bytes the ``GRAM``-byte string
with the smallest hash (ties: the leftmost) is its anchor.  Equal windows have
equal anchors at equal places, so only suffixes at anchors are indexed, one for
some 40 bytes.  The windows of one anchor are neighbours and form its block.

*Index family.*  Suffixes are dealt to tasks by their first ``GRAM`` bytes and
arrive in document order.  A task turns each batch of them into a sorted array
(by hash of the first bytes, then of the block), merge-scans it against the
levels built so far, and adds it as a level; levels of like size merge, so there
are logarithmically many and a suffix moves logarithmically often.  A block met
before is a repeat as a whole.  Blocks that differ but share their first bytes
may share single windows: their bytes meet in one task for each such string, in
document order, and are compared window by window, by 128-bit hashes.  Strings
with more than ``CROWD`` different blocks send hashes of windows instead, which
are dealt by hash, so that no string gathers an unbounded group.

Within an input batch, all but the first of equal blocks (or windows) are
settled at once, so a passage that a third of all documents hold reaches a task
once per input batch.

Null and empty texts, and texts below ``LENGTH`` bytes, lose nothing.  A null
doc_id counts as smaller than all others; rows without one are told apart, and
ordered, by a hash of their text.  Rows with equal doc_id are one
document and must be repeats of one row; repeats get the same result.  (An id below
-2^62 would be taken for none.)
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

LENGTH, GRAM, BATCH, PIECE, CROWD = 100, 16, 1 << 16, 1 << 22, 1 << 13
WHOLE, BYTES, HASHES = 0, 1, 2
_PLACE = np.uint64((1 << 24) - 1)
_random = np.random.default_rng(20)
_BYTE = _random.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _random.integers(0, 1 << 63, 8, np.uint64) | np.uint64(1)
_NO_ID = np.iinfo(np.int64).min


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """64-bit hashes of all ``GRAM``-byte strings."""
    h, step = _BYTE[raw], 1
    while step < GRAM:
        h = h[:-step] * _MIX[step.bit_length()] + h[step:]
        step *= 2
    h = (h ^ (h >> np.uint64(29))) * _MIX[6]
    return h ^ (h >> np.uint64(32))


def anchors(h: np.ndarray) -> np.ndarray:
    """For each window, the place of its smallest gram hash; at most 2^24 grams."""
    width, span = LENGTH - GRAM + 1, 1
    low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(h) - width + 1], low[width - span :])
    return (low & _PLACE).astype(np.int64)


def blocks(raw: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]]:
    """(hash of the anchor's bytes, first window, number of windows, hash of the block) in the order of the text; long texts come in pieces."""
    for at in range(0, max(0, len(raw) - LENGTH + 1), PIECE):
        piece = raw[at : at + PIECE + LENGTH - 1]
        h = gram_hashes(np.frombuffer(piece, np.uint8))
        a = anchors(h)
        first = np.concatenate(([0], np.flatnonzero(a[1:] != a[:-1]) + 1))
        count = np.diff(np.append(first, len(a)))
        digest = xxhash.xxh64_intdigest
        yield h[a[first]], first + at, count, [digest(piece[i:j]) for i, j in zip(first.tolist(), (first + count + LENGTH - 1).tolist(), strict=True)]


def first_of_equal(keys: list[np.ndarray], doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """True where an equal key stands at a smaller (doc, start)."""
    order = np.lexsort((start, doc, *keys))
    same = np.ones(len(order), bool)
    for k in keys:
        s = k[order]
        same[1:] &= s[1:] == s[:-1]
    same[:1] = False
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    d, s = doc[order], start[order]
    later = np.zeros(len(order), bool)
    later[order] = same & ((d != d[head]) | (s != s[head]))
    return later


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        parts = []
        for d, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            for gram, first, count, digest in blocks((text or "").encode()):
                parts.append((gram, np.array(digest, np.uint64), np.full(len(first), d), first, count))
        if parts:
            gram, block, doc, start, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            later = first_of_equal([block, gram], doc, start)
            # a repeat within this batch is settled: it travels under a key of its own
            gram = np.where(later, doc.view(np.uint64) * _MIX[0] ^ start.view(np.uint64) * _MIX[1], gram)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (gram.view(np.int64), block.view(np.int64), doc, start, np.where(later, -n, n))], ["gram", "block", "doc", "start", "n"])


class Family:
    """Sorted levels of (gram, block, doc, start, n, shared), each about twice as large as the next."""

    def __init__(self) -> None:
        self.levels: list[list[np.ndarray]] = []

    @staticmethod
    def find(level: list[np.ndarray], gram: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bounds of each gram in a level, and whether the block stands there."""
        low, high = np.searchsorted(level[0], gram, "left"), np.searchsorted(level[0], gram, "right")
        a, b = low.copy(), high.copy()
        while (open_ := a < b).any():
            middle = (a + b) // 2
            less = level[1][np.minimum(middle, len(level[1]) - 1)] < block
            a, b = np.where(open_ & less, middle + 1, a), np.where(open_ & ~less, middle, b)
        return low, high, (a < high) & (level[1][np.minimum(a, len(level[1]) - 1)] == block)

    def add(self, gram: np.ndarray, block: np.ndarray, doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Index a batch that follows all before it; True for blocks that were met before."""
        later = first_of_equal([block, gram], doc, start)
        shared = np.zeros(len(gram), bool)
        for level in self.levels:
            low, high, there = self.find(level, gram, block)
            later |= there
            new = ~there & (low < high)
            shared |= new
            edge = np.zeros(len(level[0]) + 1, np.int64)  # the level's blocks of those grams are needed as well
            np.add.at(edge, low[new], 1)
            np.add.at(edge, high[new], -1)
            level[5] |= np.cumsum(edge)[:-1] > 0
        keep = np.flatnonzero(~later)
        if not len(keep):
            return later
        keep = keep[np.lexsort((block[keep], gram[keep]))]
        own = [x[keep] for x in (gram, block, doc, start, n, shared)]
        same = (own[0][1:] == own[0][:-1]) & (own[1][1:] != own[1][:-1])
        own[5][1:] |= same
        own[5][:-1] |= same
        self.levels.append(own)
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            x, y = self.levels.pop(), self.levels.pop()
            both = [np.concatenate(z) for z in zip(y, x, strict=True)]
            order = np.lexsort((both[1], both[0]))
            self.levels.append([z[order] for z in both])
        return later


def _scan_family(batches: Iterator[pa.RecordBatch], crowd: int) -> Iterator[pa.RecordBatch]:
    """Blocks that were met before (WHOLE), and blocks to be compared by windows (BYTES, HASHES), of one share of the suffixes."""

    def rows(gram: np.ndarray, doc: np.ndarray, start: np.ndarray, n: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (gram, doc, start, n, kind.astype(np.int32))], ["gram", "doc", "start", "n", "kind"])

    family, held, size = Family(), [], 0

    def flush() -> pa.RecordBatch:
        gram, block, doc, start, n = (np.concatenate(x) for x in zip(*held, strict=True))
        fresh = n > 0
        met = ~fresh
        met[fresh] = family.add(*(x[fresh] for x in (gram, block, doc, start, n)))
        return rows(gram[met], doc[met], start[met], np.abs(n[met]), np.full(int(met.sum()), WHOLE))

    for b in batches:
        held.append([b.column(c).to_numpy() for c in ("gram", "block", "doc", "start", "n")])
        size += b.num_rows
        if size >= BATCH:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()
    shared = [level[0][level[5]] for level in family.levels]
    names, counts = np.unique(np.concatenate(shared or [np.zeros(0, np.int64)]), return_counts=True)
    for level, grams in zip(family.levels, shared, strict=True):
        crowded = counts[np.searchsorted(names, grams)] > crowd
        yield rows(grams, *(x[level[5]] for x in level[2:5]), np.where(crowded, HASHES, BYTES))


def outcome(raw: bytes, windows: list[tuple[int, int]]) -> tuple[int, int, str]:
    """(bytes removed, runs removed, SHA-256 of the rest), given (first, number) of repeated windows."""
    edge = np.zeros(len(raw) + 1, np.int64)
    for a, n in windows:
        if a < len(raw):
            edge[a] += 1
            edge[min(len(raw), a + n + LENGTH - 1)] -= 1
    gone = np.cumsum(edge)[: len(raw)] > 0
    runs = int(gone[:1].sum() + np.count_nonzero(gone[1:] & ~gone[:-1]))
    return int(gone.sum()), runs, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed texts, for the shuffle."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for b in batches:
        packed = pa.array([pack((t or "").encode()) for t in b.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), packed], ["doc", "packed"])


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is to be compared: the bytes of blocks by the hash of their anchor, or hashes of windows (without bytes)."""
    digest = xxhash.xxh3_128_digest
    for b in batches:
        for at in range(0, b.num_rows, 1000):
            part, whole, parts = b.slice(at, 1000), [], []
            for d, packed, found in zip(part.column("doc").to_pylist(), part.column("packed").to_pylist(), part.column("found").to_pylist(), strict=True):
                raw = _unpack(packed)
                for x in found:
                    first, n = x["start"], x["n"]
                    if x["kind"] == BYTES:
                        whole.append((x["gram"], 0, d, first, raw[first : first + n + LENGTH - 1]))
                    else:
                        parts += [(digest(raw[i : i + LENGTH]), d, i) for i in range(first, first + n)]
            h = np.frombuffer(b"".join(x[0] for x in parts), np.int64).reshape(-1, 2)
            doc, start = (np.array([x[i] for x in parts], np.int64) for i in (1, 2))
            later = first_of_equal([h[:, 0], h[:, 1]], doc, start)
            # a repeat within this batch is settled: it travels under a key of its own, marked by empty bytes
            own = doc * np.int64(-7046029254386353131) + start
            single = zip(np.where(later, own, h[:, 0]).tolist(), h[:, 1].tolist(), doc.tolist(), start.tolist(), [b"" if x else None for x in later], strict=True)
            cols = list(zip(*whole, *single, strict=True)) or [[]] * 5
            kinds = (pa.int64(),) * 4 + (pa.binary(),)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["k1", "k2", "doc", "start", "bytes"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows; rows come by key, then in document order."""
    digest, at, before, seen = xxhash.xxh3_128_digest, None, None, set()
    for b in batches:
        out = []
        for k1, k2, doc, start, raw in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "doc", "start", "bytes")), strict=True):
            if at != (k1, k2):
                at, before, seen = (k1, k2), None, set()
            elif before == (doc, start):
                continue  # the same place of a repeated row
            if not raw:
                if raw is not None or before:
                    out.append((doc, start, 1))
            else:
                hashes = [digest(raw[i : i + LENGTH]) for i in range(len(raw) - LENGTH + 1)]
                met = [h in seen for h in hashes]
                i = 0
                while i < len(met):
                    j = i
                    while j < len(met) and met[j]:
                        j += 1
                    if j > i:
                        out.append((doc, start + i, j - i))
                    i = j + 1
                seen.update(hashes)
            before = (doc, start)
        cols = list(zip(*out, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc", "start", "n"])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for packed, found in zip(b.column("packed").to_pylist(), b.column("found").to_pylist(), strict=True):
            raw = _unpack(packed)
            rows.append((len(raw), *outcome(raw, [(x["start"], x["n"]) for x in found or []])))
        cols = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        doc = b.column("doc").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(doc, mask=doc < _NO_ID + (1 << 62)), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["doc_id", *(x.split()[0] for x in RESULT.split(", "))])


def repeated_spans(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row of ``docs``."""
    unnamed = F.lit(_NO_ID) + F.shiftrightunsigned(F.xxhash64("text"), 2)
    slim = docs.select(F.coalesce(F.col("doc_id").cast("long"), unnamed).alias("doc_id"), "text")
    sampled = slim.mapInArrow(_block_rows, "gram long, block long, doc long, start long, n long")
    found = stored(sampled.repartition("gram").sortWithinPartitions("doc", "start").mapInArrow(lambda b: _scan_family(b, crowd), "gram long, doc long, start long, n long, kind int"))
    # both joins read one shuffle of the texts: the filter, always true, keeps the plans below them alike
    texts = slim.mapInArrow(_packed, "doc long, packed binary").where("doc is not null")
    open_ = found.where(F.col("kind") != WHOLE).groupBy("doc").agg(F.collect_list(F.struct("gram", "start", "n", "kind")).alias("found"))
    rows = texts.join(open_.hint("merge"), "doc").mapInArrow(_contexts, "k1 long, k2 long, doc long, start long, bytes binary")
    single = rows.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "doc", "start").mapInArrow(_compare, "doc long, start long, n long")
    spans = found.where(F.col("kind") == WHOLE).select("doc", "start", "n").union(single).groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("found"))
    return texts.join(spans.hint("merge"), "doc", "left").select("doc", "packed", "found").mapInArrow(_finish, f"doc_id long, {RESULT}")
