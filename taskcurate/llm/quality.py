"""Quality rules: what a text says by itself, and how many documents of its host share its lines.

Lines are normalised (ASCII letters lowered, digits to 0, white space to one
blank) and hashed.  A line held by more than ``max_docs`` documents of a host
is removed from all of them but the one with the smallest ``doc_id``, so the
text itself is never lost.  A document that keeps less than ``min_left`` of its
words is depleted and rejected, and so is one that fails the base rules (fewer
than 20 words, or more than 30 % of the words in 8-word windows that repeat).

Null or empty texts have no words and fail the base rules.  Null hosts form
one host.  Rows without ``doc_id`` are not counted as holders of a line.
Repeated rows (equal ``doc_id`` and text) count once and get the same verdict.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_texts, lists, per_batch, stored, text_key

MAX_DOCS, MIN_LEFT = 50, 0.3
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
SYMBOLS, SPACES = b"#*$%&|<>", b" \t\n\x0b\x0c\r"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")
_MIX = tuple(np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64).view(np.int64))

FACTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def line_hash(line: bytes) -> int:
    """Signed 64 bits of a normalised line."""
    h = xxhash.xxh64_intdigest(b" ".join(line.translate(_LOWER).split()))
    return h - (1 << 64) if h >> 63 else h


def repeat_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words that occur twice or more in the list.

    Hashed windows without an equal partner are settled at once; the rest are
    compared word by word.
    """
    n = len(words)
    if n <= size:
        return 0
    h = np.fromiter(map(hash, words), np.int64, n)
    with np.errstate(over="ignore"):
        for step, mix in zip((1, 2, 4), _MIX, strict=True):
            h = (h[:-step] * mix) ^ (h[step:] + (h[step:] >> 29))
    order = np.sort(h)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(h, twice))
    seen: dict[tuple, list[int]] = {}
    for i in at.tolist():
        seen.setdefault(tuple(words[i : i + size]), []).append(i)
    edge = np.zeros(n + 1, np.int64)
    for places in seen.values():
        if len(places) > 1:
            np.add.at(edge, places, 1)
            np.add.at(edge, [i + size for i in places], -1)
    return int(np.count_nonzero(np.cumsum(edge[:n])))


def facts(text: str | None) -> tuple:
    """Base counts of one text, and its distinct line hashes with the words they hold."""
    raw = (text or "").encode()
    words = raw.split()
    seen: set[bytes] = set()
    dup, held = 0, {}
    for line in raw.split(b"\n"):
        w = len(line.split())
        if w:
            dup += line in seen
            seen.add(line)
            h = line_hash(line)
            held[h] = held.get(h, 0) + w
    return (
        len(words), len(text or "") - sum(raw.count(c) for c in SPACES), sum(raw.count(c) for c in SYMBOLS), dup, repeat_words(words),
        list(held), list(held.values()),
    )


def _facts_batch(b: pa.RecordBatch) -> pa.RecordBatch:
    rows = [facts(t) for t in b.column(3).to_pylist()]
    cols = list(zip(*rows, strict=True)) or [[]] * 7
    arrays = [b.column(0), b.column(1), b.column(2), *(pa.array(c, pa.int64()) for c in cols[:5]), lists(cols[5], pa.int64()), lists(cols[6], pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "key", "host", *(x.split()[0] for x in FACTS.split(", ")), "line", "line_words"])


def document_facts(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per document: key, host, base counts and line hashes."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), F.coalesce(F.col(host).cast("string"), F.lit("\0")).alias("host"), "text")
    return per_batch(slim, _facts_batch, f"doc_id long, key long, host string, {FACTS}, line array<long>, line_words array<long>")


def removed_lines(found: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(doc_id, key, line, line_words): each line that a document loses."""
    held = found.select("doc_id", "key", "host", F.inline(F.arrays_zip("line", "line_words"))).distinct()
    often = held.groupBy("host", "line").agg(F.count_distinct("doc_id").alias("n_docs"), F.min("doc_id").alias("first_doc")).where(F.col("n_docs") > max_docs)
    return held.join(often, ["host", "line"]).where(~F.col("doc_id").eqNullSafe(F.col("first_doc"))).select("doc_id", "key", "line", "line_words")


def quality_rules(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """One row per row of ``docs``: doc_id, key, base counts, n_removed_words, removed (hashes), base_failed, kept."""
    found = stored(document_facts(docs, host))
    lost = removed_lines(found, max_docs).groupBy(F.col("doc_id").alias("d"), F.col("key").alias("k")).agg(F.sum("line_words").alias("lost_words"), F.collect_list("line").alias("removed"))
    out = found.drop("line", "line_words", "host").join(lost, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left").drop("d", "k")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    removed = F.coalesce("lost_words", F.lit(0))
    return out.select(
        "*", removed.alias("n_removed_words"), failed.alias("base_failed"),
        (~failed & (F.col("n_words") - removed >= min_left * F.col("n_words"))).alias("kept"),
    ).drop("lost_words")


def _strip_batch(b: pa.RecordBatch) -> pa.RecordBatch:
    text, gone = b.column("text").to_pylist(), b.column("removed__").to_pylist()
    for i, (t, g) in enumerate(zip(text, gone, strict=True)):
        if g:
            lost = set(g)
            text[i] = b"\n".join(x for x in t.encode().split(b"\n") if not x.split() or line_hash(x) not in lost).decode()
    names = [n for n in b.schema.names if n != "removed__"]
    return pa.RecordBatch.from_arrays([pa.array(text, pa.string()) if n == "text" else b.column(n) for n in names], names)


def apply_quality_rules(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """``docs`` without rejected documents; lines over the limit are cut from the rest."""
    verdict = quality_rules(docs, host, max_docs, min_left).where("kept").select(F.col("doc_id").alias("d__"), F.col("key").alias("k__"), F.col("removed").alias("removed__")).dropDuplicates(["d__", "k__"])
    kept = join_texts(docs, verdict).drop("d__", "k__")
    return recounted(per_batch(kept, _strip_batch, docs.schema))


def recounted(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is such a column, set to the length of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs
