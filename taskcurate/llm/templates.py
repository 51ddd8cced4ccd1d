"""Line dedup with a log-template tree.

A line is parsed to a fixed depth: its token count and its first ``DEPTH``
tokens (ASCII letters lowered, tokens with a digit masked) name a leaf.  The
tokens behind the leading ones, which a leaf shares anyway, are cut into at most
``BLOCKS`` position blocks of consecutive tokens.  A leaf has any number of
templates: the constant part of a line is the share ``MIN_ALIKE`` of its blocks
that the most lines of the leaf have in the same place (ties: the first ones),
the other blocks are fields, and lines with equal constant parts are a template.
A line whose own template is rare joins the largest recurring template of the
leaf whose constant part it holds, so a frequent value in a field sets no line apart.
With one or two tokens behind the
leading ones all must agree.  A template held by ``MIN_DOCS`` documents or more
recurs: its lines are dropped everywhere but in the document with the smallest
``doc_id``.  A line of ``LONG`` tokens or more that stands word for word in
``LONG_DOCS`` documents recurs as well.  The constant part of a template is thus never lost altogether; the
fields of the dropped lines are.

Lines of fewer than ``MIN_TOKENS`` tokens are never templates.  Null and empty
texts have no lines to drop and stay as they are; rows without ``doc_id`` are
not counted; repeated rows count once and get the same result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_texts, lists, per_batch, stored, text_key
from .quality import _LOWER, recounted

DEPTH, BLOCKS, MIN_ALIKE, MIN_TOKENS, MIN_DOCS = 3, 8, 0.6, 4, 10
LONG, LONG_DOCS = 50, 2
MASK = b"<*>"


def parse(line: bytes) -> tuple[list[bytes], list[bytes]] | None:
    """Masked tokens of a line and the position blocks of those behind the leading ones; None for short lines."""
    low = line.translate(_LOWER)
    tokens = low.split()
    n = len(tokens)
    if n < MIN_TOKENS:
        return None
    if b"0" in low:
        tokens = [MASK if b"0" in t else t for t in tokens]
    rest = tokens[DEPTH:]
    n, m = len(rest), min(len(rest), BLOCKS)
    return tokens, [b" ".join(rest[n * i // m : n * (i + 1) // m]) for i in range(m)]


def _lines_batch(b: pa.RecordBatch) -> pa.RecordBatch:
    row, number, leaf, line, exact, blocks = [], [], [], [], [], []
    h64, h32 = xxhash.xxh64_intdigest, xxhash.xxh32_intdigest
    for r, text in enumerate(b.column("text").to_pylist()):
        for i, x in enumerate((text or "").encode().split(b"\n")):
            if found := parse(x):
                tokens, parts = found
                row.append(r)
                number.append(i)
                leaf.append(h64(b"%d " % len(tokens) + b" ".join(tokens[:DEPTH])))
                line.append(h64(b" ".join(tokens)))
                exact.append(h64(b" ".join(x.split())) if len(tokens) >= LONG else None)
                blocks.append([h32(p) for p in parts])
    take = pa.array(row, pa.int32())
    long = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
    return pa.RecordBatch.from_arrays(
        [b.column("doc_id").take(take), b.column("key").take(take), pa.array(number, pa.int32()), long(leaf), long(line), pa.array(exact, pa.uint64()).view(pa.int64()), lists(blocks, pa.int64())],
        ["doc_id", "key", "line_no", "leaf", "line", "exact", "blocks"],
    )


def parsed_lines(docs: DataFrame) -> DataFrame:
    """One row per line that can be a template."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"), "text")
    return per_batch(slim, _lines_batch, "doc_id long, key long, line_no int, leaf long, line long, exact long, blocks array<long>")


def line_templates(there: DataFrame, min_docs: int) -> DataFrame:
    """(leaf, line, template) of each distinct line."""
    held = stored(there.groupBy("leaf", "line").agg(F.first("blocks").alias("blocks"), F.count_distinct("doc_id").alias("n")))
    values = held.select("leaf", "line", "n", F.posexplode("blocks").alias("pos", "value"))
    support = values.groupBy("leaf", "pos", "value").agg(F.sum("n").alias("support"))
    best = F.sort_array(F.collect_list(F.struct((-F.col("support")).alias("order"), "pos", "value")))
    ranked = values.join(support, ["leaf", "pos", "value"]).groupBy("leaf", "line").agg(best.alias("best"))
    part = F.slice("best", 1, F.ceil(F.size("best") * F.lit(MIN_ALIKE)).cast("int"))
    plain = lambda c: F.transform(c, lambda x: F.struct(x["pos"].alias("pos"), x["value"].alias("value")))
    own = stored(ranked.select("leaf", "line", plain(part).alias("constant")).withColumn("template", F.xxhash64(F.sort_array("constant"))))
    docs_of = there.join(own, ["leaf", "line"]).groupBy("leaf", "template").agg(F.count_distinct("doc_id").alias("n"))
    often = stored(docs_of.where(F.col("n") >= min_docs))
    rare = held.join(own.join(often, ["leaf", "template"], "left_anti"), ["leaf", "line"]).select("leaf", "line", "template", "blocks")
    known = own.join(often, ["leaf", "template"]).groupBy("leaf", "template").agg(F.first("n").alias("n"), F.min("constant").alias("constant"))
    # a template is met by its least common constant block, then compared in full
    last = F.element_at("constant", -1)
    known = known.select("leaf", F.col("template").alias("found"), "n", "constant", last["pos"].alias("pos"), last["value"].alias("value"))
    met = rare.select("leaf", "line", "blocks", F.posexplode("blocks").alias("pos", "value")).join(known, ["leaf", "pos", "value"])
    met = met.where(F.forall("constant", lambda c: F.get("blocks", c["pos"]) == c["value"]))
    joined = met.groupBy("leaf", "line").agg(F.max_by("found", F.struct("n", "found")).alias("found"))
    return own.join(joined, ["leaf", "line"], "left").select("leaf", "line", F.coalesce("found", "template").alias("template"))


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, long_docs: int = LONG_DOCS) -> DataFrame:
    """(doc_id, key, dropped): the numbers, from 0, of the lines that each document loses."""
    lines = stored(parsed_lines(docs))
    busy = lines.groupBy("leaf").agg(F.count_distinct("doc_id").alias("n")).where(F.col("n") >= min_docs).select("leaf")
    there = stored(lines.join(busy, "leaf"))
    named = there.join(line_templates(there, min_docs), ["leaf", "line"]).select("doc_id", "key", "line_no", "leaf", "template")
    again = named.groupBy("leaf", "template").agg(F.count_distinct("doc_id").alias("n"), F.min("doc_id").alias("first_doc")).where(F.col("n") >= min_docs)
    where = ["doc_id", "key", "line_no", "first_doc"]
    lost = named.join(again, ["leaf", "template"]).select(*where)
    long = lines.where("exact is not null").select("doc_id", "key", "line_no", "exact")
    copied = long.groupBy("exact").agg(F.count_distinct("doc_id").alias("n"), F.min("doc_id").alias("first_doc")).where(F.col("n") >= long_docs)
    lost = lost.union(long.join(copied, "exact").select(*where))
    lost = lost.where(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
    return lost.groupBy("doc_id", "key").agg(F.sort_array(F.collect_set("line_no")).alias("dropped"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, note: str | None = None, long_docs: int = LONG_DOCS) -> DataFrame:
    """``docs`` without recurring lines; ``note`` names a column to add that lists the dropped line numbers."""
    lost = recurring_lines(docs, min_docs, long_docs).select(F.col("doc_id").alias("d__"), F.col("key").alias("k__"), F.col("dropped").alias("dropped__"))
    both = join_texts(docs, lost, "left")
    rest = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("dropped__", i)), "\n")
    cut = recounted(both.withColumn("text", F.when(F.col("dropped__").isNull(), F.col("text")).otherwise(rest)))
    return cut.select(*docs.columns, *([F.coalesce("dropped__", F.array().cast("array<int>")).alias(note)] if note else []))
