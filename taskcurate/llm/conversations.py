"""Conversation prefix trie, with a count-min screen of the prefix digests.

A node of the trie is a sequence of turns that some conversation begins with.
Its digest is the exclusive or of 128 bits for each turn, made of the turn's
place, role and text; so the digests of all prefixes are a running fold, taken
blockwise, and no task holds a whole conversation.

Every prefix digest is counted in a count-min sketch.  Counters stop at two, as
only "once" or "more" is asked, so a row of the sketch is two bit planes, and
planes of tasks merge by bit operations.  A prefix (or the one before it) whose
estimate is one belongs to one conversation: all that is said of its node is
known from its own row, and it leaves for the result without a shuffle.  Only
the others, the possibly shared, are grouped exactly; a wrong estimate costs a
shuffled row, never a wrong node.

Sums over subtrees need no walk: each node counts for its smallest member, a
member of every node above it.  A running sum from the end of each conversation
over the nodes it stands for, added over the members of a node, is the sum over
the subtree of that node.

``ends_sha256`` hashes one byte stream for each node, so its ids are put in order
and joined in blocks of ``1 << END_BITS`` ids, and the blocks are hashed in
order, one block in memory at a time.

Rows without ``conv_id`` belong to no conversation and are left out.  Null roles
and texts are empty.  Rows of one conversation with equal ``turn`` stand in the
order of a hash of role and text; null turns come first.  No conversations, no
nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taskcurate.operators.ordered import id_blocks, numbered, running

from .common import stored

GROUP, MOST_SHARED, ROWS, END_BITS = 20, 3, 4, 12
#: A sketch has a power of two of cells in a row: eight for each prefix, within these bounds (4 rows of 2^24 bits are 8 MiB a plane).
LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 24
_CHUNK = 1 << 16
_NODE = ["depth", "dx", "dy"]


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, k, x, y, words): the turns of each conversation in order, from 1, as digests of role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    slim = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.xxhash64(F.lit(1), role, text).alias("x"), F.xxhash64(F.lit(2), text, role).alias("y"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("x"), F.col("y")]
    return numbered(slim, ["conv_id"], order, id_blocks(F.col("turn")), "k").select("conv_id", "k", "x", "y", "words")


def rebuilt(conversations: DataFrame, group: int = GROUP, most: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, pos, x, y, words) and members (conv_id, n_turns) of the rebuilt conversations.

    With h = crc32 of the decimal id modulo ``most`` + 1, a conversation has the first h turns of
    the conversation ``conv_id - conv_id % group``, then its own behind the first h.
    """
    turns = stored(turns_of(conversations))
    h = F.crc32(F.col("conv_id").cast("string")) % (most + 1)
    sizes = turns.groupBy("conv_id").agg(F.max("k").alias("n"))
    bases = sizes.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = sizes.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % group}).join(bases, "base", "left")
    plan = stored(plan.withColumn("shared", F.least("h", F.coalesce("n_base", F.lit(0)))).select("conv_id", "n", "h", "base", "shared"))
    heads = turns.where((F.col("k") <= most) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "base")
    borrowed = plan.join(heads, "base").where(F.col("k") <= F.col("h")).select("conv_id", F.col("k").alias("pos"), "x", "y", "words")
    own = turns.join(plan.select("conv_id", "h", "shared"), "conv_id").where(F.col("k") > F.col("h")).select("conv_id", (F.col("k") - F.col("h") + F.col("shared")).alias("pos"), "x", "y", "words")
    members = plan.select("conv_id", (F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"))
    return borrowed.union(own), members


def prefixes(turns: DataFrame, members: DataFrame) -> DataFrame:
    """(conv_id, depth, dx, dy, px, py, words, ends) of every prefix and, with depth 0, of every root; p: digest of the prefix before."""
    part = turns.select("conv_id", F.col("pos").alias("depth"), "words", F.xxhash64(F.lit(3), "pos", "x").alias("hx"), F.xxhash64(F.lit(4), "y", "pos").alias("hy"))
    digests = running(part, ["conv_id"], [F.col("depth")], id_blocks(F.col("depth")), dx=("xor", F.col("hx")), dy=("xor", F.col("hy")))
    own = digests.join(members, "conv_id").select(
        "conv_id", "depth", "dx", "dy", F.col("dx").bitwiseXOR(F.col("hx")).alias("px"), F.col("dy").bitwiseXOR(F.col("hy")).alias("py"), "words", (F.col("depth") == F.col("n_turns")).alias("ends")
    )
    zero = F.lit(0).cast("long")
    return own.union(members.select("conv_id", zero, zero, zero, zero, zero, zero, F.col("n_turns") == 0))


def cells(x: np.ndarray, y: np.ndarray, depth: np.ndarray, width: int) -> list[np.ndarray]:
    """The cell of each digest in every row of the sketch."""
    a, b = x.view(np.uint64) ^ depth.astype(np.uint64), y.view(np.uint64) | np.uint64(1)
    return [((a + np.uint64(i) * b) >> np.uint64(20)) & np.uint64(width - 1) for i in range(ROWS)]


def sketch(paths: DataFrame, width: int) -> np.ndarray:
    """The plane "counted more than once" of each row of the sketch: (ROWS, width / 8) bytes."""
    step = min(_CHUNK, width)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((ROWS, width), np.uint8)
        for b in batches:
            for row, at in zip(held, cells(*(b.column(c).to_numpy() for c in ("dx", "dy", "depth")), width), strict=True):
                met, n = np.unique(at, return_counts=True)
                row[met] = np.minimum(row[met] + np.minimum(n, 2), 2)
        for r in range(ROWS):
            for c in range(0, width, step):
                part = held[r, c : c + step]
                if part.any():
                    yield _planes(r, c // step, np.packbits(part > 0, bitorder="little"), np.packbits(part > 1, bitorder="little"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for r, c, once, more in zip(*(b.column(n).to_pylist() for n in ("r", "c", "once", "more")), strict=True):
                o, m = np.frombuffer(once, np.uint8), np.frombuffer(more, np.uint8)
                a, z = held.get((r, c), (np.zeros_like(o), np.zeros_like(m)))
                held[r, c] = a | o, z | m | (a & o)
        for (r, c), (o, m) in held.items():
            yield _planes(r, c, o, m)

    schema = "r int, c int, once binary, more binary"
    out = np.zeros((ROWS, width // 8), np.uint8)
    parts = paths.where("depth > 0").select("dx", "dy", "depth").mapInArrow(count, schema).repartition(F.col("r"), F.col("c")).mapInArrow(merge, schema)
    for p in parts.select("r", "c", "more").collect():  # ROWS x width bits
        out[p.r, p.c * step // 8 : (p.c + 1) * step // 8] = np.frombuffer(p.more, np.uint8)
    return out


def _planes(r: int, c: int, once: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([c], pa.int32()), pa.array([once.tobytes()]), pa.array([more.tobytes()])], ["r", "c", "once", "more"])


def screened(paths: DataFrame, width: int | None = None) -> DataFrame:
    """``paths`` with ``once`` and ``parent_once``: proven to belong to one conversation. Roots never are."""
    if width is None:
        width = min(MOST_CELLS, max(LEAST_CELLS, 1 << (8 * paths.count()).bit_length()))
    planes = paths.sparkSession.sparkContext.broadcast(sketch(paths, width))

    def single(x: np.ndarray, y: np.ndarray, depth: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        for row, at in zip(planes.value, cells(x, y, depth, width), strict=True):
            out |= (row[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1) == 0
        return out & (depth > 0)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dx, dy, px, py, depth = (b.column(c).to_numpy() for c in ("dx", "dy", "px", "py", "depth"))
            before = single(px, py, depth - 1)
            yield b.append_column("once", pa.array(single(dx, dy, depth) | before)).append_column("parent_once", pa.array(before))

    kinds = ", ".join(f"{c} {t}" for c, t in paths.dtypes)
    return paths.mapInArrow(look, f"{kinds}, once boolean, parent_once boolean")


def _ids_sha(blocks: DataFrame) -> DataFrame:
    """(depth, dx, dy, ends_sha256) from blocks (depth, dx, dy, block, ids): their texts in order, joined with commas."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for b in batches:
            for *at, ids in zip(*(b.column(c).to_pylist() for c in (*_NODE, "ids")), strict=True):
                if at != node:
                    if node is not None:
                        yield _done(node, digest)
                    node, digest = at, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
        if node is not None:
            yield _done(node, digest)

    def _done(node, digest) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in node), pa.array([digest.hexdigest()])], [*_NODE, "ends_sha256"])

    return blocks.repartition(*_NODE).sortWithinPartitions(*_NODE, "block").mapInArrow(run, "depth long, dx long, dy long, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame, width: int | None = None) -> DataFrame:
    """One row for each node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    found = stored(screened(stored(prefixes(turns, members)), width))
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    local, asked = found.where("once"), found.where("not once")
    exact = stored(asked.groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words"), F.min("px").alias("px"), F.min("py").alias("py")))

    before = (F.col("depth") - 1).alias("depth")
    upper = exact.where("depth > 0").select(before, "px", "py").union(local.where("not parent_once").select(before, "px", "py")).toDF(*_NODE)
    children = upper.groupBy(*_NODE).agg(F.count("*").alias("n_children"))
    held = stored(exact.join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", zero)))

    # what a conversation stands for, and the places that ask for the sum from there on
    stands = held.select("conv_id", "depth", zero.alias("dx"), zero.alias("dy"), (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), F.lit(0).alias("asks"))
    tails = local.where("ends").select("conv_id", "depth", zero, zero, one, zero, F.lit(0))
    asks = asked.select("conv_id", "depth", "dx", "dy", zero, zero, F.lit(1))
    sums = running(stands.union(tails).union(asks), ["conv_id"], [F.col("depth").desc(), F.col("asks")], id_blocks(-F.col("depth")), leaves=("sum", F.col("leaf")), tokens=("sum", F.col("saved")))
    below = sums.where("asks = 1").groupBy(*_NODE).agg(F.sum("leaves").alias("n_leaves"), F.sum("tokens").alias("saved_tokens"))

    block = F.shiftright("conv_id", END_BITS).alias("block")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    ends = _ids_sha(asked.where("ends").groupBy(*_NODE, block).agg(ids.alias("ids")))

    def named(rows: DataFrame) -> DataFrame:
        """``rows`` with parent_conv_id: of the node of that digest, or their own where a prefix was shared by estimate only."""
        above = held.where("depth > 0").select(F.col("depth").alias("_d"), F.col("dx").alias("_x"), F.col("dy").alias("_y"), F.col("conv_id").alias("_c"))
        on = (F.col("depth") - 1 == F.col("_d")) & (F.col("px") == F.col("_x")) & (F.col("py") == F.col("_y"))
        deep = rows.where("depth > 1").join(above, on, "left").withColumn("parent_conv_id", F.coalesce("_c", "conv_id")).drop(*above.columns)
        root = held.where("depth = 0").select("conv_id").scalar()  # above all first turns, so no key to join on
        return deep.union(rows.where("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, root)))

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    nothing = F.sha2(F.lit(""), 256)
    shared = named(held.join(below, _NODE).join(ends, _NODE, "left")).withColumn("ends_sha256", F.coalesce("ends_sha256", nothing)).select(*columns)

    def alone(rows: DataFrame, parent: Column) -> DataFrame:
        ends_here = F.when(F.col("ends"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(nothing)
        return rows.select("conv_id", "depth", parent.alias("parent_conv_id"), one.alias("n_convs"), F.when(F.col("ends"), zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"), ends_here.alias("ends_sha256"))

    first = alone(named(local.where("not parent_once")), F.col("parent_conv_id"))
    return shared.union(first).union(alone(local.where("parent_once"), F.col("conv_id")))
