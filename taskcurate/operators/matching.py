"""Joins that have no equal key of their own: text inside text, place inside interval, interval against interval.

Each becomes an equi-join on a key that both sides can make, with the real
condition checked on what meets; no pairs of whole groups are built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM, LINES = 3, 64


# -- text inside text ----------------------------------------------------------------


def grams(text: Column, n: Column) -> Column:
    """Distinct parts of ``n`` characters."""
    cut = F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substr(text, i, n))
    return F.when(F.length(text) >= n, F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))


#: With no more inner texts than this in a group of keys, its outer texts are held against each of them.
FEW = 16


def _by_size(outer: DataFrame, inner: DataFrame, inner_col: str, keys: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct inner texts of small groups, those of the others, and the outer rows of the others."""
    short = inner.filter(F.length(inner_col) > 0).select(*keys, inner_col).distinct()
    large = short.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > FEW).select(*keys)
    return short.join(large, keys, "left_anti"), short.join(large, keys, "left_semi"), outer.join(large, keys, "left_semi")


def containing(outer: DataFrame, outer_col: str, inner: DataFrame, inner_col: str, keys: Sequence[str], q: int = GRAM) -> DataFrame:
    """Rows of ``outer`` with the rows of ``inner`` of the same ``keys`` whose text is part of theirs.

    In a group of few inner texts an outer text meets each of them.  In the others it
    is keyed by its parts of ``q`` characters, so by no more rows
    than it is long, whatever lengths are looked for.  An inner text is keyed by
    one of its own parts: the one that the fewest outer texts of its keys have.  Inner
    texts shorter than ``q`` are their own key, and only then outer texts
    are cut into shorter parts too.  Empty and null texts match nothing.
    """
    keys = list(keys)
    few, many, rows = _by_size(outer, inner, inner_col, keys)
    part = F.col(outer_col).contains(F.col(inner_col))
    sizes = F.coalesce(many.agg(F.collect_set(F.least(F.length(inner_col), F.lit(q)))).scalar(), F.array().cast("array<int>"))  # q numbers at most
    cut = rows.withColumn("_sizes", sizes).withColumn("_gram", F.explode(F.flatten(F.transform("_sizes", lambda n: grams(F.col(outer_col), n))))).drop("_sizes")
    held = cut.groupBy(*keys, "_gram").agg(F.count(F.lit(1)).alias("_held"))
    asked = many.withColumn("_gram", F.explode(grams(F.col(inner_col), F.least(F.length(inner_col), F.lit(q)))))
    # a part that no outer text has is the rarest, and matches nothing
    rarest = asked.join(held, [*keys, "_gram"], "left").groupBy(*keys, inner_col).agg(F.min_by("_gram", F.struct(F.coalesce("_held", F.lit(0)), "_gram")).alias("_gram"))
    met = outer.join(few, keys).filter(part).unionByName(cut.join(rarest, [*keys, "_gram"]).filter(part).drop("_gram"))
    return met if set(inner.columns) == {*keys, inner_col} and inner.columns == few.columns else met.join(inner, [*keys, inner_col])


def ending(outer: DataFrame, outer_col: str, inner: DataFrame, inner_col: str, keys: Sequence[str]) -> DataFrame:
    """Rows of ``outer`` with the distinct ``inner`` texts of the same ``keys`` that theirs ends with.

    Only in groups of many inner texts an outer text becomes one row for each of its endings.
    """
    keys = list(keys)
    few, many, rows = _by_size(outer, inner, inner_col, keys)
    text = F.col(outer_col)
    cut = rows.filter(F.length(text) > 0).withColumn(inner_col, F.explode(F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substr(text, i))))
    return outer.join(few, keys).filter(text.endswith(F.col(inner_col))).unionByName(cut.join(many, [*keys, inner_col]).select(*outer.columns, inner_col))


# -- places and intervals --------------------------------------------------------------


def cover(first: Column, last: Column, width: int = LINES, top: int = 62) -> Column:
    """The dyadic nodes (level, node) that make up [first, last], counted in blocks of ``width``.

    A node of level k is 2^k blocks from a multiple of 2^k.  An interval of n
    blocks is at most 2 log2(n) + 1 nodes, and they do not overlap.  The edge blocks
    reach beyond the interval, so what meets is still to be compared.  With ``top``
    no node is of a higher level, and an interval is up to n / 2^top nodes more.
    """
    a, b = F.floor(first / width).cast("long"), F.floor(F.greatest(first, last) / width).cast("long") + 1

    def at(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        low, high = F.ceil(a / size).cast("long"), F.floor(b / size).cast("long")  # nodes of this level inside
        left = F.when((low < high) & (F.pmod(low, F.lit(2)) == 1), low)
        right = F.when((low + F.when(left.isNotNull(), 1).otherwise(0) < high) & (F.pmod(high, F.lit(2)) == 1), high - 1)
        ends = F.filter(F.array(left, right), lambda n: n.isNotNull())
        every = F.when(low < high, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.when(level == top, every).otherwise(ends)

    levels = F.sequence(F.lit(0), F.least(F.floor(F.log2((b - a).cast("double"))).cast("int"), F.lit(top)))
    nodes = F.flatten(F.transform(levels, lambda k: F.transform(at(k), lambda n: F.struct(k.alias("level"), n.alias("node")))))
    return F.when(b == a + 1, F.array(F.struct(F.lit(0).alias("level"), a.alias("node")))).otherwise(nodes)


def ancestors(place: Column, levels: Column, width: int = LINES) -> Column:
    """The nodes (level, node) up to level ``levels`` that hold a place."""
    block = F.floor(place / width).cast("long")
    return F.transform(F.sequence(F.lit(0), levels), lambda k: F.struct(k.alias("level"), F.call_function("shiftright", block, k).alias("node")))


def highest_level(intervals: DataFrame, first: str, last: str, width: int = LINES) -> Column:
    """Level above which no interval of the table has a node: a scalar of one pass."""
    blocks = F.floor(F.greatest(first, last) / width) - F.floor(F.col(first) / width) + 1
    return F.coalesce(intervals.agg(F.max(F.floor(F.log2(blocks.cast("double"))).cast("int"))).scalar(), F.lit(0))


def inside(places: DataFrame, place: str, intervals: DataFrame, first: str, last: str, on: Sequence[str], how: str = "inner", width: int = LINES) -> DataFrame:
    """``places`` with the ``intervals`` of the same ``on`` that hold them.

    A place is one row for each level that some interval of the table needs: one or two rows
    where intervals are some hundred lines long.  An interval is O(log n) rows.
    """
    on = list(on)
    nodes = intervals.withColumn("_at", F.explode(cover(F.col(first), F.col(last), width)))
    nodes = nodes.withColumnsRenamed({c: f"_i_{c}" for c in on})
    asked = places.withColumn("_levels", highest_level(intervals, first, last, width)).withColumn("_n", F.explode(ancestors(F.col(place), F.col("_levels"), width))).drop("_levels")
    same = [F.col(c) == F.col(f"_i_{c}") for c in on] + [F.col("_n") == F.col("_at")]
    return asked.join(nodes, [*same, F.col(place).between(F.col(first), F.col(last))], how).drop("_at", "_n", *[f"_i_{c}" for c in on])


#: Highest level of a node of the first side of :func:`overlapping`: 64 blocks.
TOP = 6


def overlapping(left: DataFrame, first: str, last: str, right: DataFrame, start: str, end: str, on: Sequence[str], width: int = LINES) -> DataFrame:
    """``left`` joined, as a left join, with the intervals of ``right`` that overlap its own, of the same ``on``.

    Two intervals overlap if one begins inside the other: the left one in the right
    one, or the right one behind the first place of the left one.  Both cases are keys of
    one equi-join, so each side is read once.  Rows of ``left`` come several times,
    those without a partner with nulls.
    """
    on = list(on)
    side = lambda n, nodes: F.transform(nodes, lambda x: F.struct(F.lit(n).alias("side"), x["level"].alias("level"), x["node"].alias("node")))
    mine = left.withColumn("_levels", highest_level(right, start, end, width)).withColumn(
        "_at", F.explode(F.concat(side(0, ancestors(F.col(first), F.col("_levels"), width)), side(1, cover(F.col(first), F.col(last), width, TOP))))
    ).drop("_levels")
    theirs = right.withColumn("_to", F.explode(F.concat(side(0, cover(F.col(start), F.col(end), width)), side(1, ancestors(F.col(start), F.lit(TOP), width)))))
    theirs = theirs.withColumnsRenamed({c: f"_i_{c}" for c in on})
    meets = F.when(F.col("_at.side") == 0, F.col(first).between(F.col(start), F.col(end))).otherwise((F.col(start) > F.col(first)) & (F.col(start) <= F.col(last)))
    same = [F.col(c) == F.col(f"_i_{c}") for c in on] + [F.col("_at") == F.col("_to"), meets]
    return mine.join(theirs, same, "left").drop("_at", "_to", *[f"_i_{c}" for c in on])
