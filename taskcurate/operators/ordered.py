"""Running aggregates, ranks and percentiles that survive a hot key.

A window partitioned by a key sends all rows of that key to one task.  Here
every key is cut into blocks (coarse, order-preserving prefixes of the sort
key): the window runs inside a block, and what earlier blocks contribute is
added from one summary row per block.  Given several block columns, coarse to
fine, the summaries are carried level by level, so that no task sees more than
the blocks of one coarser block.  There is one path for all sizes.

Nulls and NaN follow Spark's order: null first and NaN last when rising, null
last and NaN first when falling.  Null keys are a group of their own.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_FOLD = {"sum": F.sum, "max": F.max, "min": F.min, "xor": F.bit_xor}


def _merge(fn: str, parts: Sequence[Column]) -> Column:
    if fn == "sum":
        return sum((F.coalesce(p, F.lit(0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0)))
    if fn == "xor":
        return functools.reduce(Column.bitwiseXOR, (F.coalesce(p, F.lit(0)) for p in parts))
    return F.greatest(*parts) if fn == "max" else F.least(*parts)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    block: Sequence[Column],
    exclusive: bool = False,
    **measures: tuple[str, Column],
) -> DataFrame:
    """Add running ``sum``/``max``/``min``/``xor`` columns per ``keys`` in ``order``.

    ``measures`` maps a new column name to ``(fn, column)``.  ``block``, from
    coarse to fine, must rise with ``order``, and ``order`` be total; a block
    may be null only where a rising order puts its nulls first.  With
    ``exclusive`` the current row is left out.  Without keys the table is one
    group: give two levels of blocks then.
    """
    keys, blocks = list(keys), [f"_block{i}" for i in range(len(block))]
    src = df.withColumns(dict(zip(blocks, block, strict=True)))
    local = Window.partitionBy(*keys, *blocks).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    totals = src.groupBy(*keys, *blocks).agg(*[_FOLD[fn](c).alias(f"_total_{n}") for n, (fn, c) in measures.items()])
    carried, names = totals.select(*keys, *blocks), {n: [f"_local_{n}"] for n in measures}
    for i in range(len(blocks)):
        level = [*keys, *blocks[: i + 1]]
        sums = totals if i + 1 == len(blocks) else totals.groupBy(*level).agg(*[_FOLD[fn](f"_total_{n}").alias(f"_total_{n}") for n, (fn, _) in measures.items()])
        before = Window.partitionBy(*level[:-1]).orderBy(level[-1]).rowsBetween(Window.unboundedPreceding, -1)
        earlier = sums.select(*level, *[_FOLD[fn](f"_total_{n}").over(before).alias(f"_carry{i}_{n}") for n, (fn, _) in measures.items()])
        carried = earlier if len(blocks) == 1 else same_group(carried, earlier, level)
        for n in measures:
            names[n].append(f"_carry{i}_{n}")
    out = src.withColumns({f"_local_{n}": _FOLD[fn](c).over(local) for n, (fn, c) in measures.items()})
    out = same_group(out, carried, [*keys, *blocks])
    return out.select(*[c for c in df.columns if c not in measures], *[_merge(fn, [F.col(c) for c in names[n]]).alias(n) for n, (fn, _) in measures.items()])


def same_group(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the columns of ``groups``, one row per ``keys``; null keys match null keys."""
    right = groups.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return df.join(right, on).drop(*[f"_r_{k}" for k in keys])


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column], block: Sequence[Column], name: str) -> DataFrame:
    """``row_number`` per ``keys`` (1-based, long) under the rules of :func:`running`."""
    return running(df, keys, order, block, **{name: ("sum", F.lit(1).cast("long"))})


def log_bucket(value: Column) -> Column:
    """Order-preserving bucket of a number, about 1 % wide at any magnitude; null is below and NaN above all numbers."""
    v, top = value.cast("double"), 1 << 40
    size = F.floor(F.log2(F.greatest(F.abs(v), F.lit(2.0**-1022))) * 64) + 64 * 1023
    finite = F.when(v == 0, 0).otherwise(F.signum(v) * size)
    return (
        F.when(v.isNull(), -2 * top).when(F.isnan(v), 2 * top).when(v == float("inf"), top).when(v == float("-inf"), -top).otherwise(finite).cast("long")
    )


def number_blocks(value: Column, falling: bool = False) -> list[Column]:
    """Two levels of blocks for an order by a number."""
    fine = -log_bucket(value) if falling else log_bucket(value)
    return [F.floor(fine / 256), fine]


def id_blocks(value: Column, fine: int = 12, coarse: int = 24) -> list[Column]:
    """Two levels of blocks for a rising order by an integer: 2^24 and 2^12 wide."""
    return [F.shiftright(value.cast("long"), coarse), F.shiftright(value.cast("long"), fine)]


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], moments: bool = False) -> DataFrame:
    """Exact linear-interpolated percentiles per group, and with ``moments`` mean, std, low and high.

    The built-in ``percentile`` keeps every distinct value of a group in one
    buffer.  Here the values are first counted per (group, value); ranks come
    from running counts, and each percentile is picked with a plain
    conditional ``max``.  The deviation is summed around the mean, so large
    values with a small spread keep it.
    """
    keys = list(keys)
    base = df.filter(F.col(value).isNotNull()).withColumn("_v", F.col(value).cast("double"))
    v, w = F.col("_v"), F.col("_n")
    hist = base.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranked = running(hist, keys, [v], number_blocks(v), _upto=("sum", w))
    sums = {"_size": F.sum(w), "_mean": F.sum(v * w) / F.sum(w), "low": F.min(v), "high": F.max(v)}
    kept = [n for n in sums if moments or n == "_size"]
    sizes = hist.groupBy(*keys).agg(*[sums[n].alias(n) for n in kept])
    if keys:
        ranked = same_group(ranked, sizes, keys)
    else:
        row = sizes.select(F.struct(*sizes.columns)).scalar()
        ranked = ranked.withColumn("_row", row).select("*", "_row.*").drop("_row")
    first, last = F.col("_upto") - w, F.col("_upto") - 1
    picks = []
    for n, p in probs.items():
        at = F.lit(float(p)) * (F.col("_size") - 1)
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            picks.append(F.max(F.when(rank.between(first, last), v)).alias(f"_{side}_{n}"))
    if moments:
        gap = v - F.col("_mean")
        picks.append(F.sum(gap * gap * w).alias("_spread"))
    picked = ranked.groupBy(*keys).agg(*[F.max(n).alias(n) for n in kept], *picks)

    def interpolate(n: str, p: float) -> Column:
        at = F.lit(float(p)) * (F.col("_size") - 1)
        lo, hi = F.col(f"_lo_{n}"), F.col(f"_hi_{n}")
        return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (at - F.floor(at)))

    std = F.when(F.col("_size") > 1, F.sqrt(F.col("_spread") / (F.col("_size") - 1)))
    extra = [F.col("_mean").alias("mean"), std.alias("std"), "low", "high"] if moments else []
    return picked.select(*keys, F.col("_size").alias("n"), *extra, *[interpolate(n, p).alias(n) for n, p in probs.items()])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``; map-side combined, no window."""
    row = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    best = df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the last in ``order``."""
    row = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    best = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


#: A group of no more rows than this is ranked by one window; only larger ones are cut into blocks.
WHOLE = 4096


def top_rows(df: DataFrame, keys: Sequence[str], score: str, tie: str, tie_block: Column, size_of: Callable[[Column], Column]) -> DataFrame:
    """The best rows of each group by falling ``score`` (rows without one come last), ties by rising ``tie``.

    ``size_of`` turns the group size into the number of rows wanted.  Rows are dealt by
    their keys once; the rows of groups of more than ``WHOLE`` move on, block by block.
    """
    keys, order = list(keys), [F.col(score).desc(), F.col(tie)]
    rows = df.withColumn("_keys", F.struct(*keys))  # null keys are equal in it
    large = rows.groupBy("_keys").agg(F.count(F.lit(1)).alias("_size")).filter(F.col("_size") > WHOLE)
    group = Window.partitionBy("_keys")
    few = rows.join(large, "_keys", "left_anti").withColumns({"_rank": F.row_number().over(group.orderBy(*order)).cast("long"), "_size": F.count(F.lit(1)).over(group)})
    many = rows.join(large, "_keys")
    many = numbered(many, keys, order, [-log_bucket(F.col(score)), -_value_first(F.col(score)), tie_block], "_rank")
    return few.unionByName(many).filter(F.col("_rank") <= size_of(F.col("_size"))).select(*df.columns)


def _value_first(value: Column) -> Column:
    """A block of its own for each value: the number itself, with null and NaN as numbers below and above all."""
    v = value.cast("double")
    return F.when(v.isNull(), float("-inf")).when(F.isnan(v), float("inf")).otherwise(v)
