"""Putting result tables together: unions, updates, upserts, splits, completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import keep_first, keep_last, numbered


def concat_results(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def split_by_version(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a version, rows without)."""
    return df.filter(F.col("version").isNotNull()), df.filter(F.col("version").isNull())


def with_precedence(primary: DataFrame, secondary: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """All primary rows, then the first secondary row of each key the primary lacks."""
    extra = secondary.filter(F.col(key).isNotNull()).join(primary.select(key).distinct(), key, "left_anti")
    return primary.unionByName(keep_first(extra, [key], order))


def by_number_descending(df: DataFrame, key: str = "pull_number") -> DataFrame:
    """Numeric order if the key is a number, text order otherwise."""
    return df.orderBy(F.expr(f"try_cast({key} AS bigint)").desc_nulls_last(), F.col(key).desc())


def update_fields(df: DataFrame, changes: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Overwrite ``fields`` where the key matches; ``changes`` is unique per key."""
    new = changes.select(key, *[F.col(f).alias(f"_new_{f}") for f in fields])
    out = df.join(new, key, "left")
    out = out.withColumns({f: F.coalesce(f"_new_{f}", f) for f in fields})
    return out.drop(*[f"_new_{f}" for f in fields])


def upsert(df: DataFrame, changes: DataFrame, fallback: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Update what is there, insert what is not (other columns come from ``fallback``)."""
    updated = update_fields(df, changes, key, fields)
    absent = changes.join(df.select(key), key, "left_anti").select(key)
    inserted = update_fields(fallback.join(absent, key, "left_semi"), changes, key, fields)
    return updated.unionByName(inserted, allowMissingColumns=True)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return keep_first(df, keys, order)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return keep_last(df, keys, order)


def latest_run(df: DataFrame, key: str, name: str, lexical: bool = False) -> DataFrame:
    """Latest ``base_<n>`` per key: by number, or by text (which differs from 10 on)."""
    suffix = F.element_at(F.split(F.col(name), "_"), -1)
    order = F.col(name) if lexical else suffix.cast("long")
    return df.groupBy(key).agg(F.max_by(name, order).alias("latest"))


def group_members(df: DataFrame, group: str, member: str, order: Sequence[Column], block: Sequence[Column]) -> DataFrame:
    """Members of each group, numbered: the long form of ``{group: [members]}``."""
    return numbered(df.select(group, member), [group], order, block, "member_no")


def completeness(df: DataFrame, nullable: Sequence[str], lists: Sequence[str]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count(c).alias(f"{c}_present") for c in nullable]
    for c in lists:
        size = F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
        aggs += [F.sum(size).alias(f"{c}_items"), F.count_if(size > 0).alias(f"{c}_non_empty")]
    return df.agg(*aggs)


def embed_artifacts(
    instances: DataFrame, scripts: DataFrame, status: DataFrame, results: DataFrame, image_suffix: str = "_root"
) -> DataFrame:
    """Attach script, status, image and failure reason to every instance.

    The run script wins over the evaluation script; a status without a value
    reads ``unknown``, no status at all ``missing``; the image falls back to
    the recorded name, then to one made from the id; the reason falls back to
    the result table.
    """
    out = instances.join(scripts, "instance_id", "left").join(
        status.select("instance_id", F.coalesce("status", F.lit("unknown")).alias("status"), F.col("reason").alias("_own")),
        "instance_id", "left",
    )
    out = out.join(results.select("instance_id", F.col("reason").alias("_result")), "instance_id", "left")
    ok = F.coalesce(F.col("status") == "success", F.lit(False))
    return out.select(
        "instance_id",
        F.coalesce("status", F.lit("missing")).alias("status"),
        F.when(ok, F.coalesce("run_script", "eval_script", F.lit(""))).alias("eval_script"),
        F.coalesce("docker_name", F.concat(F.lower("instance_id"), F.lit(image_suffix))).alias("docker_image"),
        F.when(~ok, F.coalesce("_own", "_result")).alias("failure_reason"),
    )
