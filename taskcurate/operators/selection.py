"""Best-of-N: one candidate per image."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import top_rows

CAND_BLOCK = 4096


def _best(df: DataFrame, *ranking: str) -> DataFrame:
    """Highest ``ranking`` per image, earliest candidate on a tie; a plain grouped maximum."""
    row = F.struct(*[F.col(c) for c in df.columns if c != "image"])
    order = F.struct(*[F.col(c) for c in ranking], -F.col("cand"))
    return df.groupBy("image").agg(F.max_by(row, order).alias("_row")).select("image", "_row.*")


def by_model(cands: DataFrame) -> DataFrame:
    return _best(cands, "verifier_prob")


def by_execution(cands: DataFrame) -> DataFrame:
    return _best(cands, "regression_pass", "reproduction_score")


def by_both(cands: DataFrame) -> DataFrame:
    """The better half by model score, then by execution, then by model score again.

    At least one candidate is kept, so a single candidate is returned as it is.
    """
    half = top_rows(
        cands, ["image"], "verifier_prob", "cand", F.floor(F.col("cand") / CAND_BLOCK),
        lambda n: F.greatest(F.lit(1), F.floor(n / 2)),
    )
    return _best(half, "regression_pass", "reproduction_score", "verifier_prob")


# Selectors by name.
SELECTORS: dict[str, Callable[[DataFrame], DataFrame]] = {"ef": by_model, "eb": by_execution, "hybrid": by_both}


def select_best(cands: DataFrame, mode: str) -> DataFrame:
    if mode not in SELECTORS:
        raise ValueError(f"unknown selector {mode!r}, expected one of {sorted(SELECTORS)}")
    return SELECTORS[mode](cands)


def yes_probability(logp_yes: Column, logp_no: Column, missing: float = -10000.0, digits: int | None = None) -> Column:
    """P(yes) from two log-probabilities; null when both vanish.

    With ``digits`` the result is rounded, so that equal odds tie whatever
    their last bits are.
    """
    yes = F.exp(F.coalesce(logp_yes, F.lit(missing)))
    no = F.exp(F.coalesce(logp_no, F.lit(missing)))
    p = F.when(yes + no > 0, yes / (yes + no))
    return p if digits is None else F.round(p, digits)


def submission(df: DataFrame, model: str) -> DataFrame:
    """(instance_id, model_name_or_path, model_patch); the id is the last part of the image name."""
    return df.select(
        F.element_at(F.split("image", r"\."), -1).alias("instance_id"),
        F.lit(model).alias("model_name_or_path"),
        F.col("output_patch").alias("model_patch"),
    )
