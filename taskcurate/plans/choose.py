"""Candidates of several runs -> one submission per image."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import selection


def best_submission(cands: DataFrame, mode: str, model: str, digits: int | None = None) -> DataFrame:
    """Score candidates from their log-probabilities, select by ``mode``, shape the submission."""
    p = selection.yes_probability(F.col("logp_yes"), F.col("logp_no"), digits=digits)
    return selection.submission(selection.select_best(cands.withColumn("verifier_prob", p), mode), model)
