"""Queries that pick one candidate of several."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import selection as S
from .registry import query
from .views import Views


@query("w01_best_by_model", "SELECT image, cand FROM v_cands QUALIFY row_number() OVER (PARTITION BY image ORDER BY verifier_prob DESC, cand) = 1")
def best_by_model(v: Views):
    return S.by_model(v.cands()).select("image", "cand")


@query("w02_best_by_execution", "SELECT image, cand FROM v_cands QUALIFY row_number() OVER (PARTITION BY image ORDER BY regression_pass DESC, reproduction_score DESC, cand) = 1")
def best_by_execution(v: Views):
    return S.by_execution(v.cands()).select("image", "cand")


@query("w03_best_by_both", """
WITH h AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY verifier_prob DESC, cand) AS rn, count(*) OVER (PARTITION BY image) AS n FROM v_cands)
SELECT image, cand FROM h WHERE rn <= greatest(1, n // 2) QUALIFY row_number() OVER (PARTITION BY image ORDER BY regression_pass DESC, reproduction_score DESC, verifier_prob DESC, cand) = 1""")
def best_by_both(v: Views):
    return S.by_both(v.cands()).select("image", "cand")


@query("x31_yes_probability", """
SELECT image, cand, round(CASE WHEN logp_no IS NULL THEN 1.0 ELSE exp(logp_yes) / (exp(logp_yes) + exp(logp_no)) END, 6)::DOUBLE AS p_yes FROM v_cands""")
def yes_probability(v: Views):
    return v.cands().select("image", "cand", F.round(S.yes_probability(F.col("logp_yes"), F.col("logp_no")), 6).alias("p_yes"))


@query("d02_selector_by_name", """
WITH h AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY verifier_prob DESC, cand) AS rn, count(*) OVER (PARTITION BY image) AS n FROM v_cands)
SELECT 'ef' AS mode, image, arg_max(cand, (verifier_prob, -cand)) AS cand FROM v_cands GROUP BY image
UNION ALL SELECT 'eb', image, arg_max(cand, (regression_pass, reproduction_score, -cand)) FROM v_cands GROUP BY image
UNION ALL SELECT 'hybrid', image, arg_max(cand, (regression_pass, reproduction_score, verifier_prob, -cand)) FROM h WHERE rn <= greatest(1, n // 2) GROUP BY image""")
def selector_by_name(v: Views):
    return reduce(DataFrame.unionByName, [S.select_best(v.cands(), m).select(F.lit(m).alias("mode"), "image", "cand") for m in S.SELECTORS])
