"""Queries over judge votes and model answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import votes as V
from .registry import query
from .views import Views

_MAJORITY = """m AS (SELECT instance, count(*) FILTER (upper(verdict) = 'KEEP') AS keep, count(*) AS total FROM v_votes GROUP BY instance),
  w AS (SELECT *, total - keep AS reject, CASE WHEN keep >= total - keep THEN 'KEEP' ELSE 'REJECT' END AS verdict FROM m),
  k AS (SELECT w.*, arg_min(v.reason, vote_idx) AS reason, arg_min(v.category, vote_idx) AS category FROM w JOIN v_votes v ON v.instance = w.instance AND upper(v.verdict) = w.verdict GROUP BY ALL)"""


@query("a03_keep_or_reject", f"WITH {_MAJORITY} SELECT instance, verdict, keep, reject, total, reason, category FROM k")
def keep_or_reject(v: Views):
    return V.keep_or_reject(v.votes())


@query("a03b_apply_verdicts", f"""
WITH {_MAJORITY} SELECT number AS instance, CASE WHEN number % 10 = 0 THEN 'REJECT' ELSE coalesce(verdict, 'KEEP') END AS verdict, k.category FROM v_pulls LEFT JOIN k ON number = instance""")
def apply_verdicts(v: Views):
    inst = v.pulls().selectExpr("number AS instance", "CASE WHEN number % 10 = 0 THEN ' ' ELSE 'diff' END AS patch")
    return V.apply_verdicts(inst, V.keep_or_reject(v.votes())).select("instance", "verdict", "category")


DIMS = ("clarity", "scope")
_Q = """q AS (SELECT instance, count(*) FILTER (dim = 'overall') AS total, count(*) FILTER (dim = 'overall' AND verdict = 'FAIL') AS fail,
    count(*) FILTER (dim = 'overall' AND verdict = 'PASS') AS ok, count(*) FILTER (dim = 'clarity' AND verdict = 'FAIL') AS fc, count(*) FILTER (dim = 'scope' AND verdict = 'FAIL') AS fs FROM v_quality_votes GROUP BY instance),
  r AS (SELECT instance, total, fail, ok, CASE WHEN fail > total - fail THEN 'FAIL' ELSE 'PASS' END AS overall, CASE WHEN fail > ok THEN 'FAIL' ELSE 'PASS' END AS strict_overall,
    CASE WHEN fc > total // 2 THEN 'FAIL' ELSE 'PASS' END AS clarity, CASE WHEN fs > total // 2 THEN 'FAIL' ELSE 'PASS' END AS scope FROM q)"""


@query("a04_quality_verdict", f"WITH {_Q} SELECT instance, overall, total - fail AS pass, fail, total, clarity, scope FROM r")
def quality_verdict(v: Views):
    return V.quality_verdict(v.quality_votes(), DIMS)


@query("a04b_failure_reasons", "SELECT instance, dim, vote_idx, reason FROM v_quality_votes WHERE verdict = 'FAIL' AND dim <> 'overall'")
def failure_reasons(v: Views):
    return V.failure_reasons(v.quality_votes(), DIMS)


@query("a05_strict_quality_verdict", f"""
WITH {_Q} SELECT r.instance, strict_overall AS overall, ok AS pass, fail, total, clarity, scope, arg_min(summary, vote_idx) AS summary
FROM r LEFT JOIN v_quality_votes v ON v.instance = r.instance AND dim = 'overall' AND v.verdict = strict_overall GROUP BY ALL""")
def strict_quality_verdict(v: Views):
    return V.quality_verdict(v.quality_votes(), DIMS, strict_pass=True)


@query("a06_verdict_breakdown", f"""
WITH {_Q} SELECT 'overall ' || overall AS measure, count(*) AS n FROM r GROUP BY 1 UNION ALL SELECT 'fails clarity', count(*) FROM r WHERE clarity = 'FAIL'
UNION ALL SELECT 'fails scope', count(*) FROM r WHERE scope = 'FAIL'""")
def verdict_breakdown(v: Views):
    return V.verdict_breakdown(V.quality_verdict(v.quality_votes(), DIMS), DIMS)


@query("a06b_by_category", f"WITH {_MAJORITY} SELECT verdict, category, count(*) AS n FROM k GROUP BY ALL")
def by_category(v: Views):
    return V.keep_or_reject(v.votes()).groupBy("verdict", "category").agg(F.count(F.lit(1)).alias("n"))


@query("f21_verified", f"WITH {_Q} SELECT instance FROM r WHERE overall = 'PASS'")
def verified(v: Views):
    return V.verified(V.quality_verdict(v.quality_votes(), DIMS)).select("instance")


@query("x25_feedback", f"""
WITH {_Q}, l AS (SELECT instance, dim, string_agg(reason, '; ' ORDER BY vote_idx) AS why FROM v_quality_votes WHERE verdict = 'FAIL' GROUP BY ALL),
  f AS (SELECT instance, 'clarity' AS dim FROM r WHERE clarity = 'FAIL' UNION ALL SELECT instance, 'scope' FROM r WHERE scope = 'FAIL'),
  t AS (SELECT instance, string_agg('- ' || upper(dim) || ': FAIL — ' || why, chr(10) ORDER BY dim) AS feedback FROM f JOIN l USING (instance, dim) GROUP BY instance)
SELECT instance, coalesce(feedback, 'No specific failures identified.') AS feedback FROM r LEFT JOIN t USING (instance)""")
def feedback(v: Views):
    votes = v.quality_votes()
    return V.feedback(V.quality_verdict(votes, DIMS), V.failure_reasons(votes, DIMS), DIMS)


@query("x17_parse_answers", """
SELECT number, CASE number % 4 WHEN 3 THEN 'KEEP' ELSE 'V' || number % 9 END AS verdict, CASE WHEN number % 4 <> 3 THEN 'why' || number END AS reason,
  CASE number % 4 WHEN 2 THEN 'note {"verdict": "V' || number % 9 || '", "reason": "why' || number || '"} end' WHEN 3 THEN 'no answer' ELSE '{"verdict": "V' || number % 9 || '", "reason": "why' || number || '"}' END AS block FROM v_pulls""")
def parse_answers(v: Views):
    body = "concat('{\"verdict\": \"V', number % 9, '\", \"reason\": \"why', number, '\"}')"
    text = F.expr(f"""CASE number % 4 WHEN 0 THEN concat('Sure\\n```json\\n', {body}, '\\n```\\nbye') WHEN 1 THEN concat('```\\nnot json\\n```\\n```\\n', {body}, '\\n```')
        WHEN 2 THEN concat('note ', {body}, ' end') ELSE 'no answer' END""")
    df = v.pulls().select("number", text.alias("text"))
    ans = V.parsed_answer(F.col("text"), "verdict string, reason string", "verdict", "KEEP")
    return df.select("number", ans.alias("a"), V.json_block(F.col("text")).alias("block")).select(
        "number", "a.verdict", F.col("a.fields.reason").alias("reason"), "block")


@query("d04_group_judge", f"WITH {_MAJORITY} SELECT instance, verdict, total::BIGINT AS total FROM w")
def group_judge(v: Views):
    return V.keep_or_reject(v.votes()).select("instance", "verdict", F.col("total").cast("long").alias("total"))
