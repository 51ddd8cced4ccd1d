"""Queries behind the reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import patches as P
from ..operators import reports as R
from ..operators import trajectories as J
from .registry import query
from .views import Views

_LABELLED = """l AS (SELECT number, repo, CASE number % 7 WHEN 0 THEN 'feature' WHEN 1 THEN 'bug_fix' WHEN 2 THEN 'docs_config' WHEN 3 THEN 'mixed' WHEN 4 THEN 'mixed' WHEN 5 THEN 'refactor' ELSE 'mixed' END AS type,
  CASE WHEN number % 11 < 3 THEN 'easy' WHEN number % 11 < 8 THEN 'medium' WHEN number % 11 = 10 THEN 'medium' ELSE 'hard' END AS difficulty FROM v_pulls)"""


def _labelled(v: Views):
    raw_type = F.expr("CASE number % 7 WHEN 0 THEN 'feature' WHEN 1 THEN 'bug_fix' WHEN 2 THEN 'docs_config' WHEN 3 THEN 'mixed' WHEN 4 THEN 'chore' WHEN 5 THEN 'refactor' END")
    raw_diff = F.expr("CASE WHEN number % 11 < 3 THEN 'easy' WHEN number % 11 < 8 THEN 'medium' WHEN number % 11 = 10 THEN 'extreme' ELSE 'hard' END")
    return v.pulls().select("number", "repo", R.valid_label(raw_type, R.TYPES, "mixed").alias("type"),
                            R.valid_label(raw_diff, R.DIFFICULTIES, "medium").alias("difficulty"))


@query("x28_valid_labels", f"""
WITH {_LABELLED} SELECT number, type, difficulty, title FROM l JOIN v_pulls USING (number)""")
def valid_labels(v: Views):
    titled = v.pulls().select("number", R.title_of(F.concat(F.lit("\n "), "title", F.lit("\nbody"))).alias("title"))
    return _labelled(v).select("number", "type", "difficulty").join(titled, "number")


@query("x28b_difficulty_by_size", """
SELECT number, pos, CASE WHEN n < 3 THEN 'easy' WHEN n <= 8 THEN 'medium' ELSE 'hard' END AS difficulty
FROM (SELECT number, pos, count(*) FILTER (line LIKE '+%' OR line LIKE '-%') AS n FROM v_lines GROUP BY ALL)""")
def difficulty_by_size(v: Views):
    return v.patches().select("number", "pos", R.difficulty_by_size(P.n_changed(F.col("patch")), 3, 8).alias("difficulty"))


@query("a09_distribution", f"""
WITH {_LABELLED} SELECT repo, type, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY repo), 6)::DOUBLE AS percent FROM l GROUP BY repo, type""")
def distribution(v: Views):
    return R.distribution(_labelled(v), "type", ["repo"]).withColumn("percent", F.round("percent", 6))


@query("a09b_distribution_rollup", f"WITH {_LABELLED} SELECT repo, difficulty, count(*) AS n FROM l GROUP BY ROLLUP (repo, difficulty)")
def distribution_rollup(v: Views):
    return R.distribution_with_totals(_labelled(v), "difficulty", "repo")


REPOS = [f"org{i}/proj" for i in range(7)]


@query("a10_label_matrix", f"""
WITH {_LABELLED} SELECT type, {", ".join(f"count(*) FILTER (repo = '{r}') AS \"{r}\"" for r in REPOS)} FROM l GROUP BY type""")
def label_matrix(v: Views):
    return R.label_matrix(_labelled(v), "type", "repo", REPOS)


@query("a11_box_figures", f"""
WITH {_LABELLED}, s AS (SELECT number, pos, count(*) FILTER (line LIKE '+%' OR line LIKE '-%') AS size FROM v_lines GROUP BY ALL)
SELECT type, count(*) AS n, min(size)::DOUBLE AS low, max(size)::DOUBLE AS high, round(quantile_cont(size, 0.25), 6)::DOUBLE AS q1, round(quantile_cont(size, 0.5), 6)::DOUBLE AS median,
  round(quantile_cont(size, 0.75), 6)::DOUBLE AS q3, floor(quantile_cont(size, 0.5))::BIGINT AS median_shown FROM s JOIN l USING (number) GROUP BY type""")
def box_figures(v: Views):
    sizes = v.patches().select("number", P.n_changed(F.col("patch")).cast("long").alias("size")).join(_labelled(v), "number")
    df = R.box_figures(sizes, "type", "size")
    return df.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query("a12_floor_shares", f"WITH {_LABELLED} SELECT difficulty, count(*) AS n, (100 * count(*) // sum(count(*)) OVER ())::BIGINT AS percent FROM l GROUP BY difficulty")
def floor_shares(v: Views):
    return R.floor_shares(_labelled(v), "difficulty")


@query("t02_ranked_by_size", """
WITH s AS (SELECT number, pos, count(*) FILTER (line LIKE '+%' OR line LIKE '-%') AS size FROM v_lines GROUP BY ALL)
SELECT repo, id, size, row_number() OVER (PARTITION BY repo ORDER BY size, id) AS place FROM (SELECT repo, number || '-' || pos AS id, size FROM s JOIN v_pulls USING (number))""")
def ranked_by_size(v: Views):
    sizes = v.patches().select("number", "pos", P.n_changed(F.col("patch")).cast("long").alias("size"))  # patches stay in their row
    df = sizes.join(v.pulls().select("number", "repo"), "number")
    df = df.select("repo", F.concat_ws("-", F.col("number").cast("string"), F.col("pos").cast("string")).alias("id"), "size")
    return R.ranked_by_size(df, "repo", "size", "id")


def _parts(v: Views):
    ds = v.pulls().selectExpr("concat('i', number) AS instance_id", "number", "repo", "number AS pull_number")
    preds = ds.filter("number % 3 <> 0").selectExpr("instance_id", "CASE WHEN number % 5 = 0 THEN '' ELSE concat('p', number) END AS model_patch",
                                                   "CASE WHEN number % 7 = 0 THEN 'm/x' END AS model_name")
    info = ds.filter("number % 4 <> 0").selectExpr("instance_id", "'done' AS exit_status", "number % 20 AS api_calls", "(number % 13) * 0.25D AS instance_cost")
    evals = ds.filter("number % 6 <> 0").selectExpr("instance_id", "number % 2 = 0 AS resolved", "cast(number % 2 AS int) AS eval_exit_code")
    return ds.drop("number"), preds, info, evals


_COMBINED = """cb AS (SELECT 'i' || number AS instance_id, repo, number AS pull_number, CASE WHEN number % 3 <> 0 THEN CASE WHEN number % 5 = 0 THEN '' ELSE 'p' || number END END AS model_patch,
  CASE WHEN number % 4 <> 0 THEN 'done' END AS exit_status, CASE WHEN number % 4 <> 0 THEN number % 20 END AS api_calls, CASE WHEN number % 4 <> 0 THEN (number % 13) * 0.25 END::DOUBLE AS instance_cost,
  CASE WHEN number % 6 <> 0 THEN number % 2 = 0 END AS resolved, CASE WHEN number % 6 <> 0 THEN number % 2 END AS eval_exit_code, 'm/x' AS model_name FROM v_pulls)"""


@query("j01_combined", f"WITH {_COMBINED} SELECT * FROM cb")
def combined(v: Views):
    return R.combined(*_parts(v))


@query("a27_combined_counts", f"WITH {_COMBINED} SELECT count(*) AS total, count(*) FILTER (model_patch <> '') AS predictions, count(resolved) AS evaluated, count(*) FILTER (resolved) AS resolved FROM cb")
def combined_counts(v: Views):
    return R.combined_counts(R.combined(*_parts(v)))


_BUCKETS = """t AS (SELECT instance, count(*) AS total_tests, count(*) FILTER (status = 'PASSED') AS total_passed FROM v_last_runs WHERE phase = 'post' GROUP BY instance),
  b AS (SELECT number, t.*, CASE WHEN t.instance IS NULL THEN 'error' WHEN total_passed * 2 >= total_tests THEN 'resolved' ELSE 'unresolved' END AS bucket,
    CASE WHEN number % 4 <> 0 THEN (number % 13) * 0.25 END AS cost, CASE WHEN number % 4 <> 0 THEN number % 20 END AS steps FROM v_pulls LEFT JOIN t ON instance = number WHERE number % 3 <> 0)"""


def _buckets(v: Views):
    from ..operators import testlogs as T

    post = T.pre_post(v.test_runs()).select("instance", F.col("post").alias("status"))
    done = T.pass_counts(post, "instance").selectExpr(
        "instance AS instance_id", "tests AS total_tests", "passed AS total_passed", "passed * 2 >= tests AS resolved",
        "instance % 5 AS f2p_total", "instance % 5 div 2 AS f2p_passed", "instance % 3 + 1 AS p2p_total", "instance % 3 AS p2p_passed")
    preds = v.pulls().filter("number % 3 <> 0").selectExpr("number AS instance_id")
    stats = v.pulls().filter("number % 4 <> 0").selectExpr("number AS instance_id", "(number % 13) * 0.25D AS cost", "number % 20 AS steps")
    ds = v.pulls().selectExpr("number AS instance_id")
    return R.run_buckets(ds, preds, done).join(stats, "instance_id", "left")


@query("j02_run_buckets", f"WITH {_BUCKETS} SELECT number AS instance_id, bucket FROM b")
def run_buckets(v: Views):
    return _buckets(v).select("instance_id", "bucket")


@query("a22_run_report", f"""
WITH {_BUCKETS} SELECT count(*) AS total, count(*) FILTER (bucket <> 'error') AS completed, count(*) FILTER (bucket = 'resolved') AS resolved, count(*) FILTER (bucket = 'unresolved') AS unresolved,
  count(*) FILTER (bucket = 'error') AS error, round(count(*) FILTER (bucket = 'resolved') * 100.0 / count(*), 1)::DOUBLE AS resolve_rate, sum(f2p)::BIGINT AS f2p_total, sum(f2p // 2)::BIGINT AS f2p_passed, sum(p2p + 1)::BIGINT AS p2p_total, sum(p2p)::BIGINT AS p2p_passed,
  sum(total_tests)::BIGINT AS total_tests, sum(total_passed)::BIGINT AS total_passed, round(sum(cost) FILTER (bucket <> 'error') / count(cost) FILTER (bucket <> 'error'), 2)::DOUBLE AS avg_cost,
  round(sum(steps) FILTER (bucket <> 'error')::DOUBLE / count(cost) FILTER (bucket <> 'error'), 1)::DOUBLE AS avg_steps, round(sum(cost) FILTER (bucket <> 'error'), 2)::DOUBLE AS total_cost,
  sum(total_passed) || '/' || sum(total_tests) AS test_pass_rate, sum(f2p // 2) || '/' || sum(f2p) AS f2p_pass_rate, sum(p2p) || '/' || sum(p2p + 1) AS p2p_pass_rate
FROM (SELECT *, CASE WHEN instance IS NOT NULL THEN number % 5 END AS f2p, CASE WHEN instance IS NOT NULL THEN number % 3 END AS p2p FROM b)""")
def run_report(v: Views):
    return R.run_report(_buckets(v))


@query("a25_build_summary", """
SELECT count(*) AS total, count(*) FILTER (number % 5 >= 3) AS succeeded, count(*) FILTER (number % 5 < 3) AS failed, round(count(*) FILTER (number % 5 >= 3) / count(*), 6)::DOUBLE AS success_rate FROM v_pulls""")
def build_summary(v: Views):
    df = v.pulls().selectExpr("CASE number % 5 WHEN 0 THEN NULL WHEN 1 THEN 'unknown' WHEN 2 THEN 'failed' ELSE 'success' END AS status")
    return R.build_summary(df).withColumn("success_rate", F.round("success_rate", 6))


@query("a25b_build_failures", """
SELECT number, CASE number % 5 WHEN 0 THEN 'unknown' WHEN 1 THEN 'unknown' ELSE 'no ' || repo END AS reason FROM v_pulls WHERE number % 5 < 3""")
def build_failures(v: Views):
    df = v.pulls().selectExpr("number", "CASE number % 5 WHEN 0 THEN NULL WHEN 1 THEN 'unknown' WHEN 2 THEN 'failed' ELSE 'success' END AS status",
                              "CASE number % 5 WHEN 0 THEN '' WHEN 2 THEN concat('no ', repo) END AS why")
    return R.build_failures(df, "number", "why")


@query("a26_cost_rollup", """
WITH c AS (SELECT event_type AS iteration, user_id AS i, event_id % 50 AS o FROM events)
SELECT iteration, count(*) AS calls, sum(i)::BIGINT AS input_tokens, sum(o)::BIGINT AS output_tokens, round(sum(i * 0.25 + o * 0.5), 6)::DOUBLE AS cost FROM c GROUP BY ROLLUP (iteration)""")
def cost_rollup(v: Views):
    calls = v.table("events").selectExpr("event_type AS iteration", "user_id AS input_tokens", "event_id % 50 AS output_tokens")
    return R.cost_rollup(calls.withColumn("cost", R.cost(F.col("input_tokens"), F.col("output_tokens"), 0.25, 0.5)), "iteration")


@query("a15_describe", """
SELECT exit_reason, count(calc_time) AS n, round(avg(calc_time), 6) AS mean, round(stddev_samp(calc_time), 6) AS std, min(calc_time) AS low, max(calc_time) AS high,
  round(quantile_cont(calc_time, 0.05), 6) AS p05, round(quantile_cont(calc_time, 0.5), 6) AS p50, round(quantile_cont(calc_time, 0.95), 6) AS p95 FROM v_traj_head GROUP BY exit_reason""")
def describe(v: Views):
    df = R.describe(v.traj_head(), "calc_time", {"p05": 0.05, "p50": 0.5, "p95": 0.95}, ["exit_reason"])
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p05", "p50", "p95")})


_METRICS = ("tokens_prompt", "tokens_completion", "tokens_total", "n_steps", "llm_time", "env_time", "max_llm_step", "last_step_time")


@query("a15c_describe_totals", f"""
WITH t AS (SELECT conv_id % 2 = 0 AS solved, conv_id, count(*) AS n_steps, sum(token_prompt) AS tokens_prompt, sum(token_completion) AS tokens_completion, sum(token_prompt + token_completion) AS tokens_total,
    sum(llm_time) AS llm_time, sum(env_time) AS env_time, max(llm_time) AS max_llm_step, arg_max(llm_time + env_time, step_idx) AS last_step_time FROM v_traj GROUP BY conv_id),
  m AS ({" UNION ALL ".join(f"SELECT '{c}' AS metric, solved, {c}::DOUBLE AS v FROM t" for c in _METRICS)})
SELECT metric, solved, count(v) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS low, max(v) AS high, round(quantile_cont(v, 0.05), 6) AS p05, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.95), 6) AS p95
FROM m GROUP BY metric, solved""")
def describe_totals(v: Views):
    totals = J.totals(v.traj(), "conv_id").withColumn("solved", F.col("conv_id") % 2 == 0)
    df = R.describe_many(totals, _METRICS, {"p05": 0.05, "p50": 0.5, "p95": 0.95}, ["solved"])
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p05", "p50", "p95")})


@query("a15b_describe_by_reward", """
SELECT reward = 1 AS solved, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS low, max(value) AS high, round(quantile_cont(value, 0.75), 6) AS p75
FROM (SELECT CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS reward, value FROM events) GROUP BY 1""")
def describe_by_reward(v: Views):
    df = v.table("events").selectExpr("event_id % 2 = 0 AS solved", "value")
    out = R.describe(df, "value", {"p75": 0.75}, ["solved"])
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p75")})


@query("a28_commit_statistics", """
WITH m AS (SELECT number, pos, count(*) FILTER (line LIKE '+%' OR line LIKE '-%') AS edited FROM v_lines GROUP BY ALL)
SELECT count(*) AS n, round(avg(edited), 6) AS mean, min(edited)::DOUBLE AS low, max(edited)::DOUBLE AS high, round(stddev_samp(edited), 6) AS std, min(edited)::DOUBLE AS p0, round(quantile_cont(edited, 0.1), 6)::DOUBLE AS p10,
  round(quantile_cont(edited, 0.9), 6)::DOUBLE AS p90, max(edited)::DOUBLE AS p100 FROM m""")
def commit_statistics(v: Views):
    df = v.patches().select(P.n_changed(F.col("patch")).alias("edited"))
    out = R.describe(df, "edited", {"p0": 0.0, "p10": 0.1, "p90": 0.9, "p100": 1.0})
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p10", "p90")})


@query("a28b_commit_dates", """
SELECT strftime(min(authored_at), '%Y-%m-%d') AS first_day, strftime(max(authored_at), '%Y-%m-%d') AS last_day, count(*) FILTER (authored_at >= TIMESTAMP '2024-01-20 00:00:00') AS recent FROM v_commits""")
def commit_dates(v: Views):
    return v.commits().agg(
        F.date_format(F.min("authored_at"), "yyyy-MM-dd").alias("first_day"), F.date_format(F.max("authored_at"), "yyyy-MM-dd").alias("last_day"),
        F.count_if(F.col("authored_at") >= F.expr("TIMESTAMP_NTZ '2024-01-20 00:00:00'")).alias("recent"))


@query("a29_dataset_statistics", """
SELECT lang, count(*) AS n, round(avg(w), 6) AS mean, round(stddev_samp(w), 6) AS std, min(w)::DOUBLE AS low, max(w)::DOUBLE AS high, round(quantile_cont(w, 0.5), 6)::DOUBLE AS p50, round(quantile_cont(w, 0.9), 6)::DOUBLE AS p90
FROM (SELECT lang, len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\v]+')) AS w FROM documents) GROUP BY lang""")
def dataset_statistics(v: Views):
    words = F.size(F.regexp_extract_all("text", F.lit(r"[^ \t\n\r\f\x0B]+"), 0))
    df = R.describe(v.table("documents").select("lang", words.alias("w")), "w", {"p50": 0.5, "p90": 0.9}, ["lang"])
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p50", "p90")})


@query("s14_review_sheet", f"""
WITH {_COMBINED} SELECT instance_id, repo, model_name, coalesce(resolved::VARCHAR, '') AS resolved, coalesce(exit_status, '') AS exit_status, coalesce(api_calls::VARCHAR, '') AS api_calls,
  coalesce(model_patch, '') AS model_patch, '["a","b"]' AS "FAIL_TO_PASS", 'x' || chr(10) || 'y' AS hints_text, 23::BIGINT AS n_columns FROM cb""")
def review_sheet(v: Views):
    df = R.combined(*_parts(v)).withColumns({"FAIL_TO_PASS": F.array(F.lit("a"), F.lit("b")), "hints_text": F.lit("x\\ny")})
    sheet = R.review_sheet(df)
    n = len(sheet.columns)
    return sheet.select("instance_id", "repo", "model_name", "resolved", "exit_status", "api_calls", "model_patch", "FAIL_TO_PASS", "hints_text",
                        F.lit(n).cast("long").alias("n_columns"))
