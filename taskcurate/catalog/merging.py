"""Queries that merge, update and complete tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merging as M
from ..operators.ordered import id_blocks
from .registry import query
from .views import Views


def _versioned(v: Views):
    return v.pulls().select("number", "title", F.expr("CASE WHEN number % 4 > 0 THEN concat('v', number % 4) END").alias("version"))


_VERSIONED = "p AS (SELECT number, title, CASE WHEN number % 4 > 0 THEN 'v' || number % 4 END AS version FROM v_pulls)"


@query("f17_missing_version", f"WITH {_VERSIONED} SELECT count(*) FILTER (version IS NULL) AS missing, count(version) AS present FROM p")
def missing_version(v: Views):
    done, todo = M.split_by_version(_versioned(v))
    return todo.agg(F.count(F.lit(1)).alias("missing")).withColumn("present", done.agg(F.count(F.lit(1))).scalar())


@query("u01_concat_results", f"""
WITH {_VERSIONED}, u AS (SELECT number, version, NULL::BIGINT AS author FROM p UNION ALL SELECT number, 'x' AS version, author FROM v_pulls)
SELECT number, version, author FROM u WHERE version IS NOT NULL""")
def concat_results(v: Views):
    other = v.pulls().select("number", "author", F.lit("x").alias("version"))
    return M.split_by_version(M.concat_results(_versioned(v).drop("title"), other))[0]


@query("u02_with_precedence", """
WITH s AS (SELECT l_orderkey AS pull_number, l_partkey AS v, pos FROM v_items)
SELECT number AS pull_number, -1::BIGINT AS v FROM v_pulls WHERE number % 2 = 0
UNION ALL SELECT pull_number, arg_min(v, pos) FROM s WHERE pull_number NOT IN (SELECT number FROM v_pulls WHERE number % 2 = 0) GROUP BY pull_number""")
def with_precedence(v: Views):
    primary = v.pulls().filter("number % 2 = 0").selectExpr("number AS pull_number", "-1L AS v", "0L AS pos")
    secondary = v.items().selectExpr("l_orderkey AS pull_number", "l_partkey AS v", "pos")
    return M.with_precedence(primary, secondary, "pull_number", [F.col("pos")]).select("pull_number", "v")


@query("u03_first_and_last", """
SELECT number, arg_min(sha, pos) AS first_sha, arg_max(sha, pos) AS last_sha FROM v_commits GROUP BY number""")
def first_and_last(v: Views):
    c = v.commits().select("number", "pos", "sha")
    first = M.first_per_key(c, ["number"], [F.col("pos")]).select("number", F.col("sha").alias("first_sha"))
    return first.join(M.last_per_key(c, ["number"], [F.col("pos")]).select("number", F.col("sha").alias("last_sha")), "number")


@query("t03_number_order", "SELECT number::VARCHAR AS k, number FROM v_pulls ORDER BY number DESC")
def number_order(v: Views):
    df = v.pulls().select(F.col("number").cast("string").alias("k"), "number")
    return M.by_number_descending(df, "k")


@query("j07_update_fields", """
WITH c AS (SELECT l_orderkey AS number, min('new' || l_suppkey) AS title FROM lineitem WHERE l_partkey % 3 = 0 GROUP BY 1)
SELECT number, coalesce(c.title, p.title) AS title, p.repo FROM v_pulls p LEFT JOIN c USING (number)""")
def update_fields(v: Views):
    changes = v.table("lineitem").filter("l_partkey % 3 = 0").groupBy(F.col("l_orderkey").alias("number")).agg(
        F.min(F.concat(F.lit("new"), "l_suppkey")).alias("title"))
    return M.update_fields(v.pulls().select("number", "title", "repo"), changes, "number", ["title"])


@query("j08_upsert", """
WITH c AS (SELECT l_orderkey AS number, min('new' || l_suppkey) AS title FROM lineitem WHERE l_partkey % 3 = 0 GROUP BY 1), t AS (SELECT number, title, repo FROM v_pulls WHERE number % 2 = 0)
SELECT number, coalesce(c.title, t.title) AS title, repo FROM t LEFT JOIN c USING (number)
UNION ALL SELECT number, c.title, p.repo FROM v_pulls p JOIN c USING (number) WHERE number % 2 <> 0""")
def upsert(v: Views):
    changes = v.table("lineitem").filter("l_partkey % 3 = 0").groupBy(F.col("l_orderkey").alias("number")).agg(
        F.min(F.concat(F.lit("new"), "l_suppkey")).alias("title"))
    full = v.pulls().select("number", "title", "repo")
    return M.upsert(full.filter("number % 2 = 0"), changes, full, "number", ["title"])


@query("j24_embed_artifacts", """
SELECT 'I' || number AS instance_id, CASE number % 5 WHEN 0 THEN 'missing' WHEN 1 THEN 'unknown' WHEN 2 THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN number % 5 >= 3 THEN CASE WHEN number % 2 = 0 THEN 'run' ELSE 'eval' END END AS eval_script,
  CASE WHEN number % 3 = 0 THEN 'img' || number ELSE 'i' || number || '_root' END AS docker_image,
  CASE number % 5 WHEN 0 THEN 'res' WHEN 1 THEN 'res' WHEN 2 THEN 'own' END AS failure_reason FROM v_pulls""")
def embed_artifacts(v: Views):
    base = v.pulls().selectExpr("number", "concat('I', number) AS instance_id", "CASE WHEN number % 3 = 0 THEN concat('img', number) END AS docker_name")
    scripts = base.selectExpr("instance_id", "CASE WHEN number % 2 = 0 THEN 'run' END AS run_script", "'eval' AS eval_script")
    status = base.filter("number % 5 <> 0").selectExpr(
        "instance_id", "CASE number % 5 WHEN 1 THEN NULL WHEN 2 THEN 'failed' ELSE 'success' END AS status",
        "CASE WHEN number % 5 = 2 THEN 'own' END AS reason")
    results = base.selectExpr("instance_id", "'res' AS reason")
    return M.embed_artifacts(base, scripts, status, results)


@query("a30_group_members", """
SELECT version, number, row_number() OVER (PARTITION BY version ORDER BY number) AS member_no
FROM (SELECT number, coalesce('v' || nullif(number % 4, 0), 'none') AS version FROM v_pulls)""")
def group_members(v: Views):
    df = _versioned(v).withColumn("version", F.coalesce("version", F.lit("none")))
    return M.group_members(df, "version", "number", [F.col("number")], id_blocks(F.col("number")))


@query("a30b_repo_commits", "SELECT DISTINCT number % 7 AS repo, sha FROM v_commits")
def repo_commits(v: Views):
    return v.commits().selectExpr("number % 7 AS repo", "sha").distinct()


@query("a31_completeness", """
SELECT count(*) AS n_rows, count(merged_at) AS merged_at_present, sum(CASE WHEN number % 5 = 0 THEN 2 WHEN number % 5 = 1 THEN 1 ELSE 0 END)::BIGINT AS refs_items,
  count(*) FILTER (number % 5 IN (0, 1)) AS refs_non_empty FROM v_pulls""")
def completeness(v: Views):
    return M.completeness(v.pulls().withColumn("refs", F.regexp_extract_all("body", F.lit(r"#\d+"), 0)), ["merged_at"], ["refs"])


@query("a35_latest_run", """
SELECT number, arg_max('run_' || pos, pos) AS by_number, max('run_' || pos) AS by_text FROM v_commits GROUP BY number""")
def latest_run(v: Views):
    runs = v.commits().select("number", F.concat(F.lit("run_"), F.col("pos").cast("string")).alias("run"))
    num = M.latest_run(runs, "number", "run").withColumnRenamed("latest", "by_number")
    return num.join(M.latest_run(runs, "number", "run", lexical=True).withColumnRenamed("latest", "by_text"), "number")
