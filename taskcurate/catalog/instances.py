"""Queries that select and shape pull requests and instances."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import patches as P
from ..functions import paths, titles
from ..operators import instances as I
from ..operators.ordered import id_blocks
from ..plans import curate
from .registry import query
from .views import Views

_TITLE = "regexp_matches(title, '(?i)(?:^|\\W)(?:fix(?:e[sd])?|bug|patch|hotfix|bugfix|feat|refactor|add|support|update|improvement)\\b')"
_ISSUES = r"""i AS (SELECT number, count(DISTINCT issue) AS n_issues FROM (SELECT number, regexp_extract(body, 'Closes #(\d+)', 1) AS issue FROM v_pulls WHERE body LIKE 'Closes #%'
    UNION ALL SELECT number, regexp_extract(message, 'Fixes #(\d+)', 1) FROM v_commits WHERE message LIKE 'Fixes #%') GROUP BY number)"""
_N_ISSUES = "coalesce(n_issues, CASE WHEN title LIKE '%#%' THEN 1 END, 0)::BIGINT"
_EDITS = "count(*) FILTER (line LIKE '+%' OR line LIKE '-%')"
_IID = "replace(repo || '-' || number || '-' || substr(sha, 1, 8), '/', '__')"


def _number_block():
    return id_blocks(F.col("number"))


@query("c01_instance_table", f"""
WITH {_ISSUES}, s AS (SELECT number, pos, count(*) FILTER (line LIKE '+%') AS lines_added, count(*) FILTER (line LIKE '-%') AS lines_removed,
    count(DISTINCT file_no) AS files_changed, count(*) FILTER (path LIKE 'tests/%' AND (line LIKE '+%' OR line LIKE '-%')) > 4 AS has_tests
  FROM v_lines GROUP BY number, pos HAVING {_EDITS} > 2 AND NOT bool_and(path LIKE '%/README.md'))
SELECT {_IID} AS instance_id, repo, number AS pull_number, sha, strftime(created_at, '%Y-%m-%d') AS created_at, {_N_ISSUES} AS n_issues, lines_added, lines_removed, files_changed, has_tests
FROM s JOIN v_commits USING (number, pos) JOIN v_pulls USING (number) LEFT JOIN i USING (number)
WHERE n_parents = 1 AND merged_at IS NOT NULL AND created_at < TIMESTAMP '2000-01-01 00:00:00' AND ({_N_ISSUES} > 0 OR {_TITLE})""")
def instance_table(v: Views):
    df = curate.instance_table(v.pulls(), v.commits(), v.patches(), F.expr("TIMESTAMP_NTZ '2000-01-01 00:00:00'"))
    return df.withColumns({"created_at": F.date_format("created_at", "yyyy-MM-dd"),
                           **{c: F.col(c).cast("long") for c in ("lines_added", "lines_removed", "files_changed")}})


@query("f01_valid_pulls", f"WITH {_ISSUES} SELECT number, title FROM v_pulls LEFT JOIN i USING (number) WHERE merged_at IS NOT NULL AND ({_N_ISSUES} > 0 OR {_TITLE})")
def valid_pulls(v: Views):
    return I.valid_pulls(curate.with_issue_counts(v.pulls(), v.commits()), F.col("n_issues")).select("number", "title")


@query("f02_valid_instances", "SELECT number, pos FROM v_files GROUP BY number, pos HAVING bool_or(path LIKE 'src/%')")
def valid_instances(v: Views):
    ctx = P.listed_files(F.col("patch"))
    return I.valid_instances(v.patches().withColumn("patch_context", ctx)).select("number", "pos")


@query("f06_before_cutoff", "SELECT number FROM v_pulls WHERE created_at < TIMESTAMP '1997-06-01 00:00:00'")
def before_cutoff(v: Views):
    return I.before_cutoff(v.pulls(), F.expr("TIMESTAMP_NTZ '1997-06-01 00:00:00'")).select("number")


@query("f07_without_merges", "SELECT number, pos, sha FROM v_commits WHERE n_parents = 1")
def without_merges(v: Views):
    return I.without_merges(v.commits()).select("number", "pos", "sha")


@query("f13_message_flags", """
SELECT number, lower(title) LIKE '%fix%' OR lower(title) LIKE '%bug%' AS is_bugfix, lower(title) LIKE '%feature%' OR lower(title) LIKE '%add%' AS is_feature,
  lower(title) LIKE '%refactor%' AS is_refactor FROM v_pulls""")
def message_flags(v: Views):
    return v.pulls().select("number", *[c.alias(n) for n, c in titles.message_flags(F.col("title")).items()])


@query("f18_marked_split", "SELECT count(*) FILTER (toxic = 1) AS removed, count(*) FILTER (toxic <> 1) AS kept FROM labels")
def marked_split(v: Views):
    df = v.table("labels").withColumn("mark_for_deletion", F.col("toxic") == 1)
    return df.agg(F.count_if("mark_for_deletion").alias("removed"), F.count_if(~F.col("mark_for_deletion")).alias("kept"))


@query("f22_non_empty_predictions", "SELECT traj_id FROM v_traj_head WHERE output_patch <> ''")
def non_empty_predictions(v: Views):
    return v.traj_head().filter(~P.is_blank(F.col("output_patch"))).select("traj_id")


@query("j03_resume_not_seen", "SELECT number FROM v_pulls p WHERE NOT EXISTS (SELECT 1 FROM v_commits c WHERE c.number = p.number AND c.n_parents = 2)")
def resume_not_seen(v: Views):
    return I.not_seen(v.pulls(), v.commits().filter("n_parents = 2"), ["number"]).select("number")


@query("j04_select_ids", """
WITH ids AS (SELECT DISTINCT l_partkey AS number FROM lineitem)
SELECT 'found' AS side, number FROM v_pulls WHERE number IN (SELECT number FROM ids)
UNION ALL SELECT 'missing', number FROM ids WHERE number NOT IN (SELECT number FROM v_pulls)""")
def select_ids(v: Views):
    ids = v.table("lineitem").select(F.col("l_partkey").alias("number")).distinct()
    found, missing = I.select_ids(v.pulls(), ids, "number")
    return found.select(F.lit("found").alias("side"), "number").unionByName(missing.select(F.lit("missing").alias("side"), "number"))


@query("t01_top_repositories", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS stars FROM customer WHERE c_mktsegment = 'MACHINERY' ORDER BY c_acctbal DESC, c_custkey LIMIT 10""")
def top_repositories(v: Views):
    df = v.table("customer").filter("c_mktsegment = 'MACHINERY'").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS stars")
    return I.first_n(df, [F.col("stars").desc(), F.col("id")], 10)


@query("t04_limit_then_drop_done", """
SELECT number FROM (SELECT number FROM v_pulls ORDER BY number LIMIT 500) WHERE number NOT IN (SELECT l_partkey FROM lineitem)""")
def limit_then_drop_done(v: Views):
    done = v.table("lineitem").select(F.col("l_partkey").alias("number"))
    return I.todo_after_limit(v.pulls(), done, ["number"], [F.col("number")], 500).select("number")


@query("t05_max_instances", "SELECT number, title FROM v_pulls WHERE merged_at IS NOT NULL ORDER BY number LIMIT 100")
def max_instances(v: Views):
    return I.first_n(v.pulls().filter("merged_at IS NOT NULL").select("number", "title"), [F.col("number")], 100)


@query("t06_slice", "SELECT number FROM v_pulls ORDER BY number LIMIT 50 OFFSET 200")
def slice_rows(v: Views):
    return I.first_n(v.pulls().select("number"), [F.col("number")], 50, start=200)


@query("w09_batches", """
SELECT number, ((row_number() OVER (ORDER BY number) - 1) // 300)::BIGINT AS batch, (ntile(7) OVER (ORDER BY number) - 1)::BIGINT AS part FROM v_pulls""")
def batches(v: Views):
    pulls = v.pulls().select("number")
    sliced = I.batches(pulls, [F.col("number")], _number_block(), 300)
    parts = I.near_equal_parts(pulls, [F.col("number")], _number_block(), 7)
    return sliced.join(parts, "number")


@query("w08_decompose", """
WITH g AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY number) > 6 THEN (file_pos - 1) // 4 END AS g FROM v_wide)
SELECT 'i' || number || CASE WHEN g IS NULL THEN '' ELSE '-g' || g END AS id, count(*) AS n_files, min(file_pos)::BIGINT AS first_file FROM g GROUP BY ALL""")
def decompose(v: Views):
    df = I.decompose(v.wide(), "number")
    gid = I.group_id(F.concat(F.lit("i"), F.col("number").cast("string")), F.col("group_no"))
    return df.groupBy(gid.alias("id")).agg(F.count(F.lit(1)).alias("n_files"), F.min("file_pos").alias("first_file"))


_WIDE_TESTS = """g AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY number) > 6 THEN (file_pos - 1) // 4 END AS g FROM v_wide),
  code AS (SELECT number, g, regexp_extract(path, '([^/]*)\\.py$', 1) AS stem, 'src' AS dir FROM g WHERE g IS NOT NULL),
  tests AS (SELECT DISTINCT l_orderkey // 4 AS number, CASE WHEN l_suppkey % 50 = 0 THEN 'src/tests' ELSE 'checks' END AS dir, 'm' || (l_partkey + l_suppkey % 2) AS stem FROM lineitem),
  dirs AS (SELECT DISTINCT number, g, dir FROM code),
  hit AS (SELECT t.number, t.dir, t.stem, c.g FROM tests t JOIN code c ON t.number = c.number AND t.stem = c.stem
    UNION SELECT t.number, t.dir, t.stem, d.g FROM tests t JOIN dirs d ON t.number = d.number WHERE contains(t.dir, d.dir) OR contains(d.dir, t.dir)),
  dealt AS (SELECT number, g::BIGINT AS group_no, dir || '/test_' || stem || '.py' AS test_path, true AS matched FROM hit
    UNION ALL SELECT t.number, 0, t.dir || '/test_' || t.stem || '.py', false FROM tests t SEMI JOIN dirs ON dirs.number = t.number ANTI JOIN hit h ON h.number = t.number AND h.dir = t.dir AND h.stem = t.stem)"""


def _wide_tests(v: Views):
    return v.table("lineitem").selectExpr(
        "l_orderkey div 4 AS number",
        "concat(CASE WHEN l_suppkey % 50 = 0 THEN 'src/tests' ELSE 'checks' END, '/test_m', l_partkey + l_suppkey % 2, '.py') AS path")


@query("w08b_assign_tests", f"WITH {_WIDE_TESTS} SELECT number, group_no, test_path FROM dealt")
def assign_tests(v: Views):
    return I.assign_tests(I.decompose(v.wide(), "number"), _wide_tests(v), "number").drop("matched")


@query("w08c_sub_instances", f"""
WITH {_WIDE_TESTS}, files AS (SELECT number, coalesce(g, -1) AS g, file_pos, path FROM g),
  ctx AS (SELECT number, g, string_agg(path, ',' ORDER BY file_pos) AS patch_context FROM files GROUP BY ALL),
  placed AS (SELECT number, path, min(file_pos) AS place FROM v_wide GROUP BY ALL),
  pat AS (SELECT number, g, string_agg('diff ' || path, chr(10) ORDER BY place) || chr(10) AS patch FROM (SELECT DISTINCT number, g, path FROM files) JOIN placed USING (number, path) GROUP BY ALL),
  td AS (SELECT number, group_no AS g, test_path, matched FROM dealt UNION ALL SELECT t.number, -1, dir || '/test_' || stem || '.py', true FROM tests t WHERE number IN (SELECT number FROM files WHERE g = -1)),
  tp AS (SELECT number, g, string_agg('test ' || test_path, chr(10) ORDER BY matched DESC, test_path) || chr(10) AS test_patch FROM td GROUP BY ALL)
SELECT 'i' || number || CASE WHEN g >= 0 THEN '-g' || g ELSE '' END AS id, patch_context, coalesce(patch, '') AS patch, coalesce(test_patch, '') AS test_patch FROM ctx LEFT JOIN pat USING (number, g) LEFT JOIN tp USING (number, g)""")
def sub_instances(v: Views):
    wide = v.wide()
    code = wide.groupBy("number", "path").agg(F.min("file_pos").alias("at")).withColumn("diff", F.concat(F.lit("diff "), "path"))
    tests = _wide_tests(v).distinct().select("number", "path", F.col("path").alias("at"), F.concat(F.lit("test "), "path").alias("diff"))
    out = I.sub_instances(I.decompose(wide, "number"), code, tests, "number")
    gid = I.group_id(F.concat(F.lit("i"), F.col("number").cast("string")), F.col("group_no"))
    return out.select(gid.alias("id"), F.array_join("patch_context", ",").alias("patch_context"), "patch", "test_patch")


@query("j11_match_tests", """
WITH f AS (SELECT number, path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, replace(regexp_extract(path, '[^/]*$'), '.py', '') AS base FROM v_files),
  t AS (SELECT DISTINCT number, path, dir, replace(replace(base, 'test_', ''), '_test', '') AS base FROM f WHERE path LIKE 'tests/%')
SELECT DISTINCT t.number, t.path AS test_path FROM t JOIN f c ON t.number = c.number AND c.path LIKE 'src/%' AND (t.base = c.base OR contains(t.dir, c.dir) OR contains(c.dir, t.dir))""")
def match_tests(v: Views):
    files = v.patch_files().selectExpr("number", "inline(heads)")
    return I.match_tests(files.filter(paths.is_test_file(F.col("path"))), files.filter("path LIKE 'src/%'"), ["number"])


@query("j17b_test_targets", """
WITH f AS (SELECT DISTINCT number, pos, path FROM v_files), t AS (SELECT DISTINCT number % 5 AS repo, CASE number % 3 WHEN 0 THEN 'unit/src/x_' || pos % 50 || '.py' WHEN 1 THEN 'tests/test_m' || pos % 400 || '.py' ELSE 'unit/test_src' || pos % 2 || '.py' END AS path FROM v_commits),
  base AS (SELECT *, regexp_extract(path, '[^/]*$') AS base, regexp_extract(path, '([^/]*)/[^/]*$', 1) AS parent FROM t),
  p AS (SELECT DISTINCT number, pos, number % 5 AS repo, 'x_' || pos % 50 || '.py' AS name FROM v_commits WHERE number % 4 = 0),
  a AS (SELECT DISTINCT p.number, p.pos, 'test_patch' AS rule, base.path AS target FROM p JOIN base ON base.repo = p.repo AND suffix(base.path, p.name)),
  c AS (SELECT DISTINCT number, pos, number % 5 AS repo, path, replace(regexp_extract(path, '[^/]*$'), '.py', '') AS stem, regexp_extract(path, '([^/]*)/[^/]*$', 1) AS parent FROM f WHERE path LIKE 'src/%'),
  d AS (SELECT DISTINCT repo, path, stem, parent FROM c),
  n AS (SELECT d.repo, d.path, min(b.path) AS target FROM d JOIN base b ON b.repo = d.repo AND suffix(b.base, stem || '.py') AND (suffix(b.base, 'test_' || stem || '.py') OR suffix(b.base, 'test' || stem || '.py')) GROUP BY ALL),
  r AS (SELECT d.* FROM d ANTI JOIN n USING (repo, path)), first AS (SELECT repo, parent, arg_min(regexp_extract(path, '^(.*)/[^/]*$', 1), path) AS folder, min(path) AS first FROM base GROUP BY ALL),
  m AS (SELECT repo, path, 'name' AS rule, target FROM n UNION ALL SELECT r.repo, r.path, 'folder', folder FROM r JOIN first USING (repo, parent)
    UNION ALL SELECT r.repo, r.path, 'parent', b.path FROM r LEFT JOIN first USING (repo, parent) JOIN base b ON b.repo = r.repo AND b.base IN ('test_' || r.parent || '.py', 'test' || r.parent || '.py', r.parent || '_test.py', r.parent || 'test.py') AND (first IS NULL OR b.path < first)),
  x AS (SELECT DISTINCT c.number, c.pos, rule, target FROM c JOIN m USING (repo, path) ANTI JOIN a ON a.number = c.number AND a.pos = c.pos),
  e AS (SELECT * FROM a UNION ALL SELECT * FROM x ANTI JOIN (SELECT number, pos, target AS folder FROM x WHERE rule = 'folder') y ON y.number = x.number AND y.pos = x.pos AND x.target LIKE '%.py' AND regexp_extract(x.target, '^(.*)/[^/]*$', 1) = folder)
SELECT number || '-' || pos AS instance, rule, target FROM e""".replace("suffix(", "ends_with("))
def test_targets(v: Views):
    c = v.commits()
    tests = c.selectExpr("number % 5 AS repo", """CASE number % 3 WHEN 0 THEN concat('unit/src/x_', pos % 50, '.py') WHEN 1 THEN concat('tests/test_m', pos % 400, '.py') ELSE concat('unit/test_src', pos % 2, '.py') END AS path""")
    patched = c.filter("number % 4 = 0").selectExpr("concat(number, '-', pos) AS instance", "number % 5 AS repo", "concat('deep/x_', pos % 50, '.py') AS path")
    code = v.patch_files().selectExpr("number", "pos", "inline(heads)").filter("path LIKE 'src/%'").selectExpr("concat(number, '-', pos) AS instance", "number % 5 AS repo", "path")
    return I.test_targets(code, tests, patched, "instance")


@query("j17_candidate_tests", """
WITH code AS (SELECT DISTINCT path, regexp_extract(path, 'm(\\d+)\\.py', 1) AS k FROM v_files WHERE path LIKE 'src/m%'),
  t AS (SELECT DISTINCT path, regexp_extract(path, 'm(\\d+)\\.py', 1) AS k FROM v_files WHERE path LIKE 'tests/%')
SELECT c.path, t.path AS target FROM code c JOIN t USING (k)""")
def candidate_tests(v: Views):
    files = v.patch_files().selectExpr("inline(heads)").withColumn("repo", F.lit("r"))
    df = I.candidate_tests(files.filter("path LIKE 'src/m%'"), files.filter(paths.is_test_file(F.col("path"))))
    return df.select("path", "target")


@query("x24_ids", f"""
SELECT number, pos, {_IID} AS instance_id, replace(repo || '-' || number, '/', '__') AS pull_id,
  'reg/' || lower(replace({_IID}, '__', '_')) || ':latest' AS image, substr(sha, 1, 8) AS short_commit, repo AS repo_back, 'a/b.py' AS norm
FROM v_commits JOIN v_pulls USING (number)""")
def ids(v: Views):
    df = v.commits().join(v.pulls().select("number", "repo"), "number")
    iid = paths.instance_id(F.col("repo"), F.col("number"), F.col("sha"))
    img = F.concat(F.lit("host/"), F.replace("repo", F.lit("/"), F.lit("__")), F.lit("."), F.substring("sha", 1, 8))
    return df.select(
        "number", "pos", iid.alias("instance_id"), paths.pull_id(F.col("repo"), F.col("number")).alias("pull_id"),
        paths.image_name(iid, "reg").alias("image"), paths.image_commit(img).alias("short_commit"),
        paths.image_repo(img).alias("repo_back"), paths.normalise(F.lit("..//./a/b.py")).alias("norm"))


@query("d01_custom_predicate", "SELECT number FROM v_pulls WHERE number % 3 = 0 AND merged_at IS NOT NULL")
def custom_predicate(v: Views):
    return I.keep_when(v.pulls(), lambda d: d["number"] % 3 == 0, lambda d: d["merged_at"].isNotNull()).select("number")
