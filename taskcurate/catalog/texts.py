"""Queries over text cells, scripts, versions and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import patches as P
from ..functions import texts as X
from ..operators import rules
from .registry import query
from .views import Views


@query("w10_middle_cut", """
WITH l AS (SELECT doc_id, text, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS ls FROM documents)
SELECT doc_id, CASE WHEN len(ls) > 4 THEN array_to_string(ls[1:2], chr(10)) || chr(10) || repeat('-', 50) || chr(10) || '<Observation truncated in middle for saving context>' || chr(10) || repeat('-', 50) || chr(10)
  || array_to_string(ls[-2:], chr(10)) ELSE text END AS shown FROM l""")
def middle_cut(v: Views):
    return v.table("documents").select("doc_id", X.middle_cut(F.col("text"), 2).alias("shown"))


@query("w10b_numbered_log", """
WITH l AS (SELECT doc_id, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS ls FROM documents),
  n AS (SELECT doc_id, len(ls) AS n, list_transform(range(1, len(ls) + 1), lambda i: lpad(i::VARCHAR, length(len(ls)::VARCHAR)::INT, ' ') || '   ' || ls[i]) AS rs FROM l)
SELECT doc_id, CASE WHEN n > 5 THEN array_to_string(rs[1:2], chr(10)) || chr(10) || repeat(' ', length(n::VARCHAR)) || '   [..., ' || (n - 5) || ' lines omitted ...]' || chr(10) || array_to_string(rs[-3:], chr(10))
  ELSE array_to_string(rs, chr(10)) END AS shown FROM n""")
def numbered_log(v: Views):
    return v.table("documents").select("doc_id", X.numbered_log(F.col("text"), 5).alias("shown"))


@query("w10c_half_cut", """
SELECT doc_id, CASE WHEN length(text) > 200 THEN left(text, 100) || chr(10) || chr(10) || '... [TRUNCATED ' || (length(text) - 200) || ' chars] ...' || chr(10) || chr(10) || right(text, 100) ELSE text END AS shown FROM documents""")
def half_cut(v: Views):
    return v.table("documents").select("doc_id", X.half_cut(F.col("text"), 200).alias("shown"))


@query("w10d_preview", """
WITH b AS (SELECT doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS b FROM documents), s AS (SELECT doc_id, b, string_split(regexp_replace(left(b, 300), '\\n$', ''), chr(10)) AS ls FROM b)
SELECT doc_id, array_to_string(ls[1:3], chr(10)) || CASE WHEN length(b) > 300 OR len(ls) > 3 THEN chr(10) || '... (truncated)' ELSE '' END AS shown FROM s""")
def preview(v: Views):
    return v.table("documents").select("doc_id", X.preview(F.col("text"), 3, 300).alias("shown"))


@query("x09_new_file_diff", """
WITH l AS (SELECT doc_id, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS ls FROM documents)
SELECT doc_id, 'diff --git a/d/' || doc_id || '.txt b/d/' || doc_id || '.txt' || chr(10) || 'new file mode 100644' || chr(10) || '--- /dev/null' || chr(10) || '+++ b/d/' || doc_id || '.txt' || chr(10)
  || '@@ -0,0 +1,' || len(ls) || ' @@' || chr(10) || '+' || array_to_string(ls, chr(10) || '+') AS diff FROM l""")
def new_file_diff(v: Views):
    path = F.concat(F.lit("d/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return v.table("documents").select("doc_id", P.new_file_diff(path, F.col("text")).alias("diff"))


@query("x10_heredoc_round_trip", """
SELECT doc_id, unnest(['a/' || doc_id || '.py', 'b.py']) AS path, unnest([text, 'x = 1']) AS content FROM documents""")
def heredoc_round_trip(v: Views):
    files = F.array(
        F.struct(F.expr("concat('a/', doc_id, '.py')").alias("path"), F.col("text").alias("content")),
        F.struct(F.lit("b.py").alias("path"), F.lit("x = 1").alias("content")))
    return v.table("documents").select("doc_id", F.inline(X.heredoc_files(X.heredoc_script(files))))


@query("x10b_replace_heredocs", """
SELECT doc_id, 'set -e' || chr(10) || 'cat <<''EOF_TEST_0'' > "a.py"' || chr(10) || text || chr(10) || 'EOF_TEST_0' || chr(10) || 'cat <<''EOF_TEST_1'' > "b.py"' || chr(10) || 'old' || chr(10) || 'EOF_TEST_1' || chr(10) || 'pytest' AS script FROM documents""")
def replace_heredocs(v: Views):
    script = F.lit("set -e\ncat <<'EOF_TEST_0' > \"a.py\"\nplaceholder\nEOF_TEST_0\ncat <<'EOF_TEST_1' > \"b.py\"\nold\nEOF_TEST_1\npytest")
    return v.table("documents").select("doc_id", X.replace_heredocs(script, F.create_map(F.lit("a.py"), F.col("text"))).alias("script"))


@query("x10c_embedded_patch", "SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN text ELSE '' END AS patch FROM documents")
def embedded_patch(v: Views):
    script = F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("cd /testbed\ngit apply -v - <<'EOF_1'\n"), "text", F.lit("\nEOF_1\npytest"))).otherwise(F.lit("pytest"))
    return v.table("documents").select("doc_id", X.embedded_patch(script, "EOF_1").alias("patch"))


@query("w18_sanitised_script", """
SELECT doc_id, '# [sanitized] removed unsafe command: git reset --hard' || chr(10) || '# git clean -fdx' || chr(10) || 'git checkout tests/data/x' || chr(10) || 'cat <<''E'' > f' || chr(10) || 'git checkout x' || chr(10) || text || chr(10) || 'E' || chr(10)
  || '# [sanitized] removed unsafe command: git checkout main' || chr(10) || 'cat << X' || chr(10) || 'git reset --hard' AS script FROM documents""")
def sanitised_script(v: Views):
    script = F.concat(
        F.lit("  git reset --hard\n# git clean -fdx\ngit checkout tests/data/x\ncat <<'E' > f\ngit checkout x\n"), "text",
        F.lit("\nE\ngit checkout main\ncat << X\ngit reset --hard"))
    return v.table("documents").select("doc_id", X.sanitised_script(F.regexp_replace(script, "cat << X", "cat <<X")).alias("script")).withColumn(
        "script", F.replace("script", F.lit("cat <<X"), F.lit("cat << X")))


@query("x20_tagged_text", """
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN trim(text, ' ' || chr(10)) ELSE 'plain' END AS issue, 't/a.py' AS path, text || chr(10) AS content FROM documents""")
def tagged_text(v: Views):
    answer = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("hm [ISSUE]\n"), "text", F.lit("\n[/ISSUE] end"))).otherwise(F.lit("plain [/ISSUE] x"))
    files = F.concat(F.lit("Here:\n<test_file path=\"t/a.py\">\n"), "text", F.lit("\n</test_file> done"))
    df = v.table("documents").select("doc_id", X.issue_text(answer).alias("issue"), F.inline(X.tagged_files(files)))
    return df.withColumn("issue", F.regexp_replace("issue", r"^[ \n]+|[ \n]+\z", ""))


@query("x27_unquoted", r"""
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN text || chr(10) || 'a\b' || chr(9) || '"' WHEN 1 THEN text ELSE text || '\n"' END AS clean FROM documents""")
def unquoted(v: Views):
    raw = (F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('"'), "text", F.lit('\\na\\\\b\\t\\""')))
           .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("'"), "text", F.lit("'"))).otherwise(F.concat("text", F.lit('\\n"'))))
    return v.table("documents").select("doc_id", X.unquoted(raw).alias("clean"))


@query("x33_coerce", """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'a' || event_id || '|b' WHEN 1 THEN '' ELSE '' END AS items, CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS flag FROM events""")
def coerce(v: Views):
    raw = F.expr("""CASE event_id % 3 WHEN 0 THEN concat('["a', event_id, '","b"]') WHEN 1 THEN '[]' END""")
    flag = F.expr("CASE event_id % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'f' WHEN 2 THEN '1' ELSE 'maybe' END")
    return v.table("events").select("event_id", F.array_join(X.json_list(raw), "|").alias("items"), X.to_bool(flag).alias("flag"))


@query("x26b_judge_request", """
SELECT number, CASE WHEN number % 4 > 0 THEN 'Problem statement:' || chr(10) || CASE WHEN number % 3 = 0 THEN '(no problem statement)' ELSE title END || chr(10) || chr(10) || 'Patch:' || chr(10) || 'diff' || chr(10) || chr(10) || 'Code context:' || chr(10)
  || CASE WHEN number % 2 = 0 THEN 'c1' || chr(10) || chr(10) || 'c2' ELSE '(no code context available)' END END AS request FROM v_pulls""")
def judge_request(v: Views):
    ctx = F.when(F.col("number") % 2 == 0, F.array(F.lit("c1"), F.lit("c2"))).otherwise(F.array().cast("array<string>"))
    patch = F.when(F.col("number") % 4 > 0, F.lit("diff")).otherwise(F.lit(" "))
    return v.pulls().select("number", X.judge_request(F.when(F.col("number") % 3 > 0, F.col("title")), patch, ctx).alias("request"))


@query("x22_version_from_tag", """
SELECT number, pos, CASE WHEN pos % 3 = 0 THEN number % 9 || '.' || pos WHEN pos % 3 = 1 THEN strftime(authored_at, '%Y.%m') ELSE '0.0' END AS version FROM v_commits""")
def version_from_tag(v: Views):
    tag = F.when(F.col("pos") % 3 == 0, F.expr("concat('v', number % 9, '.', pos, '.4-12-gabc')"))
    when = F.when(F.col("pos") % 3 < 2, F.col("authored_at"))
    return v.commits().select("number", "pos", X.version_from_tag(tag, when).alias("version"))


@query("x21_version_from_text", """
SELECT number, CASE WHEN repo = 'dateutil/dateutil' AND number BETWEEN 510 AND 624 THEN '2.7' WHEN number % 5 = 4 THEN NULL WHEN repo IN ('django/django', 'tqdm/tqdm') THEN number % 8 || '.' || number % 6 ELSE number % 8 || '.' || number % 6 END AS version
FROM (SELECT number, CASE number % 4 WHEN 0 THEN 'django/django' WHEN 1 THEN 'dateutil/dateutil' WHEN 2 THEN 'tqdm/tqdm' ELSE 'prettier/prettier' END AS repo FROM v_pulls)""")
def version_from_text(v: Views):
    df = v.pulls().selectExpr(
        "number", "CASE number % 4 WHEN 0 THEN 'django/django' WHEN 1 THEN 'dateutil/dateutil' WHEN 2 THEN 'tqdm/tqdm' ELSE 'prettier/prettier' END AS repo",
        """CASE WHEN number % 5 = 4 THEN 'nothing' ELSE concat('\"\"\"VERSION = (9, 9)\"\"\"\\n', CASE number % 4 WHEN 0 THEN concat('VERSION = (', number % 8, ', ', number % 6, ', 1)')
            WHEN 1 THEN concat('Version   ', number % 8, '.', number % 6, '.3') WHEN 2 THEN concat('version_info = ', number % 8, ', ', number % 6, ', 2')
            ELSE concat('{"version": "', number % 8, '.', number % 6, '.0-rc"}') END) END AS text""")
    return rules.version_from_text(df, ["number"]).select("number", "version")


_REPOS = "CASE number % 5 WHEN 0 THEN 'django/django' WHEN 1 THEN 'dateutil/dateutil' WHEN 2 THEN 'tqdm/tqdm' WHEN 3 THEN 'jestjs/jest' ELSE 'psf/requests' END"


@query("x21b_version_from_files", f"""
WITH r AS (SELECT number, {_REPOS} AS repo, number % 8 || '.' || number % 6 AS first, number % 7 || '.' || number % 9 AS second FROM v_pulls)
SELECT number, CASE WHEN repo = 'dateutil/dateutil' AND number BETWEEN 510 AND 624 THEN '2.7' WHEN number % 3 > 0 AND number % 4 > 0 THEN first
  WHEN repo IN ('jestjs/jest', 'psf/requests') THEN second WHEN repo = 'tqdm/tqdm' THEN 'get_version' END AS version FROM r""")
def version_from_files(v: Views):
    # the first file is missing in every third commit and says nothing in every fourth; the second one always tells
    pulls = v.pulls().selectExpr("number", f"{_REPOS} AS repo", "concat('c', number) AS base_commit")
    files = v.pulls().selectExpr("number", f"{_REPOS} AS repo", "concat('c', number) AS commit", "concat(number % 8, '.', number % 6, '.1') AS a", "concat(number % 7, '.', number % 9, '.2') AS b").selectExpr(
        "number", "repo", "commit", """inline(CASE repo
        WHEN 'django/django' THEN array(struct('django/__init__.py' AS path, concat('VERSION = (', replace(a, '.', ', '), ')') AS text), struct('django/other.py' AS path, 'VERSION = (9, 9)' AS text))
        WHEN 'dateutil/dateutil' THEN array(struct('NEWS' AS path, concat('Version ', a) AS text))
        WHEN 'tqdm/tqdm' THEN array(struct('tqdm/_version.py' AS path, concat('version_info = ', replace(a, '.', ', '), ' ') AS text))
        WHEN 'jestjs/jest' THEN array(struct('lerna.json' AS path, concat('{"version": "', a, '"}') AS text), struct('package.json' AS path, concat('{"version": "', b, '"}') AS text))
        ELSE array(struct('requests/__version__.py' AS path, concat("__version__ = '", a, "'") AS text), struct('requests/__init__.py' AS path, concat("__version__ = '", b, "'") AS text)) END)""")
    first = F.col("path").isin("django/__init__.py", "NEWS", "tqdm/_version.py", "lerna.json", "requests/__version__.py")
    there = files.filter(~first | (F.col("number") % 3 > 0)).withColumn("text", F.when(first & (F.col("number") % 4 == 0), '"""VERSION = (8, 8)"""').otherwise(F.col("text")))
    return rules.version_from_files(pulls, there, ["number"])


@query("j18_test_suite", """
WITH p AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'd/check-' || page_id || '.test' WHEN 1 THEN 'fine-grained-cache' || page_id || '.test' WHEN 2 THEN 'x/fine-grained.test' WHEN 3 THEN 'semanal-xy.test' WHEN 4 THEN 'a/run-lists.test' ELSE url END AS path FROM pages)
SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'mypy/test/testcheck.py::TypeCheckSuite::check-' || page_id || '.test' WHEN 1 THEN 'mypy/test/testfinegrainedcache.py::FineGrainedCacheSuite::' || path
  WHEN 2 THEN 'mypy/test/testfinegrained.py::FineGrainedSuite::fine-grained.test' WHEN 3 THEN 'mypy/test/testsemanal.py::SemanticAnalyzerSuite::semanal-xy.test' WHEN 4 THEN 'mypyc/test/test_run.py::TestRun::run-lists.test' END AS command FROM p""")
def test_suite(v: Views):
    df = v.table("pages").selectExpr(
        "page_id", """CASE page_id % 6 WHEN 0 THEN concat('d/check-', page_id, '.test') WHEN 1 THEN concat('fine-grained-cache', page_id, '.test') WHEN 2 THEN 'x/fine-grained.test'
            WHEN 3 THEN 'semanal-xy.test' WHEN 4 THEN 'a/run-lists.test' ELSE url END AS path""")
    return df.select("page_id", rules.test_suite_command(F.col("path")).alias("command"))


@query("d03_parser_by_repo", "SELECT l_orderkey AS instance, pos, 3::BIGINT AS n FROM v_items")
def parser_by_repo(v: Views):
    from ..functions.logs import parser_for

    return v.logs().select("instance", "pos", F.size(parser_for("sympy")(F.col("log"))).cast("long").alias("n"))


@query("j22_expand_code_links", """
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)
SELECT doc_id, 0::BIGINT AS link_no, array_to_string(ls[1:3], chr(10)) AS excerpt FROM s""")
def expand_code_links(v: Views):
    from ..operators.issues import expand_code_links as expand

    docs = v.table("documents")
    lines = docs.select(F.lit("o/r").alias("repo"), F.expr("concat('s', doc_id)").alias("sha"), F.lit("a/b.py").alias("path"), F.posexplode(F.split("text", "\n")).alias("p", "line"))
    texts = docs.select("doc_id", F.expr("concat('see https://host.example/o/r/blob/s', doc_id, '/a/b.py#L1-L3 ok')").alias("text"))
    out = expand(texts, lines.withColumn("line_no", F.col("p") + 1))
    return out.select("doc_id", F.col("link_no").cast("long").alias("link_no"), "excerpt")
