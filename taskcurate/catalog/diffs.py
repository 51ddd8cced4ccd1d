"""Queries over patches and diff lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import patches as P
from ..functions import paths
from ..operators import diffs
from .registry import query
from .views import Views

ID = ["number", "pos"]
_EDITS = "count(*) FILTER (line LIKE '+%' OR line LIKE '-%')"


def _long(df, *cols):
    return df.withColumns({c: F.col(c).cast("long") for c in cols})


@query("a02_patch_stats", f"""
SELECT number, pos, count(*) FILTER (line LIKE '+%') AS added, count(*) FILTER (line LIKE '-%') AS removed,
       count(DISTINCT file_no) AS files, {_EDITS} AS total
FROM v_lines GROUP BY number, pos""")
def patch_stats(v: Views):
    p = F.col("patch")
    df = v.patches().select(*ID, P.n_added(p).alias("added"), P.n_removed(p).alias("removed"),
                            F.size(P.files(p)).alias("files"), P.n_changed(p).alias("total"))
    return _long(df, "added", "removed", "files", "total")


@query("f03_has_real_tests", f"""
SELECT number, pos FROM v_lines WHERE path LIKE 'tests/%' GROUP BY number, pos HAVING {_EDITS} > 4""")
def has_real_tests(v: Views):
    return v.patches().filter(P.has_real_tests(P.test_part(F.col("patch")))).select(*ID)


@query("f04_readme_only", """
SELECT number, pos FROM v_files GROUP BY number, pos HAVING bool_and(path LIKE '%/README.md')""")
def readme_only(v: Views):
    return v.patches().filter(P.is_readme_only(F.col("patch"))).select(*ID)


@query("f05_trivial_patch", f"""
SELECT number, pos FROM v_lines GROUP BY number, pos HAVING {_EDITS} <= 2""")
def trivial_patch(v: Views):
    return v.patches().filter(P.is_trivial(F.col("patch"))).select(*ID)


@query("f08_language_files", """
SELECT number, pos, path, NOT path LIKE 'tests/%' AND pos % 3 <> 0 AS in_context FROM v_files WHERE path LIKE '%.py'""")
def language_files(v: Views):
    files = v.patch_files().selectExpr("number", "pos", "inline(heads)").withColumn(
        "status", F.when(F.col("pos") % 3 == 0, "removed").otherwise("modified"))
    path = F.col("path")
    return files.filter(paths.is_python(path) & ~paths.is_binary(path)).select(
        *ID, "path", (F.col("status").isin(*paths.CONTEXT_STATUSES) & ~paths.is_test_by_words(path)).alias("in_context"))


@query("f09_test_file_predicates", """
SELECT path, bool_or(path LIKE 'tests/%') AS by_words, bool_or(path LIKE 'tests/%') AS by_header,
       bool_or(path LIKE 'tests/%') AS by_file, false AS by_case FROM v_files GROUP BY path""")
def test_file_predicates(v: Views):
    p = F.col("path")
    return v.patch_files().selectExpr("inline(heads)").select("path").distinct().select(
        "path", paths.is_test_by_words(p).alias("by_words"), paths.is_test_header(p).alias("by_header"),
        paths.is_test_file(p).alias("by_file"), paths.is_case_file(p).alias("by_case"))


_METRICS = f"""SELECT number, pos, count(DISTINCT file_no) AS n_files, count(DISTINCT file_no) FILTER (path LIKE 'tests/%') AS n_test_files,
  count(DISTINCT file_no) FILTER (path NOT LIKE 'tests/%') AS n_code_files, count(*) FILTER (line LIKE '@@ %') AS n_hunks,
  {_EDITS} AS n_edited, count(*) FILTER (path NOT LIKE 'tests/%' AND (line LIKE '+%' OR line LIKE '-%')) AS n_code_edited,
  coalesce(sum(length(line) + 1) FILTER (path LIKE '%.py'), 0)::BIGINT
    + coalesce(sum(CASE WHEN line_no = 1 AND path LIKE '%.py' THEN 4 * length(path) + 31 END), 0)::BIGINT AS n_python_chars
  FROM v_lines GROUP BY number, pos"""


@query("a07_commit_metrics", _METRICS)
def commit_metrics(v: Views):
    df = v.patches().select(*ID, P.file_stats(F.col("patch")).alias("s"))
    return df.select(*ID, *[c.cast("long").alias(n) for n, c in P.commit_metrics(F.col("s")).items()])


@query("a07b_edited_lines_switches", """
SELECT number, pos, count(*) FILTER (path LIKE '%.py' AND (line LIKE '+%' OR line LIKE '-%')) AS python_lines,
  count(*) FILTER (path LIKE 'tests/%' AND (line LIKE '+%' OR line LIKE '-%')) AS test_lines,
  count(*) FILTER (path NOT LIKE 'tests/%' AND path <> 'src/m3.py' AND (line LIKE '+%' OR line LIKE '-%')) AS code_lines
FROM v_lines GROUP BY number, pos""")
def edited_lines_switches(v: Views):
    s = F.col("s")
    return v.patches().select(*ID, P.file_stats(F.col("patch")).alias("s")).select(
        *ID, P.edited_lines(s).cast("long").alias("python_lines"),
        P.edited_lines(s, code_files=False).cast("long").alias("test_lines"),
        P.edited_lines(s, test_files=False, exclude=["src/m3.py"], only_python=False).cast("long").alias("code_lines"))


@query("f10_small_commits", f"""
SELECT number, pos FROM ({_METRICS}) WHERE n_code_files BETWEEN 1 AND 4 AND n_hunks > 0 AND n_code_edited BETWEEN 1 AND 199 AND n_python_chars < 10000""")
def small_commits(v: Views):
    return v.patches().filter(P.is_small_commit(P.file_stats(F.col("patch")))).select(*ID)


@query("f10b_long_commits", f"""
SELECT number, pos FROM ({_METRICS}) WHERE NOT (n_code_files BETWEEN 1 AND 4 AND n_hunks > 0 AND n_code_edited BETWEEN 1 AND 199 AND n_python_chars < 10000)""")
def long_commits(v: Views):
    return v.patches().filter(~P.is_small_commit(P.file_stats(F.col("patch")))).select(*ID)


@query("f11_python_only", """
SELECT number, pos FROM v_files GROUP BY number, pos HAVING bool_or(path LIKE '%.py')""")
def python_only(v: Views):
    return v.patches().filter(P.is_python_only(F.col("patch"))).select(*ID)


@query("f14_hunk_kinds", """
WITH h AS (SELECT number, pos, file_no, hunk_no, bool_and(coalesce(type, '') <> 'deleted') AS ins, bool_and(coalesce(type, '') <> 'added') AS del,
  bool_and(type IS NULL OR type = 'added' OR trim(content) = '' OR content LIKE 'import%') AS imp FROM v_hunks GROUP BY ALL)
SELECT number, pos, bool_and(ins) AS all_insert, bool_and(del) AS all_delete, bool_and(imp) AS all_import, bool_and(ins OR del) AS all_insert_or_delete
FROM h GROUP BY number, pos""")
def hunk_kinds(v: Views):
    return v.patches().select(*ID, P.hunk_kinds(F.col("patch")).alias("k")).select(*ID, "k.*")


@query("f23_date_floor", """
SELECT number, pos FROM v_commits WHERE authored_at > TIMESTAMP '2024-01-16 00:00:00'""")
def date_floor(v: Views):
    return v.commits().filter("authored_at > TIMESTAMP_NTZ '2024-01-16 00:00:00'").select(*ID)


@query("f25_filter_funnel", f"""
WITH m AS ({_METRICS}), c AS (SELECT number, pos, authored_at FROM v_commits), f AS (SELECT number, pos, bool_or(path LIKE '%.py') AS py, bool_or(path LIKE 'tests/%') AS tst FROM v_files GROUP BY ALL),
  x AS (SELECT authored_at > TIMESTAMP '2024-01-05 00:00:00' AS s1, n_code_files BETWEEN 1 AND 4 AND n_hunks > 0 AND n_code_edited BETWEEN 1 AND 199 AND n_python_chars < 10000 AS s2, py AS s3, tst AS s4
    FROM m JOIN c USING (number, pos) JOIN f USING (number, pos))
SELECT count(*) AS loaded, count(*) FILTER (s1) AS after_date, count(*) FILTER (s1 AND s2) AS after_small, count(*) FILTER (s1 AND s2 AND s3) AS after_python,
  count(*) FILTER (s1 AND s2 AND s3 AND s4) AS after_tests FROM x""")
def filter_funnel(v: Views):
    from ..operators.instances import funnel

    stats = v.patches().select(*ID, F.explode(F.array(P.file_stats(F.col("patch")))).alias("stats"))
    df = stats.join(v.commits().select("number", "pos", "authored_at"), ID)
    p = F.col("stats")
    return funnel(df, {
        "after_date": F.col("authored_at") > F.expr("TIMESTAMP_NTZ '2024-01-05 00:00:00'"),
        "after_small": P.is_small_commit(p),
        "after_python": P.has_python_only(p),
        "after_tests": F.exists(p, lambda f: f["is_test"]),
    })


@query("f26_listed_files", """
SELECT number, pos, path FROM v_files WHERE path LIKE 'tests/%' OR path LIKE 'src/%'""")
def listed_files(v: Views):
    return v.patches().select(*ID, F.explode(P.listed_files(F.col("patch"), want_tests=True)).alias("path"))


@query("f29_case_file_edit", """
SELECT number, pos, bool_or(path LIKE 'src/m1%') AS touches FROM v_files GROUP BY number, pos""")
def case_file_edit(v: Views):
    renamed = v.patches().withColumn("patch", F.regexp_replace("patch", r"src/m1(\d*)\.py", r"check-m1$1.test"))
    return renamed.select(*ID, P.touches_case_file(F.col("patch")).alias("touches"))


@query("f30_keyword_search", """
SELECT DISTINCT path FROM v_files WHERE contains(lower(regexp_extract(path, '[^/]*$')), 'm1') ORDER BY path LIMIT 50""")
def keyword_search(v: Views):
    from ..operators.instances import search_paths

    return search_paths(v.patch_files().selectExpr("inline(heads)").select("path"), "M1")


@query("w13_segment", """
SELECT number, pos, file_no::BIGINT AS file_no, path, hunk_no::BIGINT AS hunk_no,
  (row_number() OVER (PARTITION BY number, pos, file_no, hunk_no ORDER BY line_no) - 1)::BIGINT AS "at", line FROM v_hunks QUALIFY "at" > 0""")
def segment(v: Views):
    df = diffs.diff_lines(v.patches(), ID).select(*ID, "file_no", "path", "hunk_no", "at", "line")
    return _long(df, "file_no", "hunk_no", "at")


@query("w14_line_numbers", """
WITH h AS (SELECT *, regexp_extract(first_value(line) OVER w, '-(\\d+)', 1)::BIGINT AS o, regexp_extract(first_value(line) OVER w, '\\+(\\d+)', 1)::BIGINT AS n
  FROM v_hunks WINDOW w AS (PARTITION BY number, pos, file_no, hunk_no ORDER BY line_no))
SELECT number, pos, file_no::BIGINT AS file_no, hunk_no::BIGINT AS hunk_no, type,
  (CASE WHEN type IN ('context', 'deleted') THEN o + count(*) FILTER (type IN ('context', 'deleted')) OVER w2 - 1 END)::BIGINT AS old_line,
  (CASE WHEN type IN ('context', 'added') THEN n + count(*) FILTER (type IN ('context', 'added')) OVER w2 - 1 END)::BIGINT AS new_line
FROM h WINDOW w2 AS (PARTITION BY number, pos, file_no, hunk_no ORDER BY line_no) QUALIFY type IS NOT NULL""")
def line_numbers(v: Views):
    df = diffs.line_numbers(diffs.diff_lines(v.patches(), ID), ID)
    return _long(df, "file_no", "hunk_no", "old_line", "new_line").select(*ID, "file_no", "hunk_no", "type", "old_line", "new_line")


@query("x04_parse_headers", """
SELECT number, pos, path, hunk_no::BIGINT AS hunk_no, regexp_extract(line, '-(\\d+)', 1)::BIGINT AS old_start, 3::BIGINT AS old_length,
  regexp_extract(line, '\\+(\\d+)', 1)::BIGINT AS new_start, 4::BIGINT AS new_length, CASE WHEN hunk_no = 2 THEN 'def tail' ELSE '' END AS section
FROM v_hunks WHERE type IS NULL""")
def parse_headers(v: Views):
    h = diffs.explode_hunks(diffs.explode_files(v.patches(), ID), ID).select(*ID, "path", "hunk_no", "head.*")
    return _long(h, "hunk_no", "old_start", "old_length", "new_start", "new_length")


@query("x05_render_code_only", """
SELECT number, pos, string_agg('diff --git a/' || path || ' b/' || path || chr(10) || '--- a/' || path || chr(10) || '+++ b/' || path || chr(10)
  || array_to_string(body, chr(10)), chr(10) ORDER BY file_no) || chr(10) AS patch FROM v_files WHERE path LIKE 'src/%' GROUP BY number, pos""")
def render_code_only(v: Views):
    kept = P.select_files(F.col("patch"), lambda p: ~paths.is_test_file(p) & paths.is_python(p))
    return v.patches().select(*ID, kept.alias("patch")).filter("patch <> ''")


@query("x06_round_trip", "SELECT count(*) AS kept, 0::BIGINT AS rejected FROM v_patches")
def round_trip(v: Views):
    same = F.trim(P.render(F.col("patch"))) == F.trim("patch")
    return v.patches().agg(F.count_if(same).alias("kept"), F.count_if(~same).alias("rejected"))


_PART = """coalesce(string_agg('diff --git a/' || path || ' b/' || path || chr(10) || '--- a/' || path || chr(10) || '+++ b/' || path || chr(10)
  || array_to_string(body, chr(10)), chr(10) ORDER BY file_no) FILTER ({0}) || chr(10), '')"""


@query("x07_code_test_split", f"""
SELECT number, pos, {_PART.format("path NOT LIKE 'tests/%'")} AS code_patch, {_PART.format("path LIKE 'tests/%'")} AS test_patch
FROM v_files GROUP BY number, pos""")
def code_test_split(v: Views):
    p = F.concat(F.col("patch"), F.lit("\n"))
    return v.patches().select(*ID, P.code_part(p).alias("code_patch"), P.test_part(p).alias("test_patch"))


@query("x08_added_source", """
SELECT number, pos, path, coalesce(string_agg(substr(line, 2), chr(10) ORDER BY line_no) FILTER (line LIKE '+%'), '') AS source FROM v_lines GROUP BY number, pos, path""")
def added_source(v: Views):
    return diffs.explode_files(v.patches(), ID).select(*ID, "path", P.added_source(F.col("file_patch")).alias("source"))


@query("u07_touched_paths", """
SELECT number, pos, string_agg(path, ',' ORDER BY file_no) AS touched FROM v_files GROUP BY number, pos""")
def touched_paths(v: Views):
    return v.patches().select(*ID, F.array_join(P.touched_paths(F.col("patch")), ",").alias("touched"))


@query("x34_omit_bodies", """
SELECT number, pos, string_agg('diff --git a/' || path || ' b/' || path || chr(10) || '--- a/' || path || chr(10) || '+++ b/' || path || chr(10)
  || '[HUNK CONTENT OMITTED]', chr(10) ORDER BY file_no) AS patch FROM v_files GROUP BY number, pos""")
def omit_bodies(v: Views):
    return v.patches().select(*ID, P.omit_bodies(F.col("patch")).alias("patch"))


@query("w07_minimal_hunks", """
WITH n AS (SELECT *, row_number() OVER (PARTITION BY number, pos, file_no, hunk_no ORDER BY line_no) - 1 AS "at",
    regexp_extract(first_value(line) OVER (PARTITION BY number, pos, file_no, hunk_no ORDER BY line_no), '-(\\d+)', 1)::BIGINT AS o FROM v_hunks),
  e AS (SELECT number, pos, file_no, hunk_no, min("at") FILTER (type IN ('added', 'deleted')) AS f, max("at") FILTER (type IN ('added', 'deleted')) AS l FROM n GROUP BY ALL),
  k AS (SELECT number, pos, file_no, path, hunk_no, any_value(o + f - 1) AS pre_start, count(*) FILTER (type <> 'added') AS pre_length, count(*) FILTER (type <> 'deleted') AS post_length,
    string_agg(line, chr(10) ORDER BY "at") AS body FROM n JOIN e USING (number, pos, file_no, hunk_no) WHERE "at" BETWEEN f AND l GROUP BY number, pos, file_no, path, hunk_no)
SELECT number, pos, file_no::BIGINT AS file_no, path, hunk_no::BIGINT AS hunk_no, pre_start::BIGINT AS pre_start, pre_length::BIGINT AS pre_length, post_length::BIGINT AS post_length, body,
  (pre_start + coalesce(sum(post_length - pre_length) OVER (PARTITION BY number, pos, file_no ORDER BY hunk_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS post_start FROM k""")
def minimal_hunks(v: Views):
    return _long(diffs.minimal_hunks(v.patches(), ID), "file_no", "hunk_no", "pre_start", "pre_length", "post_length", "post_start")


@query("w11_summarise_large", """
WITH t AS (SELECT number, pos, file_no, path, 'diff --git a/' || path || ' b/' || path || chr(10) || '--- a/' || path || chr(10) || '+++ b/' || path
    || chr(10) || string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT line LIKE ' %') AS text,
    'diff --git a/' || path || ' b/' || path || chr(10) || '--- a/' || path || chr(10) || '+++ b/' || path || chr(10) || string_agg(line, chr(10) ORDER BY line_no) AS whole
  FROM v_lines GROUP BY number, pos, file_no, path),
  s AS (SELECT number, pos, file_no, CASE WHEN length(whole) <= 100 OR length(patch) <= 120 THEN whole ELSE text END AS text FROM t JOIN v_patches USING (number, pos))
SELECT number, pos, file_no::BIGINT AS file_no, text, (length(text) + 1)::BIGINT AS size FROM s
QUALIFY coalesce(sum(length(text) + 1) OVER (PARTITION BY number, pos ORDER BY file_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) <= 120""")
def summarise_large(v: Views):
    df = diffs.summarise_large(v.patches(), ID, budget=120, whole_below=100)
    return _long(df, "file_no").drop("path")


@query("x35_case_selector", """
SELECT number, pos, string_agg('t' || file_no, ' or ' ORDER BY file_no) AS selector FROM v_files GROUP BY number, pos""")
def case_selector(v: Views):
    df = v.patch_files().selectExpr("number", "pos", "array_join(transform(heads, h -> concat('+[case t', h.file_no, ']\\n+x')), '\\n') AS test_patch")
    return df.select(*ID, P.case_selector(F.col("test_patch")).alias("selector"))
