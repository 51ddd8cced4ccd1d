"""Decisions that are easy to get wrong, on small literals."""

import pytest
from pyspark.sql import functions as F

from taskcurate.functions import actions as A
from taskcurate.functions import logs as L
from taskcurate.functions import patches as P
from taskcurate.functions import paths, texts, titles
from taskcurate.operators import diffs, entities, instances, issues, merging, reports, rules, testlogs, votes


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


PATCH = (
    "noise\ndiff --git a/src/a.py b/src/a.py\nindex 12..34 100644\n--- a/src/a.py\n+++ b/src/a.py\n@@ -3 +3,2 @@ def f\n ctx\n--- gone\n+new\n"
    "@@ -9,2 +10,2 @@\n-x\n+y\n\\ No newline at end of file\ndiff --git a/tests/test_a.py b/tests/test_a.py\n--- a/tests/test_a.py\n+++ b/tests/test_a.py\n@@ -1 +1 @@\n+t"
)


def test_removed_line_that_starts_with_dashes_is_not_counted(spark):
    assert one(spark, P.n_removed(F.lit(PATCH))) == 1
    assert one(spark, P.n_added(F.lit(PATCH))) == 3


def test_triviality(spark):
    assert one(spark, P.is_trivial(F.lit("")))
    assert one(spark, P.is_trivial(F.lit(None).cast("string")))
    assert not one(spark, P.is_trivial(F.lit("+a\n-b\n+c")))
    assert not one(spark, P.has_real_tests(F.lit("+a\n+b\n+c\n+d")))


def test_text_before_the_first_header_is_dropped_and_index_lines_go(spark):
    assert one(spark, P.file_paths(F.lit(PATCH))) == ["src/a.py", "tests/test_a.py"]
    code = one(spark, P.code_part(F.lit(PATCH)))
    assert "index" not in code and code.endswith("end of file\n") and "tests" not in code
    assert one(spark, P.test_part(F.lit(PATCH))).count("\n") == 5


def test_hunk_header_without_length(spark):
    h = one(spark, P.hunk_header(F.lit("@@ -3 +3,2 @@ def f")))
    assert (h.old_start, h.old_length, h.new_start, h.new_length, h.section) == (3, None, 3, 2, "def f")


def test_rename_is_rejected(spark):
    assert one(spark, P.file_header(F.lit("diff --git a/x b/y"))) is None
    assert one(spark, P.file_header(F.lit("diff --git a/x b/x"))) == "x"


def test_round_trip(spark):
    body = PATCH.split("\n", 1)[1]
    assert one(spark, P.render(F.lit(body))) == body


def test_round_trip_of_odd_lines(spark):
    head = "diff --git a/x b/x\n--- a/x\n+++ b/x\n"
    odd = "junk\n" + head + "who\n@@ -007,03 +00 @@   f @@\n\\No end\n\n-a\nlost\n@@ bad\n+b\n@@ -1 +1 @@ \n"
    assert one(spark, P.render(F.lit(odd))) == head + "@@ -7,3 +0 @@ f @@\n\\ o end\n \n-a\n+b\n@@ -1 +1 @@\n "
    assert one(spark, P.render(F.lit("no patch"))) == ""


def test_line_numbers(spark):
    df = spark.createDataFrame([(1, PATCH)], "id int, patch string")
    rows = diffs.line_numbers(diffs.diff_lines(df, ["id"]), ["id"]).orderBy("file_no", "hunk_no", "at").collect()
    assert [(r.type, r.old_line, r.new_line) for r in rows] == [
        ("context", 3, 3), ("deleted", 4, None), ("added", None, 4), ("deleted", 9, None), ("added", None, 10), ("note", None, None), ("added", None, 1),
    ]


def test_three_test_file_predicates_differ(spark):
    cases = {"a/testing/x.py": (True, False, False), "test_x/y.py": (True, True, True), "a/test_x.py": (True, False, True), "a/Test/x.py": (True, False, True), "contest.py": (False, False, False)}
    for p, want in cases.items():
        got = tuple(one(spark, f(F.lit(p))) for f in (paths.is_test_by_words, paths.is_test_header, paths.is_test_file))
        assert got == want, p


def test_normalise_strips_characters_not_a_prefix(spark):
    assert one(spark, paths.normalise(F.lit("../.hidden/a.py"))) == "hidden/a.py"


def test_binary_suffix(spark):
    assert one(spark, paths.is_binary(F.lit("a/b.PNG"))) and not one(spark, paths.is_binary(F.lit("png")))


def test_title_needs_a_word_boundary(spark):
    assert one(spark, titles.is_code_change(F.lit("Fixes crash"))) and one(spark, titles.is_code_change(F.lit("[bug] x")))
    assert not one(spark, titles.is_code_change(F.lit("Prefix rename"))) and not one(spark, titles.is_code_change(F.lit("added x")))


def test_keyword_after_accented_letter_is_another_word(spark):
    assert one(spark, titles.resolved_issues(F.lit("éfix #3, closes #4 <!-- fixes #5 -->"))) == ["4"]


def test_bare_title_reference_only_without_keyword(spark):
    pulls = spark.createDataFrame([(1, "crash #9", ""), (2, "see #9", "fixes #4")], "number int, title string, body string")
    none = spark.createDataFrame([], "number int, message string")
    got = {(r.number, r.issue) for r in issues.linked_issues(pulls, none).collect()}
    assert got == {(1, "9"), (2, "4")}


def test_gate_stops_at_the_first_late_comment(spark):
    comments = spark.sql("SELECT * FROM VALUES (1, 1, 1, TIMESTAMP '2024-01-01'), (1, 2, 2, TIMESTAMP '2024-01-09'), (1, 3, 3, TIMESTAMP '2024-01-02') AS t(issue, ord, comment_id, updated_at)")
    commits = spark.sql("SELECT 1 AS number, 1 AS pos, TIMESTAMP '2024-01-05' AS authored_at")
    assert [r.ord for r in issues.gated_comments(comments, commits).collect()] == [1]
    assert sorted(r.ord for r in issues.gated_comments(comments, commits, prefix=False).collect()) == [1, 3]


def test_statement_drops_solution_and_template(spark):
    body = "Broken.\n\n## Solution\nsecret\n\n## Checklist\n- [x] a\n\n\n\n## More\ntext <!-- hidden -->"
    got = one(spark, titles.statement_from_pull(F.lit("T"), F.lit(body)))
    assert "secret" not in got and "- [x]" not in got and "hidden" not in got and got.startswith("T\n\nBroken.") and "\n\n\n" not in got


def test_exit_codes(spark):
    assert one(spark, L.exit_code(F.lit("x\nRUN_EXIT_CODE=12\n"))) == 12 and one(spark, L.exit_code(F.lit("none"))) is None
    assert one(spark, L.classify_exit_codes(F.lit(None).cast("int"), F.lit(0))) == "ERROR"
    assert one(spark, L.classify_exit_codes(F.lit(1), F.lit(0))) == "FAIL2PASS"


def test_verbose_log_last_status_wins(spark):
    logs = spark.createDataFrame([(1, "a::t PASSED [1%]\na::t FAILED [2%]\nx")], "i int, log string")
    assert testlogs.results_table(logs, ["i"], L.verbose_results).collect()[0].status == "FAILED"


def test_short_summary_between_markers(spark):
    log = "f::early FAILED\nshort test summary info\nFAILED a.py::C::t[1] - boom\nshort test summary info\nPASSED b::z"
    assert [tuple(r) for r in one(spark, L.short_summary_results(F.lit(log)))] == [("C.t[1]", "FAILED")]
    assert one(spark, L.short_summary_results(F.lit("nothing"))) == []


def test_exact_reward_needs_same_size(spark):
    got = spark.createDataFrame([(1, "a - x", "PASSED"), (1, "b", "PASSED"), (2, "a", "PASSED")], "instance int, test_id string, status string")
    want = spark.createDataFrame([(1, "a", "PASSED"), (1, "b", "PASSED"), (2, "a", "PASSED"), (2, "c", "PASSED")], "instance int, test_id string, status string")
    assert {r.instance: r.reward for r in testlogs.exact_reward(got, want).collect()} == {1: 1.0, 2: 0.0}


def test_expected_passed_reward_takes_the_first_name_that_contains_it(spark):
    seen = spark.createDataFrame([(1, "x.test_a[1]", "PASSED", 0), (1, "x.test_a[2]", "FAILED", 1), (2, "x.test_a[1]", "FAILED", 0), (2, "x.test_a[2]", "PASSED", 1)], "instance int, test_id string, status string, at int")
    want = spark.createDataFrame([(1, "test_a"), (2, "test_a"), (3, "test_a")], "instance int, test_id string")
    assert {r.instance: r.reward for r in testlogs.expected_passed_reward(seen, want).collect()} == {1: 1.0, 2: 0.0, 3: 0.0}


def test_vote_ties(spark):
    v = spark.createDataFrame([(1, 1, "REJECT", "r", "c"), (1, 2, None, "k", "d"), (2, 1, "other", "o", "e")], "instance int, vote_idx int, verdict string, reason string, category string")
    got = {r.instance: (r.verdict, r.reason) for r in votes.keep_or_reject(v).collect()}
    assert got == {1: ("KEEP", "k"), 2: ("REJECT", "o")}
    q = spark.createDataFrame([(1, 1, "overall", "FAIL", "r", "s1"), (1, 2, "overall", "UNKNOWN", "r", "s2")], "instance int, vote_idx int, dim string, verdict string, reason string, summary string")
    assert votes.quality_verdict(q, ["clarity"]).first().overall == "PASS"
    strict = votes.quality_verdict(q, ["clarity"], strict_pass=True).first()
    assert (strict.overall, strict.summary) == ("FAIL", "s1")


def test_unparsable_answer_gets_the_default(spark):
    assert one(spark, votes.parsed_answer(F.lit("{broken"), "overall string", "overall", "PASS"))["overall"] == "PASS"
    assert one(spark, votes.parsed_answer(F.lit('x {"overall": "FAIL"} y'), "overall string", "overall", "PASS"))["overall"] == "FAIL"


def test_action_markup(spark):
    text = "<function=finish>\n<parameter=a>1</parameter><parameter=b> x y </parameter><parameter=a>it's</parameter></function>"
    name, params = A.function_name(F.lit(text)), A.parameters(F.lit(text))
    assert one(spark, params) == {"a": "it's", "b": "x y"}
    assert one(spark, A.to_shell(name, params)) == "echo '<<<Finished>>>'"
    assert one(spark, A.to_shell(F.lit("go"), params)) == """go --a 'it'"'"'s' --b 'x y'"""


def test_latest_run_numeric_and_lexical(spark):
    runs = spark.createDataFrame([(1, "r_9"), (1, "r_10")], "k int, run string")
    assert merging.latest_run(runs, "k", "run").first().latest == "r_10"
    assert merging.latest_run(runs, "k", "run", lexical=True).first().latest == "r_9"


def test_non_numeric_numbers_sort_as_text(spark):
    df = spark.createDataFrame([("9",), ("10",), ("x",), ("a",)], "pull_number string")
    assert [r[0] for r in merging.by_number_descending(df).collect()] == ["10", "9", "x", "a"]


def test_test_matching_by_directory(spark):
    tests = spark.createDataFrame([(1, "pkg/tests/test_z.py"), (1, "other/test_q.py"), (1, "t/b_test.py")], "n int, path string")
    code = spark.createDataFrame([(1, "pkg/a.py"), (1, "lib/b.py")], "n int, path string")
    assert {r.test_path for r in instances.match_tests(tests, code, ["n"]).collect()} == {"pkg/tests/test_z.py", "t/b_test.py"}


def test_heredocs(spark):
    script = "git reset --hard\ncat <<'EOF_TEST_0' > \"a/b.py\"\ngit reset --hard\nEOF_TEST_0\ngit checkout x"
    assert [tuple(r) for r in one(spark, texts.heredoc_files(F.lit(script)))] == [("a/b.py", "git reset --hard")]
    clean = one(spark, texts.sanitised_script(F.lit(script))).split("\n")
    assert clean[0].startswith("# [sanitized]") and clean[2] == "git reset --hard" and clean[4].startswith("# [sanitized]")


def test_version_rules(spark):
    for repo, text, want in [
        ("django/django", "VERSION = (4, 2, 0, 'final')", "4.2"), ("pallets/flask", "__version__ = '2.3.1.dev'", "2.3"),
        ("tqdm/tqdm", "version_info = 4, 65, 0", "4.65"), ("google/gson", "<version>2.10.1-SNAPSHOT</version>", "2.10"), ("django/django", "x", None),
    ]:
        assert one(spark, rules.version_in_text(F.lit(repo), F.lit(text))) == want


def test_suite_rules_first_fit(spark):
    assert one(spark, rules.test_suite_command(F.lit("a/fine-grained-cache-x.test"))).endswith("FineGrainedCacheSuite::fine-grained-cache-x.test")
    assert one(spark, rules.test_suite_command(F.lit("a/none.test"))) is None



def test_report_of_nothing(spark):
    assert reports.build_summary(spark.createDataFrame([], "status string")).first().success_rate == 0.0


def test_entity_spans_nested_and_async(spark):
    src = "@dec\nasync def a():\n    def inner():\n        pass\n    return 1\n\n\nclass B(\n    object,\n):\n    x = 1\n\n    def m(self):\n        pass\nif 1:\n    y = 2\nelse:\n    y = 3\n"
    df = spark.createDataFrame([(1, src)], "f int, source string")
    got = {(r.kind, r.name): (r.start_line, r.end_line) for r in entities.entity_spans(entities.source_lines(df, ["f"]), ["f"]).collect()}
    assert got == {("function", "a"): (2, 5), ("class", "B"): (8, 14), ("method", "B.m"): (13, 14), ("statement", ""): (15, 18)}


@pytest.mark.parametrize("text,want", [("Yes", True), ("0", False), ("maybe", None)])
def test_bool_words(spark, text, want):
    assert one(spark, texts.to_bool(F.lit(text))) is want


def test_entities_before_and_after(spark):
    from taskcurate.operators import entities as E

    old = "def f():\n    return 1\n\n\ndef gone():\n    return 2\n"
    new = "import os\n" * 20 + "def f():\n    return 3\n\n\ndef fresh():\n    return 4\n"
    files = lambda text: spark.createDataFrame([("a.py", text)], "path string, source string")
    spans = E.file_changes(files(old), files(new))
    lines = [("deleted", 2, None), ("added", None, 22), ("deleted", 6, None), ("added", None, 26)]
    edits = spark.createDataFrame([(1, "a.py", *x) for x in lines], "number int, path string, type string, old_line int, new_line int")
    got = {(r.name, r.status) for r in E.touched_entities(edits, spans, ["number"]).collect()}
    assert got == {("f", "modified"), ("gone", "deleted"), ("fresh", "added")}


def test_full_resolution(spark):
    from taskcurate.plans import evaluate

    results = spark.createDataFrame([("a", "t1", "PASSED"), ("a", "t2", "PASSED"), ("b", "t1", "PASSED"), ("b", "t2", "FAILED"), ("c", "x::test_f2p_1", "PASSED"), ("c", "x::test_p2p_1", "FAILED"), ("d", "t", "PASSED")], "instance_id string, test_id string, status string")
    lists = spark.createDataFrame([(i, l, t) for i in "abe" for l, t in (("FAIL_TO_PASS", "t1"), ("PASS_TO_PASS", "t2"))], "instance_id string, list string, test_id string")
    scores = evaluate.list_scores(results, lists)
    got = {r.instance_id: (r.total_tests, r.f2p_passed, r.f2p_total, r.p2p_passed, r.p2p_total) for r in scores.collect()}
    assert got == {"a": (2, 1, 1, 1, 1), "b": (2, 1, 1, 0, 1), "c": (2, 1, 1, 0, 1), "d": (1, 0, 0, 0, 0), "e": (0, 0, 1, 0, 1)}
    assert {r.instance_id for r in evaluate.fully_resolved(scores).collect() if r.reward == 1.0} == {"a"}


def test_dealt_tests(spark):
    """A test goes to each group it matches by stem or directory, else to group 0; small commits take no part."""
    files = [(1, i + 1, p) for i, p in enumerate(["src/a.py", "lib/b.py", "lib/c.py", "a.py", "src/a.py", "x/d.py", "x/e.py"])] + [(2, 1, "src/a.py"), (None, 1, "src/a.py")]
    groups = instances.decompose(spark.createDataFrame(files, "n int, file_pos int, path string"), "n")
    tests = spark.createDataFrame([(1, "t/test_a.py"), (1, "t/test_a.py"), (1, "x/tests/test_q.py"), (1, "test_none.py"), (1, None), (2, "t/test_a.py"), (3, "t/test_a.py")], "n int, path string")
    got = sorted(map(tuple, instances.assign_tests(groups, tests, "n").collect()), key=str)
    assert got == sorted([(1, 0, "t/test_a.py", True), (1, 1, "t/test_a.py", True), (1, 1, "x/tests/test_q.py", True), (1, 0, "test_none.py", False), (1, 0, None, False)], key=str)


def test_sub_instance_cells(spark):
    """A diff stands once in each group of its file, in order of ``at``; unmatched tests come last in group 0."""
    files = [(1, i + 1, p) for i, p in enumerate(["b.py", "a.py", "b.py", None, "b.py", "gone.py", "c.py"])] + [(2, 1, "b.py")]
    groups = instances.decompose(spark.createDataFrame(files, "n int, file_pos int, path string"), "n")
    code = spark.createDataFrame([(n, p, at, f"diff {p}") for n in (1, 2, 3) for p, at in (("a.py", 1), ("b.py", 2), ("c.py", 3), ("other.py", 4))], "n int, path string, at int, diff string")
    tests = spark.createDataFrame([(n, p, p, f"test {p}") for n in (1, 2) for p in ("a_none.py", "test_b.py", "test_c.py")], "n int, path string, at string, diff string")
    got = {(r.n, r.group_no): (r.patch_context, r.patch, r.test_patch) for r in instances.sub_instances(groups, code, tests, "n").collect()}
    assert got == {
        (1, 0): (["b.py", "a.py", "b.py", None], "diff a.py\ndiff b.py\n", "test test_b.py\ntest a_none.py\n"),
        (1, 1): (["b.py", "gone.py", "c.py"], "diff b.py\ndiff c.py\n", "test test_b.py\ntest test_c.py\n"),
        (2, None): (["b.py"], "diff b.py\n", "test a_none.py\ntest test_b.py\ntest test_c.py\n"),
    }


def test_score_against_lists(spark):
    """Lists count tests without a result; names stand in only where a run has no list at all."""
    results = spark.createDataFrame(
        [("a", "t1", "PASSED"), ("a", "t2", None), ("a", "x_test_f2p_9", "PASSED"), ("a", None, "PASSED"), ("c", "x_test_f2p_1", "PASSED"), ("c", "x_test_f2p_test_p2p_2", "FAILED"), ("d", "t", "FAILED")],
        "instance string, test_id string, status string",
    )
    lists = spark.createDataFrame(
        [("a", "FAIL_TO_PASS", "t1"), ("a", "PASS_TO_PASS", "t1"), ("a", "PASS_TO_PASS", "t2"), ("a", "FAIL_TO_PASS", None), ("b", "FAIL_TO_PASS", "t1"), ("d", "OTHER", "t")],
        "instance string, list string, test_id string",
    )
    got = sorted(tuple(r) for r in testlogs.score_against_lists(results, lists).collect())
    assert got == [("a", 4, 3, 2, 1, 2, 1), ("b", 0, 0, 1, 0, 0, 0), ("c", 2, 1, 2, 1, 1, 0), ("d", 1, 0, 0, 0, 0, 0)]


@pytest.mark.parametrize("heads", ["a/README.md b/README.md", "a/x/y b/docs/readme", "a/README b/src/a.py", "a/a.py b/ README", "a/q b/x/ README", "a/README", "a/d/ReadMe.rst b/d/ReadMe.rst  |a/README b/README", "a/README b/README|a/a.py b/a.py", "a/readme/a b/readme/a", "a/README b/READM"])
def test_readme_only(spark, heads):
    patch = "text diff --git a/z b/z\n" + "\n".join(f"diff --git {h}\n--- {h}\n@@ -1 +1 @@\n+/README" for h in heads.split("|"))
    segments = F.filter(F.split(F.lit(patch), "\n(?=diff --git a/)"), lambda s: s.startswith("diff --git a/"))
    want = F.forall(segments, lambda s: paths.is_readme(P.file_path(s)))
    assert one(spark, P.is_readme_only(F.lit(patch))) is one(spark, want)
    assert one(spark, P.is_readme_only(F.lit("no header"))) is False


def test_hunk_headers_against_the_pattern(spark):
    """Numbers are cut from a header that fits the pattern as a whole; others have none."""
    import re

    lines = ["@@ -1,2 +3,4 @@ def f", "@@ -1 +3 @@", "@@ -01,0 +3 @@x, y +9,9 @@", "@@ -1,2 +3,4 @", "@@ -1, +3 @@", "@@ -1,2  +3,4 @@", " @@ -1 +2 @@", "@@ -a,2 +3 @@", "@@ -1 +2,5 @@  a b", "@@ @@", "", "@@ -1,2,3 +4 @@", "@@ -1 -2 @@", None]
    df = spark.createDataFrame([(x,) for x in lines], "l string").select("l", P.hunk_header(F.col("l")).alias("h"))
    for row in df.collect():
        m = row.l is not None and re.match(r"@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@(.*)", row.l)
        want = [*(None if x is None else int(x) for x in m.groups()[:4]), m[5].lstrip(" ")] if m else [None] * 4 + [None if row.l is None else ""]
        assert list(row.h) == want, row.l
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == 1
