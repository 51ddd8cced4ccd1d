"""Case folders on disk against a plain reading of them."""

import json

from pyspark.sql import functions as F

from taskcurate.functions import logs, patches
from taskcurate.sources import cases


def put(folder, **files):
    for name, text in files.items():
        path = folder / name.replace("__", "/").replace("_dot_", ".")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode())


def case(folder, outcome="FAIL2PASS", **more):
    put(folder, status_dot_json=json.dumps({"f2p_classification": outcome}), meta_dot_json=json.dumps({"task_info": {"instance_id": "i-1", "repo": "a/b", "issue_numbers": ["4"]}}), **more)


LOG = "tests/a.py::t1 {a} [ 1%]\ntests/a.py::t2 PASSED\ntests/a.py::t3 PASSED\nFAILED tests/a.py::t3 - later\nnot::this  XPASS\n"


def run(folder, n, pre, post):
    put(folder / f"test_analysis_agent_{n}", **{k: v for k, v in (("test_output_prev_apply_dot_txt", pre), ("test_output_dot_txt", post)) if v is not None})


def test_instances_of_folders(spark, tmp_path):
    root = tmp_path / "set up" / "applicable_setup"
    case(root / "c 1", eval_dot_sh="cat <<'EOF_TEST_0' > \"b.py\"\nx\nEOF_TEST_0\ncat <<'EOF_TEST_1' > \"a.py\"\ny\n\nEOF_TEST_1\n", Dockerfile="FROM z")
    run(root / "c 1", 9, LOG.format(a="PASSED"), LOG.format(a="PASSED"))
    run(root / "c 1", 10, LOG.format(a="FAILED"), LOG.format(a="PASSED"))
    case(root / "c2")
    run(root / "c2", 0, LOG.format(a="FAILED"), None)  # one log only: no lists
    case(root / "c3", outcome="PASS2PASS")
    run(root / "c3", 0, "", "")
    case(root / "c4")  # no run
    put(root / "c5", status_dot_json='{"f2p_classification": "FAIL2PASS"}')  # no task
    run(root / "c5", 0, "", "")
    case(root / "c6")
    run(root / "c6", 1, LOG.format(a="FAILED"), LOG.format(a="PASSED"))
    run(root / "c6", 2, None, "tests/a.py::t9 PASSED\n")  # the latest run lacks a log that an earlier one has
    put(root / "c6" / "test_analysis_agent_2", status_dot_json='{"f2p_classification": "no"}')
    rows = {r.case: r for r in cases.case_instances(cases.case_rows(cases.read_case_files(spark, str(root)))).collect()}
    assert set(rows) == {"c 1", "c2", "c6"}
    assert json.loads(rows["c 1"].FAIL_TO_PASS) == ["tests/a.py::t1"] and json.loads(rows["c 1"].PASS_TO_PASS) == ["tests/a.py::t2"]
    assert rows["c 1"].test_patch == (
        "diff --git a/a.py b/a.py\nnew file mode 100644\n--- /dev/null\n+++ b/a.py\n@@ -0,0 +1,1 @@\n+y\n\ndiff --git a/b.py b/b.py\nnew file mode 100644\n--- /dev/null\n+++ b/b.py\n@@ -0,0 +1,1 @@\n+x\n"
    )
    assert (rows["c 1"].dockerfile, rows["c 1"].repo, rows["c 1"].issue_numbers, rows["c2"].dockerfile, rows["c2"].test_patch) == ("FROM z", "a/b", ["4"], "", "")
    assert all(rows[c].FAIL_TO_PASS == "[]" == rows[c].PASS_TO_PASS for c in ("c2", "c6"))
    assert [r.case for r in cases.read_case_instances(spark, str(root)).collect()] == ["c 1"]


def test_one_shuffle(spark, tmp_path):
    case(tmp_path / "c")
    run(tmp_path / "c", 0, "", "")
    df = cases.case_instances(cases.case_rows(cases.read_case_files(spark, str(tmp_path))))
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_creation_patch_counts_every_kind_of_line_end(spark):
    texts = ["", "a", "a\n", "a\nb", "a\r\nb\r\n", "a\x0cb c\r", "\n\n"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.p for r in rows.select("i", patches.creation_patch(F.array(F.struct(F.lit("f").alias("path"), F.col("t").alias("content")))).alias("p")).collect()}
    for i, t in enumerate(texts):
        ls = t.splitlines(keepends=True)
        if ls and not ls[-1].endswith("\n"):
            ls[-1] += "\n"
        assert got[i] == f"diff --git a/f b/f\nnew file mode 100644\n--- /dev/null\n+++ b/f\n@@ -0,0 +1,{len(ls)} @@\n" + "".join(f"+{x}" for x in ls), t


def test_matched_results(spark):
    df = spark.createDataFrame([("a::x PASSED\na::x FAILED\nb::y PASSED\n", "b::y FAILED\na::x PASSED\nc::z PASSED")], "pre string, post string")
    last = lambda c: logs.last_results(logs.results_with_summary(F.col(c)))
    row = df.select(logs.matched_results(last("pre"), last("post")).alias("m")).first()
    assert [tuple(x) for x in row.m] == [("a::x", "FAILED", "PASSED"), ("b::y", "PASSED", "FAILED")]


def test_packed_folders_read_like_files(spark, tmp_path):
    case(tmp_path / "s" / "c 1")
    run(tmp_path / "s" / "c 1", 3, LOG.format(a="FAILED"), LOG.format(a="PASSED"))
    put(tmp_path / "s" / "c 1", notes_dot_txt="not read", run__meta_dot_json="{}")
    names = ["path", "text"]
    rows = [(f.as_uri().replace("file:///", "file:/"), f.read_text()) for f in (tmp_path / "s").rglob("*") if f.is_file()]
    spark.createDataFrame(rows, names).write.parquet(str(tmp_path / "packed"))
    packed, files = cases.read_packed_cases(spark, str(tmp_path / "packed")), cases.read_case_files(spark, str(tmp_path / "s"))
    assert sorted(map(tuple, packed.collect()), key=str) == sorted(map(tuple, files.collect()), key=str)
    assert [r.case for r in cases.case_instances(cases.case_rows(packed)).collect()] == ["c 1"]
