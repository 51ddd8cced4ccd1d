"""Functions called from SQL against the Column functions and plain values."""

from pyspark.sql import functions as F

from taskcurate.functions import logs, patches, sql
from taskcurate.operators import instances

LOGS = ["a::x PASSED\nb::y[1] SKIPPED [3%]\nRUN_EXIT_CODE=7\n", "", None, "no result\nx::y FAILED", "MY_EXIT_CODE=0"]
PATCHES = ["diff --git a/x.py b/x.py\n--- a/x.py\n@@ -1 +1 @@\n-a\ndiff --git a/y b/y\n+b", "text before\ndiff --git a/z b/z", "", None]


def test_scalar_functions(spark):
    sql.register(spark)
    df = spark.createDataFrame([(t,) for t in LOGS], "log string").select(F.expr("task_exit_code(log)").alias("a"), logs.exit_code(F.col("log")).alias("b"))
    assert [r.a for r in df.collect()] == [r.b for r in df.collect()] == [7, None, None, None, 0]
    pairs = [(None, 0), (0, 0), (1, 0), (1, 2), (0, 3)]
    rows = spark.createDataFrame(pairs, "pre long, post long").selectExpr("task_transition(pre, post) AS t").collect()
    assert [r.t for r in rows] == ["ERROR", "PASS2PASS", "FAIL2PASS", "FAIL2FAIL", "PASS2FAIL"]


def test_one_row_to_many(spark):
    sql.register(spark)
    spark.createDataFrame(list(enumerate(LOGS)), "i int, log string").createOrReplaceTempView("t_logs")
    got = spark.sql("SELECT i, r.* FROM t_logs, LATERAL task_log_results(log) r").collect()
    want = spark.table("t_logs").select("i", F.posexplode(logs.full_results(F.col("log"))).alias("place", "r")).select("i", "place", "r.*").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 3
    spark.createDataFrame(list(enumerate(PATCHES)), "i int, patch string").createOrReplaceTempView("t_patches")
    got = spark.sql("SELECT i, f.path, f.file_patch FROM t_patches, LATERAL task_patch_files(patch) f").collect()
    want = spark.table("t_patches").select("i", F.explode(patches.files(F.col("patch"))).alias("s")).select("i", patches.file_path(F.col("s")), "s").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 3


def test_groups_are_those_of_decompose(spark):
    sql.register(spark)
    files = spark.createDataFrame([(n, i + 1, f"f{i}") for n in (1, 6, 7, 9) for i in range(n)], "n int, file_pos long, path string")
    files.groupBy("n").agg(F.transform(F.array_sort(F.collect_list(F.struct("file_pos", "path"))), lambda x: x["path"]).alias("files")).createOrReplaceTempView("t_files")
    got = spark.sql("SELECT n, g.group_no, explode(g.files) AS path FROM t_files, LATERAL task_groups(files, 6, 4) g").collect()
    want = instances.decompose(files, "n").select("n", "group_no", "path").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want)))


def test_predicates_of_the_user(spark):
    sql.register_predicate(spark, "t_keep", "a INT", "a > 1")
    assert [r.a for r in spark.createDataFrame([(1,), (2,), (None,)], "a int").filter("t_keep(a)").collect()] == [2]
