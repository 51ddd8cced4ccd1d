"""Task instances put together from case folders.

A case folder holds mixed files: ``status.json`` (outcome class), ``meta.json``
(the task), ``eval.sh`` (script that writes the test files), ``Dockerfile``, and
one folder per test run, ``test_analysis_agent_<n>``, with the console output
before and after the change.  One scan reads them all; the path of a file says
what it is and to which case and run it belongs.  Logs become result lists
before the only shuffle, in which each folder is grouped once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import logs, patches, texts

# File names, the run folder and the class of cases that become instances.
STATUS, META, SCRIPT, IMAGE = "status.json", "meta.json", "eval.sh", "Dockerfile"
PRE_LOG, POST_LOG = "test_output_prev_apply.txt", "test_output.txt"
_RUN = r"^test_analysis_agent_(\d+)$"
WANTED_CLASS = "FAIL2PASS"

TASK_INFO = (
    "repo string, pull_number bigint, pull_url string, instance_id string, commit_sha string, issue_numbers array<string>, base_commit string, "
    "patch string, problem_statement string, hints_text string, created_at string, version string"
)


def read_case_files(spark: SparkSession, root: str) -> DataFrame:
    """(setup, case, run, kind, text) of the known files below ``root``; ``run`` is null for files of the case itself.

    Other files are not opened.  A known name in a place where it does not belong is left out.
    """
    names = ",".join((STATUS, META, SCRIPT, IMAGE, PRE_LOG, POST_LOG))
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"{{{names}}}").text(root, wholetext=True)
    return known_files(raw.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))


def read_packed_cases(spark: SparkSession, path: str) -> DataFrame:
    """The same of case folders that are packed in a table (path, text): millions of small files need a block and a listing entry each."""
    return known_files(spark.read.schema("path string, text string").parquet(path))


def known_files(files: DataFrame) -> DataFrame:
    """(setup, case, run, kind, text) of files (path, text); paths are encoded as in URLs."""
    at = F.split(F.col("path"), "/")
    part = lambda i: F.url_decode(F.element_at(at, i))
    run = F.nullif(F.regexp_extract(part(-2), _RUN, 1), F.lit("")).cast("long")
    folder = F.when(run.isNull(), F.slice(at, 1, F.size(at) - 1)).otherwise(F.slice(at, 1, F.size(at) - 2))
    found = files.where(part(-1).isin(STATUS, META, SCRIPT, IMAGE, PRE_LOG, POST_LOG)).select(part(-1).alias("kind"), run.alias("run"), folder.alias("_folder"), "text")
    is_log = F.col("kind").isin(PRE_LOG, POST_LOG)
    return found.where(is_log == F.col("run").isNotNull()).select(
        F.url_decode(F.array_join(F.slice("_folder", 1, F.size("_folder") - 1), "/")).alias("setup"), F.url_decode(F.element_at("_folder", -1)).alias("case"), "run", "kind", "text"
    )


def case_rows(files: DataFrame) -> DataFrame:
    """One row per case folder: status and task (null if missing), script, image and the results of the latest run.

    The latest run is that of the highest number.  A log that it lacks is null, even if an earlier run has it.
    """
    parsed = files.select(
        "setup", "case", "run", "kind",
        F.when(F.col("kind").isin(STATUS, META, SCRIPT, IMAGE), F.col("text")).alias("text"),
        F.when(F.col("run").isNotNull(), logs.last_results(logs.results_with_summary(F.col("text")))).alias("results"),
    )

    def whole(kind: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col("text")))

    def latest(kind: str) -> Column:
        here = F.col("kind") == kind
        return F.max_by(F.when(here, F.struct("run", "results")), F.when(here, F.col("run")))

    grouped = parsed.groupBy("setup", "case").agg(
        F.get_json_object(whole(STATUS), "$.f2p_classification").alias("outcome"), F.from_json(whole(META), f"task_info struct<{_as_fields(TASK_INFO)}>")["task_info"].alias("task"),
        whole(SCRIPT).alias("script"), whole(IMAGE).alias("image"), F.max("run").alias("run"), latest(PRE_LOG).alias("_pre"), latest(POST_LOG).alias("_post"),
    )
    of_run = lambda c: F.when(F.col(f"{c}.run") == F.col("run"), F.col(f"{c}.results"))
    return grouped.select("setup", "case", "outcome", "task", "script", "image", "run", of_run("_pre").alias("pre"), of_run("_post").alias("post"))


def _as_fields(ddl: str) -> str:
    return ", ".join(":".join(f.strip().split(" ", 1)) for f in ddl.split(", "))


def case_instances(cases: DataFrame, wanted: str = WANTED_CLASS) -> DataFrame:
    """Instance rows of the cases with class ``wanted``, a task and a run; test lists are JSON text.

    Without both logs the lists are empty: the exit codes alone decided the class.
    """
    kept = cases.where((F.col("outcome") == wanted) & F.col("task").isNotNull() & F.col("run").isNotNull())
    both = logs.matched_results(F.col("pre"), F.col("post"))
    given = lambda c: F.coalesce(F.col(f"task.{c}"), F.lit(""))
    none = F.array().cast("array<string>")
    listed = lambda before: F.to_json(F.coalesce(logs.matched_ids(F.col("_both"), before, "PASSED"), none))
    rows = kept.withColumn("_both", F.explode(F.array(both)))  # held, so both lists share it
    return rows.select(
        "setup", "case", given("repo").alias("repo"), F.col("task.pull_number").alias("pull_number"), given("pull_url").alias("pull_url"), given("instance_id").alias("instance_id"),
        given("commit_sha").alias("commit_sha"), F.coalesce("task.issue_numbers", none).alias("issue_numbers"), given("base_commit").alias("base_commit"), given("patch").alias("patch"),
        F.coalesce(patches.creation_patch(texts.heredoc_files(F.col("script"))), F.lit("")).alias("test_patch"), given("problem_statement").alias("problem_statement"),
        given("hints_text").alias("hints_text"), given("created_at").alias("created_at"), given("version").alias("version"),
        listed("FAILED").alias("FAIL_TO_PASS"), listed("PASSED").alias("PASS_TO_PASS"), given("base_commit").alias("environment_setup_commit"),
        F.coalesce("image", F.lit("")).alias("dockerfile"), F.coalesce("script", F.lit("")).alias("eval_script"),
    )


def first_cases(instances: DataFrame) -> DataFrame:
    """One row per (setup, instance_id): the case whose name comes first. Only keys are grouped; rows join back by case."""
    first = instances.groupBy("setup", "instance_id").agg(F.min("case").alias("case"))
    return instances.join(first.select("setup", "case"), ["setup", "case"], "left_semi")


def read_case_instances(spark: SparkSession, root: str) -> DataFrame:
    """Distinct instances of all case folders below ``root``."""
    return first_cases(case_instances(case_rows(read_case_files(spark, root))))
