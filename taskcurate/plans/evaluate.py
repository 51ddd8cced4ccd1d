"""Test logs before and after a change -> lists, scores and a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import logs as L
from ..operators import reports, testlogs

LISTS = ("FAIL_TO_PASS", "PASS_TO_PASS")
SCORES = ("total_tests", "total_passed", "f2p_total", "f2p_passed", "p2p_total", "p2p_passed")


def outcomes(logs: DataFrame) -> DataFrame:
    """``logs`` is (instance, phase, pos, log); the last log of a phase decides per test."""
    rows = logs.select("instance", "phase", "pos", F.posexplode(L.full_results(F.col("log"))).alias("_at", "_r"))
    runs = rows.select("instance", "phase", F.struct("pos", "_at").alias("pos"), F.col("_r.test_id").alias("test_id"), F.col("_r.status").alias("status"))
    return testlogs.pre_post(runs)


def list_scores(results: DataFrame, lists: DataFrame) -> DataFrame:
    """Scores of each instance that has results or lists.

    ``results`` is (instance_id, test_id, status), ``lists`` the long form of
    the dataset's lists (instance_id, list, test_id).  An instance without
    lists is scored by the names of its tests.
    """
    return testlogs.score_against_lists(results, lists.filter(F.col("list").isin(*LISTS)), "instance_id")


def fully_resolved(scores: DataFrame) -> DataFrame:
    """Reward 1.0 if all tests of both lists passed and there are any, else 0.0."""
    all_passed = (F.col("f2p_passed") == F.col("f2p_total")) & (F.col("p2p_passed") == F.col("p2p_total")) & (F.col("f2p_total") + F.col("p2p_total") > 0)
    return scores.select("instance_id", F.when(all_passed, 1.0).otherwise(0.0).alias("reward"))


def buckets(dataset: DataFrame, lists: DataFrame, predictions: DataFrame, runs: DataFrame, stats: DataFrame) -> DataFrame:
    """Predicted instances of the dataset with bucket, scores, cost and steps.

    ``runs`` has a row per evaluated instance: instance_id, patch_applied,
    exit_code, log, and in ``reported`` the scores of its report, null or
    without tests where they must come from the log.  Resolved means that the
    patch applied and the tests ended with exit code 0.
    """
    found = runs.select(
        "instance_id", "reported", F.coalesce(F.col("patch_applied") & (F.col("exit_code") == 0), F.lit(False)).alias("resolved"), L.last_results(L.full_results(F.col("log"))).alias("_results")
    )
    asked = lists.filter(F.col("list").isin(*LISTS)).groupBy("instance_id").agg(F.collect_list(F.struct("test_id", "list")).alias("_lists"))
    none = F.array().cast("array<struct<test_id:string,list:string>>")
    # a log is read once; its results and the lists of its instance, a cell each, stay in one task
    rows = found.join(asked, "instance_id", "left").select(
        "instance_id", "reported", "resolved", F.inline_outer(testlogs.score_rows(F.col("_results"), F.coalesce("_lists", none)))
    )
    parsed = testlogs.scores_of(rows, ["instance_id", "reported", "resolved"])
    trusted = F.coalesce(F.col("reported.total_tests") > 0, F.lit(False))
    scored = parsed.select("instance_id", "resolved", *[F.when(trusted, F.col(f"reported.{c}")).otherwise(F.coalesce(c, F.lit(0).cast("long"))).alias(c) for c in SCORES])
    return reports.run_buckets(dataset, predictions, scored).join(stats, "instance_id", "left")


def report(dataset: DataFrame, lists: DataFrame, predictions: DataFrame, runs: DataFrame, stats: DataFrame) -> DataFrame:
    """The summary row of :func:`buckets`."""
    return reports.run_report(buckets(dataset, lists, predictions, runs, stats))
