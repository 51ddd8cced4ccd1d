"""Pull requests -> judged task instances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patches as P
from ..functions import paths, titles
from ..operators import instances, issues, votes


def candidate_rows(pulls: DataFrame, commits: DataFrame, patches: DataFrame, seen: DataFrame | None = None, cutoff: Column | None = None) -> DataFrame:
    """Commits of valid pull requests with their patch: what all instance tables are made of.

    A pull request is valid if it is merged and linked to an issue in its
    title, body or commit messages (or by a bare ``#N`` in the title), or
    titled like a code change.  Cheap filters and the anti-join with what was
    done before come first; text is only carried for rows that survive them.
    """
    todo = pulls if seen is None else instances.not_seen(pulls, seen, ["number"])
    todo = todo if cutoff is None else instances.before_cutoff(todo, cutoff)
    good = instances.valid_pulls(with_issue_counts(todo, commits), F.col("n_issues")).select("number", "repo", "created_at", "title", "body", "n_issues")
    p = F.col("patch")
    kept = patches.filter(~P.is_trivial(p) & ~P.is_readme_only(p))
    plain = instances.without_merges(commits).select("number", "pos", "sha")
    return plain.join(good, "number").join(kept, ["number", "pos"])


def with_issue_counts(pulls: DataFrame, commits: DataFrame) -> DataFrame:
    """Merged pull requests with ``n_issues``."""
    merged = pulls.filter(F.col("merged_at").isNotNull())
    links = issues.linked_issues(merged, commits).groupBy("number").agg(F.count(F.lit(1)).alias("n_issues"))
    return merged.join(links, "number", "left").withColumn("n_issues", F.coalesce("n_issues", F.lit(0).cast("long")))


def instance_table(pulls: DataFrame, commits: DataFrame, patches: DataFrame, cutoff: Column | None = None) -> DataFrame:
    """Task instances with the size of their change."""
    rows, p = candidate_rows(pulls, commits, patches, cutoff=cutoff), F.col("patch")
    return rows.select(
        paths.instance_id(F.col("repo"), F.col("number"), F.col("sha")).alias("instance_id"), "repo", F.col("number").alias("pull_number"), "sha", "created_at", "n_issues",
        P.n_added(p).alias("lines_added"), P.n_removed(p).alias("lines_removed"), F.size(P.files(p)).alias("files_changed"), P.has_real_tests(P.test_part(p)).alias("has_tests"),
    )


def task_instances(pulls: DataFrame, commits: DataFrame, patches: DataFrame, seen: DataFrame | None = None, cutoff: Column | None = None) -> DataFrame:
    """Task instances with code and test patch and their linked issues counted."""
    rows, p = candidate_rows(pulls, commits, patches, seen, cutoff), F.col("patch")
    rows = rows.withColumn("_code", F.explode(F.array(P.code_part(p))))  # made once, for candidates only: the filter below is not pushed under their join
    out = rows.select(
        paths.instance_id(F.col("repo"), F.col("number"), F.col("sha")).alias("instance_id"), "repo", "number", "pos", "created_at", "n_issues",
        titles.statement_from_pull(F.col("title"), F.col("body")).alias("problem_statement"),
        F.col("_code").alias("patch"), P.test_part(p).alias("test_patch"),
    )
    return out.filter("patch <> ''")


def judged(instances_: DataFrame, ballots: DataFrame) -> DataFrame:
    """Instances with their verdict; ``ballots`` are votes keyed by ``instance`` = pull number."""
    verdicts = votes.keep_or_reject(ballots)
    return votes.apply_verdicts(instances_.withColumn("instance", F.col("number")), verdicts)
