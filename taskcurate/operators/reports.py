"""Result tables joined, counted and summarised."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import exact_percentiles, number_blocks, numbered

# Labels a classification may carry.
TYPES = ("feature", "bug_fix", "docs_config", "mixed", "refactor", "performance")
DIFFICULTIES = ("easy", "medium", "hard")

# Columns of the review sheet, in order.
REVIEW_COLUMNS = (
    "instance_id", "repo", "model_name", "resolved", "exit_status", "eval_exit_code", "patch_successfully_applied",
    "api_calls", "instance_cost", "tokens_sent", "tokens_received", "problem_statement", "gold_patch", "model_patch",
    "test_patch", "FAIL_TO_PASS", "PASS_TO_PASS", "base_commit", "pull_number", "created_at", "version", "hints_text",
    "test_output",
)


def valid_label(label: Column, allowed: Sequence[str], default: str) -> Column:
    return F.when(label.isin(*allowed), label).otherwise(F.lit(default))


def difficulty_by_size(changed: Column, easy: int = 30, hard: int = 300) -> Column:
    return F.when(changed < easy, "easy").when(changed <= hard, "medium").otherwise("hard")


def title_of(statement: Column) -> Column:
    return F.substring_index(F.regexp_replace(statement, r"^\s+", ""), "\n", 1)


# -- joins -------------------------------------------------------------------------


def combined(dataset: DataFrame, predictions: DataFrame, info: DataFrame, evals: DataFrame) -> DataFrame:
    """Every dataset row with prediction, run info and evaluation where there are any, ordered by id.

    The model name comes from the first prediction that has one.
    """
    named = predictions.filter(F.coalesce("model_name", F.lit("")) != "")
    model = named.agg(F.min_by("model_name", "instance_id")).scalar()
    out = dataset.join(predictions.drop("model_name"), "instance_id", "left")
    out = out.join(info, "instance_id", "left").join(evals, "instance_id", "left")
    return out.withColumn("model_name", model).orderBy("instance_id")


def combined_counts(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.coalesce("model_patch", F.lit("")) != "").alias("predictions"),
        F.count("resolved").alias("evaluated"),
        F.count_if("resolved").alias("resolved"),
    )


def run_buckets(dataset: DataFrame, predictions: DataFrame, reports: DataFrame) -> DataFrame:
    """Predicted instances of the dataset with their report; no report is an error."""
    out = predictions.join(dataset, "instance_id", "left_semi").join(reports, "instance_id", "left")
    bucket = F.when(F.col("resolved").isNull(), "error").when(F.col("resolved"), "resolved").otherwise("unresolved")
    return out.withColumn("bucket", bucket)


def run_report(buckets: DataFrame) -> DataFrame:
    """One summary row; the id lists are the ``buckets`` table itself.

    Cost and steps count for completed instances that have them.  Pass rates
    are texts like ``3/7``, null where nothing was to pass.
    """
    total, done = F.count(F.lit(1)), F.col("bucket") != "error"
    sums = ("f2p_total", "f2p_passed", "p2p_total", "p2p_passed", "total_tests", "total_passed")
    cost, steps = F.when(done, F.col("cost")), F.when(done & F.col("cost").isNotNull(), F.col("steps"))
    out = buckets.agg(
        total.alias("total"),
        F.count_if(done).alias("completed"),
        *[F.count_if(F.col("bucket") == b).alias(b) for b in ("resolved", "unresolved", "error")],
        F.round(F.count_if(F.col("bucket") == "resolved") * 100 / total, 1).alias("resolve_rate"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        F.round(F.sum(cost) / F.count(cost), 2).alias("avg_cost"),
        F.round(F.sum(steps) / F.count(cost), 1).alias("avg_steps"),
        F.round(F.sum(cost), 2).alias("total_cost"),
    )
    rate = lambda passed, of: F.when(F.col(of) > 0, F.concat_ws("/", F.col(passed).cast("string"), F.col(of).cast("string")))
    return out.withColumns({"test_pass_rate": rate("total_passed", "total_tests"), "f2p_pass_rate": rate("f2p_passed", "f2p_total"), "p2p_pass_rate": rate("p2p_passed", "p2p_total")})


# -- distributions -----------------------------------------------------------------


def distribution(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts and percent of each label, per ``by`` and in all.

    The window runs over the counted table, a few rows per group.
    """
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(*by))
    return counts.withColumn("percent", share)


def distribution_with_totals(df: DataFrame, label: str, by: str) -> DataFrame:
    """Rows of the report: per group and label, per group, and overall (null = all)."""
    return df.rollup(by, label).agg(F.count(F.lit(1)).alias("n"))


def floor_shares(df: DataFrame, label: str) -> DataFrame:
    return distribution(df, label).select(label, "n", F.floor("percent").alias("percent"))


def label_matrix(df: DataFrame, label: str, by: str, groups: Sequence[str]) -> DataFrame:
    """Labels as rows, groups as columns; labels nobody uses do not appear."""
    return df.groupBy(label).pivot(by, list(groups)).agg(F.count(F.lit(1))).fillna(0)


def box_figures(df: DataFrame, group: str, value: str) -> DataFrame:
    out = exact_percentiles(df, [group], value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, moments=True)
    return out.drop("mean", "std").withColumn("median_shown", F.floor("median"))


def ranked_by_size(df: DataFrame, group: str, value: str, tie: str) -> DataFrame:
    """Rows of each group numbered by rising ``value``."""
    return numbered(df, [group], [F.col(value), F.col(tie)], number_blocks(F.col(value)), "place")


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Most frequent values first; ``top`` makes it a top-k report."""
    out = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    out = out.orderBy(F.col("n").desc(), F.col(column))
    return out if top is None else out.limit(top)


def describe(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample deviation, min, percentiles, max."""
    return exact_percentiles(df, by, value, probs, moments=True)


def describe_many(df: DataFrame, values: Sequence[str], probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """:func:`describe` of several columns at once: a row per (metric, group), from one pass over ``df``."""
    metrics = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("_value")) for n in values])
    return exact_percentiles(df.select(*by, F.inline(metrics)), ["metric", *by], "_value", probs, moments=True)


def build_failures(df: DataFrame, key: str, reason: str) -> DataFrame:
    """Builds that did not succeed, with their reason (``unknown`` if none is given)."""
    failed = ~F.coalesce(F.col("status") == "success", F.lit(False))
    return df.filter(failed).select(key, F.coalesce(F.nullif(F.col(reason), F.lit("")), F.lit("unknown")).alias("reason"))


def build_summary(df: DataFrame) -> DataFrame:
    ok = F.count_if(F.coalesce(F.col("status") == "success", F.lit(False)))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total"), ok.alias("succeeded"), (total - ok).alias("failed"),
        F.when(total > 0, ok / total).otherwise(F.lit(0.0)).alias("success_rate"),
    )


def cost(input_tokens: Column, output_tokens: Column, per_input: float, per_output: float) -> Column:
    return input_tokens * F.lit(per_input) + output_tokens * F.lit(per_output)


def cost_rollup(calls: DataFrame, by: str) -> DataFrame:
    """Calls, tokens and cost per iteration and, in the row where it is null, in total."""
    return calls.rollup(by).agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.round(F.sum("cost"), 6).alias("cost"),
    )


def cell_text(value: Column, nested: bool = False) -> Column:
    """Cell of the review sheet: null is empty, nested values are JSON, literal ``\\n`` is a line break."""
    text = F.to_json(value) if nested else F.replace(value.cast("string"), F.lit("\\n"), F.lit("\n"))
    return F.coalesce(text, F.lit(""))


def review_sheet(df: DataFrame) -> DataFrame:
    """All review columns as text; columns the input lacks are empty."""
    nested = {f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "map", "struct")}
    return df.select(
        *[(cell_text(F.col(c), c in nested) if c in df.columns else F.lit("")).alias(c) for c in REVIEW_COLUMNS]
    )
