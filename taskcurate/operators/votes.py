"""Judge votes and what they add up to.  All counts are map-side combined; votes are never gathered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import strip


def keep_or_reject(votes: DataFrame) -> DataFrame:
    """Majority per instance, a tie keeps; the first vote of the winning side speaks for it."""
    said = F.upper(F.coalesce("verdict", F.lit("KEEP")))
    row = F.struct("reason", "category")
    counted = votes.groupBy("instance").agg(
        F.count_if(said == "KEEP").alias("keep"),
        F.count(F.lit(1)).alias("total"),
        F.min_by(F.when(said == "KEEP", row), F.when(said == "KEEP", F.col("vote_idx"))).alias("_keep"),
        F.min_by(F.when(said == "REJECT", row), F.when(said == "REJECT", F.col("vote_idx"))).alias("_reject"),
        F.min_by(row, "vote_idx").alias("_any"),
    )
    reject = F.col("total") - F.col("keep")
    winner = F.when(F.col("keep") >= reject, "KEEP").otherwise("REJECT")
    speaker = F.coalesce(F.when(winner == "KEEP", F.col("_keep")).otherwise(F.col("_reject")), F.col("_any"))
    return counted.select(
        "instance", winner.alias("verdict"), "keep", reject.alias("reject"), "total",
        speaker["reason"].alias("reason"), speaker["category"].alias("category"),
    )


def apply_verdicts(instances: DataFrame, verdicts: DataFrame) -> DataFrame:
    """An empty patch is rejected, an instance nobody voted on is kept without verdict details."""
    out = instances.join(verdicts, "instance", "left")
    empty = ~F.coalesce(F.col("patch"), F.lit("")).rlike(r"\S")
    final = F.when(empty, "REJECT").otherwise(F.coalesce("verdict", F.lit("KEEP")))
    return out.withColumn("verdict", final)


def _fails(dim: str) -> Column:
    return F.count_if((F.col("dim") == dim) & (F.upper("verdict") == "FAIL"))


def quality_verdict(votes: DataFrame, dims: Sequence[str], strict_pass: bool = False) -> DataFrame:
    """Overall and per-dimension verdict from long votes (instance, vote_idx, dim, verdict, reason, summary).

    Overall fails if more votes fail than pass.  A vote that does not fail
    counts as a pass, unless ``strict_pass``: then only an explicit PASS does,
    and the summary of the first vote on the winning side is added.  A
    dimension fails if more than half of all votes fail it.
    """
    overall = F.col("dim") == "overall"
    said = F.upper("verdict")
    aggs = [F.count_if(overall).alias("total"), _fails("overall").alias("fail"), F.count_if(overall & (said == "PASS")).alias("_pass")]
    aggs += [_fails(d).alias(f"_fail_{d}") for d in dims]
    if strict_pass:
        for side in ("FAIL", "PASS"):
            hit = overall & (said == side) & (F.coalesce("summary", F.lit("")) != "")
            aggs.append(F.min_by(F.when(hit, F.col("summary")), F.when(hit, F.col("vote_idx"))).alias(f"_say_{side}"))
    counted = votes.groupBy("instance").agg(*aggs)
    passed = F.col("_pass") if strict_pass else F.col("total") - F.col("fail")
    winner = F.when(F.col("fail") > passed, "FAIL").otherwise("PASS")
    cols = [F.col("instance"), winner.alias("overall"), passed.alias("pass"), F.col("fail"), F.col("total")]
    cols += [F.when(F.col(f"_fail_{d}") > F.floor(F.col("total") / 2), "FAIL").otherwise("PASS").alias(d) for d in dims]
    if strict_pass:
        cols.append(F.when(winner == "FAIL", F.col("_say_FAIL")).otherwise(F.col("_say_PASS")).alias("summary"))
    return counted.select(*cols)


def failure_reasons(votes: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Long form of the collected reasons: one row per failing vote and dimension."""
    hit = F.col("dim").isin(*dims) & (F.upper("verdict") == "FAIL")
    return votes.filter(hit).select("instance", "dim", "vote_idx", "reason")


def feedback(verdicts: DataFrame, reasons: DataFrame, dims: Sequence[str], bold: bool = False) -> DataFrame:
    """One text per instance that names every failed dimension and why.

    Reasons of one dimension are joined first, dimensions of an instance then.
    """
    ordered = F.array_sort(F.collect_list(F.struct("vote_idx", "reason")))
    cells = reasons.groupBy("instance", "dim").agg(
        F.array_join(F.transform(ordered, lambda r: r["reason"]), "; ").alias("why")
    )
    failed = verdicts.select(
        "instance",
        F.inline(F.array(*[F.struct(F.lit(i).alias("at"), F.lit(d).alias("dim"), F.col(d).alias("v")) for i, d in enumerate(dims)])),
    ).filter("v = 'FAIL'")
    name = F.concat(F.lit("**"), F.upper("dim"), F.lit("**")) if bold else F.upper("dim")
    line = F.concat(F.lit("- "), name, F.lit(": FAIL — "), F.coalesce("why", F.lit("no detail")))
    lines = failed.join(cells, ["instance", "dim"], "left").select("instance", "at", line.alias("line"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda r: r["line"]), "\n")
    texts = lines.groupBy("instance").agg(text.alias("feedback"))
    out = verdicts.select("instance").join(texts, "instance", "left")
    return out.withColumn("feedback", F.coalesce("feedback", F.lit("No specific failures identified.")))


def verified(verdicts: DataFrame) -> DataFrame:
    return verdicts.filter("overall = 'PASS'")


def verdict_breakdown(verdicts: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Rows (measure, n): final verdicts and fails per dimension."""
    final = verdicts.groupBy(F.concat(F.lit("overall "), "overall").alias("measure")).agg(F.count(F.lit(1)).alias("n"))
    fails = verdicts.agg(*[F.count_if(F.col(d) == "FAIL").alias(d) for d in dims]).select(
        F.inline(F.array(*[F.struct(F.lit(f"fails {d}").alias("measure"), F.col(d).alias("n")) for d in dims]))
    )
    return final.unionByName(fails)


# -- model answers -----------------------------------------------------------------


def json_block(text: Column) -> Column:
    """First fenced json block, else the first fenced block that is valid JSON, else the text itself."""
    fenced = F.regexp_extract_all(text, F.lit(r"(?i)```json([\s\S]*?)```"), 1)
    other = F.filter(
        F.transform(F.regexp_extract_all(text, F.lit(r"```([\s\S]*?)```"), 1), lambda b: strip(b)),
        lambda b: F.try_parse_json(b).isNotNull(),
    )
    return F.coalesce(strip(F.get(fenced, F.lit(0))), F.get(other, F.lit(0)), text)


def braces(text: Column) -> Column:
    """Fenced json object, else everything from the first to the last brace."""
    return F.coalesce(
        F.nullif(F.regexp_extract(text, r"(?s)```json\s*(\{.*?\})\s*```", 1), F.lit("")),
        F.nullif(F.regexp_extract(text, r"(?s)(\{.*\})", 1), F.lit("")),
    )


def parsed_answer(text: Column, schema: str, key: str, default: str) -> Column:
    """Struct of the answer; an answer that is not JSON yields ``default`` in ``key``."""
    body = braces(text)
    good = F.try_parse_json(body).isNotNull()
    fields = F.when(good, F.from_json(body, schema))
    return F.struct(F.coalesce(fields[key], F.lit(default)).alias(key), fields.alias("fields"))
