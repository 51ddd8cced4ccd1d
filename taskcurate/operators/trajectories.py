"""Agent runs: step tables, run headers, and what they say about success."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import actions as A
from ..functions import paths
from .ordered import id_blocks, numbered, running

STEP_BLOCK = 4096


def with_actions(steps: DataFrame, action: str = "action") -> DataFrame:
    """Add ``fn`` and ``params`` parsed from the action markup.

    A one-row generator holds the result, so filters on it do not parse again.
    """
    a = F.col(action)
    parsed = F.struct(A.function_name(a).alias("fn"), A.parameters(a).alias("params"))
    return steps.select("*", F.inline(F.array(parsed)))


def _param(name: str) -> Column:
    return F.col("params").getItem(name)


def _has_dot(path: Column) -> Column:
    return paths.basename(path).contains(".")


def file_uses(steps: DataFrame, key: str) -> DataFrame:
    """Long table (key, step_idx, use, path): files viewed, edited and created."""
    use = (
        F.when((F.col("fn") == "file_editor") & (_param("command") == "view"), "viewed")
        .when((F.col("fn") == "file_editor") & (_param("command") == "str_replace"), "edited")
        .when((F.col("fn") == "file_editor") & (_param("command") == "create"), "created")
        .when(F.col("fn") == "file_viewer", "viewed")
    )
    out = steps.select(key, "step_idx", use.alias("use"), _param("path").alias("_p")).filter("use IS NOT NULL AND _p <> ''")
    short = F.when(F.col("use") == "viewed", F.col("_p")).otherwise(F.replace("_p", F.lit("/testbed/"), F.lit("")))
    return out.filter(_has_dot(F.col("_p"))).select(key, "step_idx", "use", short.alias("path"))


def bash_lines(steps: DataFrame, key: str) -> DataFrame:
    """Line breaks in the output of each shell step."""
    n = F.length("observation") - F.length(F.replace("observation", F.lit("\n"), F.lit("")))
    return steps.filter("fn = 'execute_bash'").select(key, "step_idx", n.alias("lines"))


def test_command(steps: DataFrame, key: str) -> DataFrame:
    """First shell command that runs the one file a run created; runs with other counts are left out."""
    created = file_uses(steps, key).filter("use = 'created'").groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.min("path").alias("_file")
    ).filter("_n = 1")
    runs = steps.filter("fn = 'execute_bash'").select(key, "step_idx", _param("cmd").alias("cmd")).filter("cmd LIKE '%python%'")
    hit = runs.join(created, key).filter(F.col("cmd").contains(F.col("_file")))
    return hit.groupBy(key).agg(F.min_by("cmd", "step_idx").alias("command"))


def totals(steps: DataFrame, key: str) -> DataFrame:
    return steps.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.sum("token_prompt").alias("tokens_prompt"),
        F.sum("token_completion").alias("tokens_completion"),
        F.sum(F.col("token_prompt") + F.col("token_completion")).alias("tokens_total"),
        F.sum("llm_time").alias("llm_time"),
        F.sum("env_time").alias("env_time"),
        F.max("llm_time").alias("max_llm_step"),
        F.max_by(F.col("llm_time") + F.col("env_time"), "step_idx").alias("last_step_time"),
    )


def error_steps(steps: DataFrame, key: str, ending: str = "Error executing command:", marker: str = "ERROR: Unhandled exception") -> DataFrame:
    """Failed steps per run, and whether the editor ever crashed."""
    failed = F.rtrim(F.regexp_replace("observation", r"\s+\z", "")).endswith(ending)
    crashed = (F.col("fn") == "file_editor") & F.col("observation").contains(marker)
    return steps.groupBy(key).agg(F.count_if(failed).alias("error_steps"), F.bool_or(crashed).alias("editor_crashed"))


def observation_sizes(steps: DataFrame) -> DataFrame:
    """(action, command, lines, chars, words) of every observation."""
    text = F.col("observation")
    return steps.select(
        F.col("fn").alias("action"),
        F.when(F.col("fn") == "file_editor", _param("command")).alias("command"),
        F.size(F.split(text, "\n")).alias("lines"),
        F.length(text).alias("chars"),
        F.size(F.regexp_extract_all(text, F.lit(r"[^ \t\n\r]+"), 0)).alias("words"),
    )


def view_ranges(steps: DataFrame, key: str) -> DataFrame:
    """Mean, shortest and longest viewed range per run."""
    bounds = r"\[\s*(-?\d+)\s*,\s*(-?\d+)\s*\]"
    full = F.coalesce(F.nullif(_param("concise"), F.lit("")), F.lit("False")) == "False"
    seen = steps.filter((F.col("fn") == "file_editor") & (_param("command") == "view") & _param("view_range").isNotNull() & full)
    length = F.regexp_extract(_param("view_range"), bounds, 2).cast("long") - F.regexp_extract(_param("view_range"), bounds, 1).cast("long")
    return seen.select(key, length.alias("_len")).groupBy(key).agg(
        F.avg("_len").alias("mean_range"), F.min("_len").alias("min_range"), F.max("_len").alias("max_range")
    )


def longest_view_run(steps: DataFrame, key: str) -> DataFrame:
    """Longest run of views of one Python file in a row; any other step breaks it.

    A run is a set of views whose place among all steps and place among the
    views of the file differ by the same number.
    """
    file = F.when(
        (F.col("fn") == "file_editor") & (_param("command") == "view") & _param("path").endswith(".py"), _param("path")
    )
    placed = steps.select(key, "step_idx", F.coalesce(file, F.lit("")).alias("_file"))
    block = [F.floor(F.col("step_idx") / STEP_BLOCK)]
    for name, keys in (("_all", [key]), ("_own", [key, "_file"])):
        placed = numbered(placed, keys, [F.col("step_idx")], block, name)
    # a step that is no such view makes a run of length 0
    runs = placed.groupBy(key, "_file", (F.col("_all") - F.col("_own")).alias("_run")).agg(F.count_if(F.col("_file") != "").alias("_n"))
    return runs.groupBy(key).agg(F.max("_n").alias("longest"))


def bad_paths(steps: DataFrame, key: str, action: str = "action", marker: str = "/testbed/testbed") -> DataFrame:
    in_editor = (F.col("fn") == "file_editor") & F.coalesce(_param("path").contains(marker), F.lit(False))
    return steps.groupBy(key).agg(
        F.bool_or(in_editor).alias("bad_editor_path"), F.bool_or(F.col(action).contains(marker)).alias("bad_path")
    )


def oversized(steps: DataFrame, key: str, limit: int = 15000, first: int = 10) -> DataFrame:
    """First editor steps with an oversized observation (a top-k report)."""
    big = steps.filter((F.col("fn") == "file_editor") & (F.length("observation") > limit))
    return big.select(key, "step_idx", F.length("observation").alias("chars")).orderBy(key, "step_idx").limit(first)


# -- run headers -------------------------------------------------------------------


def success_by_repo(heads: DataFrame) -> DataFrame:
    """Solved, total and rate per repository and, where it is null, overall."""
    solved = F.count_if(F.col("reward") == 1)
    return heads.rollup("repo").agg(
        solved.alias("solved"), F.count(F.lit(1)).alias("total"), (solved / F.count(F.lit(1))).alias("rate"),
        F.count_if(F.col("output_patch") == "").alias("empty_patches"),
    )


def without_reason(heads: DataFrame, reason: str = "traj_time_limit") -> DataFrame:
    return heads.filter(~F.col("exit_reason").eqNullSafe(reason))


def running_success(heads: DataFrame, order: Sequence[Column], block: Sequence[Column]) -> DataFrame:
    """Solved and success rate of all earlier runs; 0 for the first."""
    out = running(
        heads, [], order, block, exclusive=True,
        _seen=("sum", F.lit(1)), solved_before=("sum", F.coalesce((F.col("reward") == 1).cast("long"), F.lit(0))),
    )
    rate = F.when(F.col("_seen") > 0, F.col("solved_before") / F.col("_seen")).otherwise(F.lit(0.0))
    return out.withColumn("rate_before", rate).drop("_seen")


def success_by_steps(heads: DataFrame, tie: str) -> DataFrame:
    """Runs by rising number of steps: success so far, and the share of runs before."""
    out = running(
        heads, [], [F.col("n_steps"), F.col(tie)], [F.col("n_steps"), *id_blocks(F.col(tie))],
        place=("sum", F.lit(1)), _solved=("sum", F.coalesce(F.col("reward"), F.lit(0)).cast("long")),
    )
    out = out.withColumn("_n", heads.agg(F.count(F.lit(1))).scalar())
    return out.withColumns({"success": F.col("_solved") / F.col("place"), "share": (F.col("place") - 1) / F.col("_n")}).drop("_solved", "_n")


def reward_ids(heads: DataFrame, id_col: str) -> DataFrame:
    """Long form of the reward lists: (reward_1, id); rows without id are left out."""
    one = F.coalesce(F.col("reward") == 1, F.lit(False))
    return heads.filter(F.col(id_col).isNotNull()).select(one.alias("reward_1"), id_col)


def reward_summary(heads: DataFrame, id_col: str) -> DataFrame:
    one = F.coalesce(F.col("reward") == 1, F.lit(False)) & F.col(id_col).isNotNull()
    zero = ~F.coalesce(F.col("reward") == 1, F.lit(False)) & F.col(id_col).isNotNull()
    return heads.agg(F.count(F.lit(1)).alias("total"), F.count_if(one).alias("reward_1"), F.count_if(zero).alias("reward_0"))


def patch_difference(truth: Column, own: Column, truth_lines: Column, own_lines: Column) -> dict[str, Column]:
    return {
        "patch_len_diff": F.length(truth) - F.length(own),
        "lines_diff": truth_lines - own_lines,
        "far_off": F.abs(truth_lines - own_lines) > 10,
    }


def run_summary(heads: DataFrame, steps: DataFrame, key: str) -> DataFrame:
    """One row per run: success, steps, patch size and file counts."""
    uses = file_uses(steps, key).groupBy(key).agg(
        *[F.count_if(F.col("use") == u).alias(f"n_{u}") for u in ("viewed", "edited", "created")]
    )
    counts = steps.groupBy(key).agg(F.count(F.lit(1)).alias("step_count"))
    out = heads.join(counts, key, "left").join(uses, key, "left")
    return out.select(
        key, F.coalesce(F.col("reward") == 1, F.lit(False)).alias("pass"), F.length("output_patch").alias("patch_size"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("step_count", "n_viewed", "n_edited", "n_created")],
    )


# -- predicted files ---------------------------------------------------------------


def file_recall(truth: DataFrame, predicted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share of the true files that were predicted: all, outside tests, tests.

    No true file of a kind counts as full recall.  ``truth`` is (keys, path,
    is_test); paths lose leading dots and slashes before they are compared.
    """
    norm = paths.normalise(F.col("path")).alias("path")
    hits = predicted.select(*keys, norm).distinct().withColumn("_hit", F.lit(1))
    rows = truth.select(*keys, norm, "is_test").join(hits, [*keys, "path"], "left")

    def recall(kind: Column) -> Column:
        return F.coalesce(F.avg(F.when(kind, F.coalesce("_hit", F.lit(0)))), F.lit(1.0))

    test = F.col("is_test")
    return rows.groupBy(*keys).agg(
        recall(F.lit(True)).alias("recall_all"), recall(~test).alias("recall_code"), recall(test).alias("recall_test"),
        (F.count_if(~test) == 1).alias("single_code_file"),
    )


def mean_recall(recalls: DataFrame) -> DataFrame:
    """Averages over all rows and over rows with exactly one file outside tests."""
    names = ("recall_all", "recall_code", "recall_test")
    one = F.col("single_code_file")
    return recalls.agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in names],
        F.count_if(one).alias("n_single"), *[F.avg(F.when(one, F.col(c))).alias(f"{c}_single") for c in names],
    )


def file_relation(truth: DataFrame, predicted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Same files, strictly fewer, strictly more; and the counts."""
    t = truth.select(*keys, "path").distinct().withColumn("_t", F.lit(1))
    p = predicted.select(*keys, "path").distinct().withColumn("_p", F.lit(1))
    both = t.join(p, [*keys, "path"], "full_outer")
    n = both.groupBy(*keys).agg(F.count("_t").alias("n_true"), F.count("_p").alias("n_predicted"), F.count(F.expr("_t + _p")).alias("_both"))
    only_t, only_p = F.col("n_true") - F.col("_both"), F.col("n_predicted") - F.col("_both")
    return n.select(
        *keys, "n_true", "n_predicted", ((only_t == 0) & (only_p == 0)).alias("same"),
        ((only_p == 0) & (only_t > 0)).alias("subset"), ((only_t == 0) & (only_p > 0)).alias("superset"),
    )


def path_overlap(modified: DataFrame, edited: DataFrame, created: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Files both modified and edited, and files edited but not created, as (keys, path, kind)."""
    cols = [*keys, "path"]
    e = edited.select(*cols).distinct()
    both = e.join(modified.select(*cols), cols, "left_semi").withColumn("kind", F.lit("modified_by_edit"))
    old = e.join(created.select(*cols), cols, "left_anti").withColumn("kind", F.lit("existing_edited"))
    return both.unionByName(old)


# -- texts -------------------------------------------------------------------------


def condense_plan(blocks: DataFrame, key: str, block_no: str, text: str, total: DataFrame, budget: int,
                  placeholder: str = "<Thought condensed for saving context>") -> DataFrame:
    """Which thoughts give way to a placeholder so that a transcript fits.

    The longest goes first, then the next, until the text fits; a transcript
    with one block stays as it is.  A block therefore goes exactly if the text
    is still too long after all longer ones (earlier ones on a tie) went.
    ``total`` is (key, chars).
    """
    sized = blocks.select(key, block_no, F.length(text).cast("long").alias("size"), (F.trim(text) == placeholder).alias("_done"))
    order, width = [F.col("size").desc(), F.col(block_no)], len(placeholder)
    saved = running(
        sized.filter(~F.col("_done")), [key], order, [-F.col("size"), F.floor(F.col(block_no) / STEP_BLOCK)],
        exclusive=True, _saved=("sum", F.col("size") - width),
    )
    counts = sized.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    out = saved.join(total, key).join(counts, key)
    goes = (F.col("_n") > 1) & (F.col("chars") - F.col("_saved") > budget)
    return out.select(key, block_no, "size", goes.alias("condensed"))


BLOCK_OPEN, BLOCK_CLOSE, CONDENSED = "[ASSISTANT]", "<function", "<Thought condensed for saving context>"


def condensed(text: Column, budget: int) -> Column:
    """A transcript whose longest thoughts give way to a placeholder until it has ``budget`` characters.

    A thought is what stands between ``BLOCK_OPEN`` and the next
    ``BLOCK_CLOSE``.  The longest goes first (the earlier one on a tie); with
    one thought, or when all are gone, the text stays as it is.  All of it
    happens inside the cell.
    """
    found = rf"(?s)\Q{BLOCK_OPEN}\E(.*?)\Q{BLOCK_CLOSE}\E"
    thoughts, between = F.regexp_extract_all(text, F.lit(found), 1), F.split(text, found)
    sized = F.filter(
        F.transform(thoughts, lambda t, i: F.struct((-F.length(t)).alias("size"), i.alias("at"), (F.trim(t) == CONDENSED).alias("done"))),
        lambda t: ~t["done"],
    )
    start = F.struct(F.length(text).cast("long").alias("left"), F.array().cast("array<int>").alias("gone"))
    plan = F.aggregate(
        F.array_sort(sized), start,
        lambda s, t: F.when(
            s["left"] > budget,
            F.struct((s["left"] + t["size"] + len(CONDENSED)).cast("long").alias("left"), F.concat(s["gone"], F.array(t["at"])).alias("gone")),
        ).otherwise(s),
    )
    new = F.transform(thoughts, lambda t, i: F.concat(F.lit(BLOCK_OPEN), F.when(F.array_contains(plan["gone"], i), CONDENSED).otherwise(t), F.lit(BLOCK_CLOSE)))
    whole = F.array_join(F.transform(between, lambda b, i: F.concat(b, F.coalesce(F.get(new, i), F.lit("")))), "")
    return F.when((F.size(thoughts) > 1) & (F.length(text) > budget), whole).otherwise(text)


def transcript(steps: DataFrame, key: str, step_text: Column) -> DataFrame:
    """One text per run: its steps in order (a text cell, so bounded by one run)."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("step_idx"), step_text.alias("t"))))
    return steps.groupBy(key).agg(F.array_join(F.transform(ordered, lambda r: r["t"]), "").alias("transcript"))


def verifier_step(idx: Column, thought: Column, action: Column, observation: Column) -> Column:
    said = F.when(F.coalesce(thought, F.lit("")) != "", F.concat(thought, F.lit("\n\n"), action)).otherwise(action)
    return F.concat(
        F.lit("\n\n[STEP]\n"), idx.cast("string"), F.lit("\n[/STEP]\n\n[ASSISTANT]\n"), said,
        F.lit("\n[/ASSISTANT]\n\n[USER]\n"), observation, F.lit("\n[/USER]"),
    )


def reasoning_step(idx: Column, thought: Column, action: Column, observation: Column) -> Column:
    return F.concat(
        F.lit("=" * 100 + "\nStep "), idx.cast("string"), F.lit(":\n\nThought:\n\n"), thought, F.lit("\nAction:\n\n"), action,
        F.lit("\nObservation:\n\n"), observation, F.lit("\n"),
    )


def history_step(thought: Column, action: Column, observation: Column) -> Column:
    return F.concat(thought, F.lit("\n```\n"), action, F.lit("\n```\n\nOBSERVATION:\n```\n"), observation, F.lit("\n```\n" + "-" * 50 + "\n"))


def judgement(reward: Column) -> Column:
    return F.concat(F.lit("<judgement>"), F.when(reward == 1, "YES").otherwise("NO"), F.lit("</judgement>"))


def training_rows(heads: DataFrame, history: str, tools: str) -> DataFrame:
    """JSON line per run: the history, wrapped with the tools if there are any; and whether it was solved."""
    wrapped = F.to_json(F.struct(F.col(history).alias("messages"), F.col(tools).alias("tools")))
    line = F.when(F.col(tools).isNotNull(), wrapped).otherwise(F.to_json(history))
    return heads.filter(F.col(history).isNotNull()).select(line.alias("line"), F.coalesce(F.col("reward") == 1, F.lit(False)).alias("solved"))


def shuffled_examples(df: DataFrame, id_col: str, text: str, seed: str) -> DataFrame:
    """All texts in a seeded random order, each as a numbered example row."""
    keyed = df.select(id_col, F.md5(F.concat(F.lit(seed), F.col(id_col).cast("string"))).alias("_h"))
    ranked = numbered(keyed, [], [F.col("_h"), F.col(id_col)], [F.substring("_h", 1, 3), F.substring("_h", 4, 3)], "place")
    ranked = ranked.join(df.select(id_col, F.col(text).alias("_text")), id_col)  # texts stay out of the numbering
    example = F.concat(F.lit("\n\nExample "), F.col("place").cast("string"), F.lit(":\n\n[ISSUE]\n"), F.col("_text"), F.lit("\n[/ISSUE]\n"))
    return ranked.select("place", id_col, example.alias("example"))
