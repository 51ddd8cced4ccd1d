"""Queries over agent runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import actions as A
from ..functions import paths
from ..operators import reports as R
from ..operators import selection
from ..operators import trajectories as J
from ..operators.ordered import id_blocks
from .registry import query
from .views import Views


def _steps(v: Views):
    return J.with_actions(v.traj())


_MARKUP = "CASE WHEN fn = 'execute_bash' THEN '<function=execute_bash>' || chr(10) || '  <parameter=cmd>' || cmd || '</parameter>' || chr(10) || '</function>'"
_RENDERED = f"""{_MARKUP} WHEN command = 'view' THEN '<function=file_editor>' || chr(10) || '  <parameter=command>view</parameter>' || chr(10) || '  <parameter=path>' || path || '</parameter>' || chr(10)
  || '  <parameter=view_range>[' || step_idx || ', ' || step_idx + view_len || ']</parameter>' || chr(10) || '</function>'
  ELSE '<function=file_editor>' || chr(10) || '  <parameter=command>str_replace</parameter>' || chr(10) || '  <parameter=path>' || path || '</parameter>' || chr(10) || '</function>' END"""


@query("x18_actions", f"""
SELECT conv_id, step_idx, fn, command, path, {_RENDERED} AS markup,
  CASE WHEN fn = 'execute_bash' THEN 'execute_bash --cmd ''' || cmd || '''' WHEN command = 'view' THEN 'file_editor view --path ' || path || ' --view_range ''[' || step_idx || ', ' || step_idx + view_len || ']'''
    ELSE 'file_editor str_replace --path ' || path END AS shell,
  CASE WHEN fn = 'execute_bash' THEN '{{"function":"execute_bash","parameters":{{"cmd":"' || cmd || '"}}}}' END AS as_json FROM v_traj""")
def actions(v: Views):
    fn, params = F.col("fn"), F.col("params")
    return _steps(v).select(
        "conv_id", "step_idx", "fn", params["command"].alias("command"), params["path"].alias("path"), A.to_markup(fn, params).alias("markup"),
        A.to_shell(fn, params).alias("shell"), F.when(fn == "execute_bash", A.to_json(fn, params)).alias("as_json"))


@query("x19_responses", """
SELECT conv_id, turn AS step_idx, '<think>' || trim(text, ' ' || chr(10)) || '</think>' AS thought, trim('pre <think>' || trim(text, ' ' || chr(10)) || '</think>') AS lead_thought,
  CASE WHEN turn % 3 = 2 THEN NULL ELSE 'ls -l' END AS command FROM conversations""")
def responses(v: Views):
    text = F.regexp_replace(F.col("text"), r"^[ \n]+|[ \n]+\z", "")
    resp = F.concat(F.lit("pre <think>"), text, F.lit("</think>\n<function=f>\n</function> tail"))
    mini = F.concat(F.lit("go\n```bash\n ls -l \n```\n"), F.when(F.col("turn") % 3 == 2, F.lit("```bash\nrm\n```")).otherwise(F.lit("")))
    return v.table("conversations").select(
        "conv_id", F.col("turn").alias("step_idx"), A.tagged_thought(resp)["thought"].alias("thought"),
        A.leading_thought(resp)["thought"].alias("lead_thought"), A.single_command(mini)["command"].alias("command"))


@query("x29_file_uses", """
SELECT conv_id, step_idx, CASE command WHEN 'view' THEN 'viewed' ELSE 'edited' END AS use, CASE command WHEN 'view' THEN path ELSE replace(path, '/testbed/', '') END AS path FROM v_traj WHERE command IS NOT NULL""")
def file_uses(v: Views):
    return J.file_uses(_steps(v), "conv_id")


@query("x29b_bash_lines", "SELECT conv_id, step_idx, (length(observation) - length(replace(observation, chr(10), '')))::BIGINT AS lines FROM v_traj WHERE fn = 'execute_bash'")
def bash_lines(v: Views):
    return J.bash_lines(_steps(v), "conv_id").withColumn("lines", F.col("lines").cast("long"))


@query("x29c_test_command", """
SELECT conv_id, 'python t' || conv_id || '.py' AS command FROM conversations GROUP BY conv_id HAVING bool_or(turn = 1) AND NOT (conv_id % 5 = 0 AND bool_or(turn = 3))""")
def test_command(v: Views):
    create = lambda name: F.expr(f"concat('<function=file_editor><parameter=command>create</parameter><parameter=path>/testbed/{name}', conv_id, '.py</parameter></function>')")
    action = (
        F.when(F.col("step_idx") == 0, create("t"))
        .when(F.col("step_idx") == 1, F.expr("concat('<function=execute_bash><parameter=cmd>python t', conv_id, '.py</parameter></function>')"))
        .when((F.col("step_idx") == 3) & (F.col("conv_id") % 5 == 0), create("second"))
    )
    return J.test_command(J.with_actions(v.traj().withColumn("action", F.coalesce(action, "action"))), "conv_id")


@query("a16_totals", """
SELECT conv_id, count(*) AS n_steps, sum(token_prompt)::BIGINT AS tokens_prompt, sum(token_completion)::BIGINT AS tokens_completion, sum(token_prompt + token_completion)::BIGINT AS tokens_total,
  sum(llm_time)::DOUBLE AS llm_time, sum(env_time)::DOUBLE AS env_time, max(llm_time)::DOUBLE AS max_llm_step, arg_max(llm_time + env_time, step_idx)::DOUBLE AS last_step_time FROM v_traj GROUP BY conv_id""")
def totals(v: Views):
    return J.totals(v.traj(), "conv_id")


@query("a17_time_limit_table", """
SELECT t.conv_id, count(*) AS n_steps, sum(llm_time)::DOUBLE AS llm_time, max(llm_time)::DOUBLE AS max_llm_step FROM v_traj t JOIN v_traj_head h ON h.traj_id = t.conv_id WHERE exit_reason = 'traj_time_limit' GROUP BY t.conv_id""")
def time_limit_table(v: Views):
    late = v.traj_head().filter("exit_reason = 'traj_time_limit'").select(F.col("traj_id").alias("conv_id"))
    return J.totals(v.traj().join(late, "conv_id", "left_semi"), "conv_id").select("conv_id", "n_steps", "llm_time", "max_llm_step")


@query("a18_error_steps", """
SELECT conv_id, count(*) FILTER (step_idx % 4 = 1) AS error_steps, bool_or(fn = 'file_editor' AND step_idx % 4 = 2) AS editor_crashed FROM v_traj GROUP BY conv_id""")
def error_steps(v: Views):
    obs = F.expr("concat(observation, CASE step_idx % 4 WHEN 1 THEN '\\nError executing command:\\n' WHEN 2 THEN ' ERROR: Unhandled exception x' ELSE '' END)")
    return J.error_steps(_steps(v).withColumn("observation", obs), "conv_id")


@query("a19_observation_sizes", """
SELECT fn AS action, count(*) AS n, round(avg(length(observation)), 6) AS mean, round(stddev_samp(length(observation)), 6) AS std, min(length(observation))::DOUBLE AS low, max(length(observation))::DOUBLE AS high,
  round(quantile_cont(length(observation), 0.05), 6)::DOUBLE AS p05, round(quantile_cont(length(observation), 0.5), 6)::DOUBLE AS p50, round(quantile_cont(length(observation), 0.95), 6)::DOUBLE AS p95 FROM v_traj GROUP BY fn""")
def observation_sizes(v: Views):
    df = R.describe(J.observation_sizes(_steps(v)), "chars", {"p05": 0.05, "p50": 0.5, "p95": 0.95}, ["action"])
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p05", "p50", "p95")})


@query("a19b_editor_lines", """
WITH o AS (SELECT command, len(string_split(observation, chr(10))) AS lines, len(regexp_extract_all(observation, '[^ \\t\\n\\r]+')) AS words FROM v_traj WHERE fn = 'file_editor')
SELECT command, count(*) AS n, round(quantile_cont(lines, 0.5), 6)::DOUBLE AS p50, round(quantile_cont(lines, 0.9), 6)::DOUBLE AS p90 FROM o WHERE words > 50 GROUP BY command""")
def editor_lines(v: Views):
    from ..operators.ordered import exact_percentiles

    big = J.observation_sizes(_steps(v)).filter("command IS NOT NULL AND words > 50")
    return exact_percentiles(big, ["command"], "lines", {"p50": 0.5, "p90": 0.9}).withColumns({c: F.round(c, 6) for c in ("p50", "p90")})


@query("a20_view_ranges", """
WITH r AS (SELECT conv_id, avg(view_len) AS m, min(view_len) AS lo, max(view_len) AS hi FROM v_traj WHERE view_len IS NOT NULL GROUP BY conv_id)
SELECT count(*) AS n, round(avg(m), 6) AS mean, round(stddev_samp(m), 6) AS std, min(m) AS low, max(m) AS high, round(quantile_cont(m, 0.25), 6) AS p25, round(quantile_cont(m, 0.5), 6) AS p50, round(quantile_cont(m, 0.95), 6) AS p95,
  sum(lo)::BIGINT AS sum_min, sum(hi)::BIGINT AS sum_max FROM r""")
def view_ranges(v: Views):
    ranges = J.view_ranges(_steps(v), "conv_id")
    df = R.describe(ranges, "mean_range", {"p25": 0.25, "p50": 0.5, "p95": 0.95})
    df = df.withColumn("sum_min", ranges.agg(F.sum("min_range")).scalar()).withColumn("sum_max", ranges.agg(F.sum("max_range")).scalar())
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p95")})


@query("w06_longest_view_run", """
WITH t AS (SELECT user_id AS conv_id, ts, event_id, CASE WHEN event_type IN ('click', 'view') THEN event_type || '.py' END AS f FROM events),
  a AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY event_id) - row_number() OVER (PARTITION BY conv_id, f ORDER BY event_id) AS g FROM t),
  r AS (SELECT conv_id, f, g, count(*) AS n FROM a WHERE f IS NOT NULL GROUP BY ALL)
SELECT c.conv_id, coalesce(max(n), 0)::BIGINT AS longest FROM (SELECT DISTINCT conv_id FROM t) c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id""")
def longest_view_run(v: Views):
    act = F.expr("""CASE WHEN event_type IN ('click', 'view') THEN concat('<function=file_editor><parameter=command>view</parameter><parameter=path>', event_type, '.py</parameter></function>')
        ELSE '<function=execute_bash><parameter=cmd>x</parameter></function>' END""")
    steps = v.table("events").select(F.col("user_id").alias("conv_id"), F.col("event_id").alias("step_idx"), act.alias("action"))
    return J.longest_view_run(J.with_actions(steps), "conv_id")


@query("f27_bad_paths", """
SELECT conv_id, bool_or(coalesce(contains(path, '/testbed/testbed'), false)) AS bad_editor_path, bool_or(coalesce(contains(path, '/testbed/testbed'), false) OR coalesce(contains(cmd, '/testbed/testbed'), false)) AS bad_path FROM v_traj GROUP BY conv_id""")
def bad_paths(v: Views):
    return J.bad_paths(_steps(v), "conv_id")


@query("f28_oversized", """
SELECT conv_id, step_idx, length(observation)::BIGINT AS chars FROM v_traj WHERE fn = 'file_editor' AND length(observation) > 300 ORDER BY conv_id, step_idx LIMIT 10""")
def oversized(v: Views):
    return J.oversized(_steps(v), "conv_id", limit=300).withColumn("chars", F.col("chars").cast("long"))


@query("f19_without_time_limit", "SELECT traj_id FROM v_traj_head WHERE exit_reason <> 'traj_time_limit'")
def without_time_limit(v: Views):
    return J.without_reason(v.traj_head()).select("traj_id")


@query("a13_success_by_repo", """
SELECT repo, count(*) FILTER (reward = 1) AS solved, count(*) AS total, round(count(*) FILTER (reward = 1) / count(*), 6)::DOUBLE AS rate, count(*) FILTER (output_patch = '') AS empty_patches FROM v_traj_head GROUP BY ROLLUP (repo)""")
def success_by_repo(v: Views):
    return J.success_by_repo(v.traj_head()).withColumn("rate", F.round("rate", 6))


@query("a14_value_counts", "SELECT exit_reason, count(*) AS n FROM v_traj_head GROUP BY exit_reason")
def value_counts(v: Views):
    return R.value_counts(v.traj_head(), "exit_reason")


@query("a14b_top_edited_files", """
SELECT name, count(*) AS n FROM (SELECT regexp_extract(path, '[^/]*$') AS name FROM v_traj WHERE command = 'str_replace') GROUP BY name ORDER BY n DESC, name LIMIT 5""")
def top_edited_files(v: Views):
    edits = J.file_uses(_steps(v), "conv_id").filter("use = 'edited'").select(paths.basename(F.col("path")).alias("name"))
    return R.value_counts(edits, "name", top=5)


@query("w04_running_success", """
SELECT traj_id, coalesce(sum(CASE WHEN reward = 1 THEN 1 ELSE 0 END) OVER w, 0)::BIGINT AS solved_before, round(coalesce(sum(CASE WHEN reward = 1 THEN 1.0 ELSE 0 END) OVER w / nullif(row_number() OVER (ORDER BY traj_id) - 1, 0), 0), 6)::DOUBLE AS rate_before
FROM v_traj_head WINDOW w AS (ORDER BY traj_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def running_success(v: Views):
    df = J.running_success(v.traj_head().select("traj_id", "reward"), [F.col("traj_id")], id_blocks(F.col("traj_id")))
    return df.select("traj_id", "solved_before", F.round("rate_before", 6).alias("rate_before"))


@query("w05_success_by_steps", """
WITH r AS (SELECT traj_id, reward, row_number() OVER (ORDER BY n_steps, traj_id) AS place FROM v_traj_head)
SELECT traj_id, place, round(sum(CASE WHEN reward = 1 THEN 1.0 ELSE 0 END) OVER (ORDER BY place) / place, 6)::DOUBLE AS success, round((place - 1) / count(*) OVER (), 6)::DOUBLE AS share FROM r""")
def success_by_steps(v: Views):
    df = J.success_by_steps(v.traj_head().select("traj_id", "n_steps", "reward"), "traj_id")
    return df.select("traj_id", F.col("place").cast("long").alias("place"), F.round("success", 6).alias("success"), F.round("share", 6).alias("share"))


@query("a24_reward_summary", """
SELECT count(*) AS total, count(*) FILTER (reward = 1 AND traj_id % 9 <> 0) AS reward_1, count(*) FILTER (reward IS DISTINCT FROM 1 AND traj_id % 9 <> 0) AS reward_0 FROM v_traj_head""")
def reward_summary(v: Views):
    heads = v.traj_head().withColumn("inst", F.expr("CASE WHEN traj_id % 9 <> 0 THEN traj_id END"))
    return J.reward_summary(heads, "inst")


@query("a24b_reward_ids", "SELECT coalesce(reward = 1, false) AS reward_1, traj_id AS inst FROM v_traj_head WHERE traj_id % 9 <> 0")
def reward_ids(v: Views):
    heads = v.traj_head().withColumn("inst", F.expr("CASE WHEN traj_id % 9 <> 0 THEN traj_id END"))
    return J.reward_ids(heads, "inst")


@query("x30_run_summary", """
WITH u AS (SELECT conv_id, count(*) AS step_count, count(*) FILTER (command = 'view') AS n_viewed, count(*) FILTER (command = 'str_replace') AS n_edited FROM v_traj GROUP BY conv_id)
SELECT traj_id AS conv_id, coalesce(reward = 1, false) AS pass, length(output_patch)::BIGINT AS patch_size, coalesce(step_count, 0)::BIGINT AS step_count, coalesce(n_viewed, 0)::BIGINT AS n_viewed,
  coalesce(n_edited, 0)::BIGINT AS n_edited, 0::BIGINT AS n_created FROM v_traj_head LEFT JOIN u ON conv_id = traj_id""")
def run_summary(v: Views):
    df = J.run_summary(v.traj_head().withColumnRenamed("traj_id", "conv_id"), _steps(v), "conv_id")
    return df.withColumn("patch_size", F.col("patch_size").cast("long"))


@query("x30b_patch_difference", """
SELECT traj_id, (length(repo) - length(output_patch))::BIGINT AS patch_len_diff, n_steps - 20 AS lines_diff, abs(n_steps - 20) > 10 AS far_off FROM v_traj_head""")
def patch_difference(v: Views):
    d = J.patch_difference(F.col("repo"), F.col("output_patch"), F.col("n_steps"), F.lit(20))
    return v.traj_head().select("traj_id", d["patch_len_diff"].cast("long").alias("patch_len_diff"), d["lines_diff"].alias("lines_diff"), d["far_off"].alias("far_off"))


@query("x32_exit_reason", """
SELECT traj_id, CASE WHEN reward = 1 AND n_steps < 40 THEN 'agent' WHEN reward = 1 AND n_steps = 40 THEN 'max_step_limit' WHEN reward = 1 THEN 'agent_max_step_limit'
  WHEN calc_time * 200 >= 65536 THEN 'token_limit' WHEN n_steps >= 45 THEN 'abs_step_limit' WHEN calc_time >= 100 THEN 'traj_time_limit' END AS why FROM v_traj_head""")
def exit_reason(v: Views):
    done = F.coalesce(F.col("reward") == 1, F.lit(False))
    why = A.exit_reason(done, F.col("n_steps"), F.col("calc_time") * 200, F.col("calc_time"), max_absolute=45, max_seconds=100.0)
    return v.traj_head().select("traj_id", why.alias("why"))


_PRED = "p AS (SELECT number, pos, path FROM v_files WHERE (pos + file_no) % 3 <> 0 UNION ALL SELECT DISTINCT number, pos, 'src/extra.py' FROM v_files WHERE pos % 5 = 0)"


def _predicted(v: Views):
    truth = v.patch_files().selectExpr("number", "pos", "inline(heads)")
    own = truth.filter("(pos + file_no) % 3 <> 0").select("number", "pos", F.concat(F.lit("./"), "path").alias("path"))
    extra = v.patch_files().filter("pos % 5 = 0").selectExpr("number", "pos", "'src/extra.py' AS path")
    return truth, own.unionByName(extra)


@query("j19_file_recall", f"""
WITH {_PRED}, t AS (SELECT f.number, f.pos, f.path LIKE 'tests/%' AS is_test, p.path IS NOT NULL AS hit FROM v_files f LEFT JOIN p ON p.number = f.number AND p.pos = f.pos AND p.path = f.path)
SELECT number, pos, round(avg(hit::INT), 6) AS recall_all, round(coalesce(avg(hit::INT) FILTER (NOT is_test), 1.0), 6) AS recall_code, round(coalesce(avg(hit::INT) FILTER (is_test), 1.0), 6) AS recall_test,
  count(*) FILTER (NOT is_test) = 1 AS single_code_file FROM t GROUP BY number, pos""")
def file_recall(v: Views):
    truth, pred = _predicted(v)
    df = J.file_recall(truth.withColumn("is_test", paths.is_test_file(F.col("path"))), pred, ["number", "pos"])
    return df.withColumns({c: F.round(c, 6) for c in ("recall_all", "recall_code", "recall_test")})


@query("j19b_mean_recall", f"""
WITH {_PRED}, t AS (SELECT f.number, f.pos, f.path LIKE 'tests/%' AS is_test, p.path IS NOT NULL AS hit FROM v_files f LEFT JOIN p ON p.number = f.number AND p.pos = f.pos AND p.path = f.path),
  r AS (SELECT avg(hit::INT) AS a, coalesce(avg(hit::INT) FILTER (NOT is_test), 1.0) AS c, coalesce(avg(hit::INT) FILTER (is_test), 1.0) AS e, count(*) FILTER (NOT is_test) = 1 AS s FROM t GROUP BY number, pos)
SELECT count(*) AS n, round(avg(a), 6) AS recall_all, round(avg(c), 6) AS recall_code, round(avg(e), 6) AS recall_test, count(*) FILTER (s) AS n_single, round(avg(a) FILTER (s), 6) AS recall_all_single,
  round(avg(c) FILTER (s), 6) AS recall_code_single, round(avg(e) FILTER (s), 6) AS recall_test_single FROM r""")
def mean_recall(v: Views):
    truth, pred = _predicted(v)
    df = J.mean_recall(J.file_recall(truth.withColumn("is_test", paths.is_test_file(F.col("path"))), pred, ["number", "pos"]))
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c.startswith("recall")})


@query("j20_file_relation", f"""
WITH {_PRED}, j AS (SELECT number, pos, path, f.path IS NOT NULL AS t, p.path IS NOT NULL AS p FROM v_files f FULL JOIN p USING (number, pos, path)),
  n AS (SELECT number, pos, count(*) FILTER (t) AS n_true, count(*) FILTER (p) AS n_predicted, count(*) FILTER (t AND NOT p) AS ot, count(*) FILTER (p AND NOT t) AS op FROM j GROUP BY ALL)
SELECT number, pos, n_true, n_predicted, ot = 0 AND op = 0 AS same, op = 0 AND ot > 0 AS subset, ot = 0 AND op > 0 AS superset FROM n""")
def file_relation(v: Views):
    truth, pred = _predicted(v)
    return J.file_relation(truth, pred.withColumn("path", paths.normalise(F.col("path"))), ["number", "pos"])


@query("u05_path_overlap", f"""
WITH {_PRED} SELECT DISTINCT number, pos, path, 'modified_by_edit' AS kind FROM p WHERE EXISTS (SELECT 1 FROM v_files f WHERE f.number = p.number AND f.pos = p.pos AND f.path = p.path)
UNION ALL SELECT DISTINCT number, pos, path, 'existing_edited' FROM p WHERE path NOT LIKE 'tests/%'""")
def path_overlap(v: Views):
    truth, pred = _predicted(v)
    edited = pred.withColumn("path", paths.normalise(F.col("path")))
    created = truth.filter(paths.is_test_file(F.col("path")))
    return J.path_overlap(truth, edited, created, ["number", "pos"])


_THOUGHT = "'<function=f>' || chr(10) || '</function>'"


@query("w12_condense_plan", """
WITH b AS (SELECT conv_id, turn, length(text) AS size FROM conversations WHERE role = 'assistant' OR turn % 2 = 0), t AS (SELECT conv_id, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY conv_id),
  s AS (SELECT *, coalesce(sum(size - 38) OVER (PARTITION BY conv_id ORDER BY size DESC, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS saved, count(*) OVER (PARTITION BY conv_id) AS n FROM b)
SELECT conv_id, turn, size::BIGINT AS size, n > 1 AND chars - saved > 700 AS condensed FROM s JOIN t USING (conv_id)""")
def condense_plan(v: Views):
    c = v.table("conversations")
    blocks = c.filter("role = 'assistant' OR turn % 2 = 0")
    total = c.groupBy("conv_id").agg(F.sum(F.length("text")).alias("chars"))
    return J.condense_plan(blocks, "conv_id", "turn", "text", total, 700)


@query("w12b_condensed_text", """
WITH b AS (SELECT conv_id, turn, text, role = 'assistant' OR turn % 2 = 0 AS block FROM conversations),
  c AS (SELECT *, sum(length(text) + CASE WHEN block THEN 20 ELSE 0 END) OVER (PARTITION BY conv_id) AS chars, count(*) FILTER (block) OVER (PARTITION BY conv_id) AS n,
    coalesce(sum(CASE WHEN block THEN length(text) - 38 END) OVER (PARTITION BY conv_id, block ORDER BY length(text) DESC, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS saved FROM b)
SELECT conv_id, string_agg(CASE WHEN NOT block THEN text ELSE '[ASSISTANT]' || CASE WHEN n > 1 AND chars - saved > 700 THEN '<Thought condensed for saving context>' ELSE text END || '<function' || chr(10) END, '' ORDER BY turn) AS transcript FROM c GROUP BY conv_id""")
def condensed_text(v: Views):
    steps = v.table("conversations").withColumnRenamed("turn", "step_idx")
    said = F.when((F.col("role") == "assistant") | (F.col("step_idx") % 2 == 0), F.concat(F.lit("[ASSISTANT]"), "text", F.lit("<function\n"))).otherwise(F.col("text"))
    return J.transcript(steps, "conv_id", said).withColumn("transcript", J.condensed(F.col("transcript"), 700))


@query("x26_transcripts", """
SELECT conv_id, string_agg(chr(10) || chr(10) || '[STEP]' || chr(10) || turn || chr(10) || '[/STEP]' || chr(10) || chr(10) || '[ASSISTANT]' || chr(10) || role || chr(10) || chr(10) || 'act' || chr(10) || '[/ASSISTANT]'
  || chr(10) || chr(10) || '[USER]' || chr(10) || text || chr(10) || '[/USER]', '' ORDER BY turn) AS verifier,
  string_agg(repeat('=', 100) || chr(10) || 'Step ' || turn || ':' || chr(10) || chr(10) || 'Thought:' || chr(10) || chr(10) || role || chr(10) || 'Action:' || chr(10) || chr(10) || 'act' || chr(10) || 'Observation:'
  || chr(10) || chr(10) || text || chr(10), '' ORDER BY turn) AS trace, '<judgement>' || CASE WHEN conv_id % 2 = 1 THEN 'YES' ELSE 'NO' END || '</judgement>' AS target FROM conversations GROUP BY conv_id""")
def transcripts(v: Views):
    steps = v.table("conversations").select("conv_id", F.col("turn").alias("step_idx"), "role", "text")
    parts = (F.col("step_idx"), F.col("role"), F.lit("act"), F.col("text"))
    a = J.transcript(steps, "conv_id", J.verifier_step(*parts)).withColumnRenamed("transcript", "verifier")
    b = J.transcript(steps, "conv_id", J.reasoning_step(*parts)).withColumnRenamed("transcript", "trace")
    return a.join(b, "conv_id").withColumn("target", J.judgement(F.col("conv_id") % 2))


@query("s15_training_rows", """
SELECT CASE WHEN traj_id % 2 = 0 THEN '{"messages":["h' || traj_id || '"],"tools":["t"]}' ELSE '["h' || traj_id || '"]' END AS line, coalesce(reward = 1, false) AS solved FROM v_traj_head WHERE traj_id % 7 <> 0""")
def training_rows(v: Views):
    heads = v.traj_head().selectExpr("reward", "CASE WHEN traj_id % 7 <> 0 THEN array(concat('h', traj_id)) END AS history", "CASE WHEN traj_id % 2 = 0 THEN array('t') END AS tools")
    return J.training_rows(heads, "history", "tools")


@query("s16_submission", "SELECT 'img' || (traj_id % 5) AS instance_id, 'm1' AS model_name_or_path, output_patch AS model_patch FROM v_traj_head")
def submission(v: Views):
    heads = v.traj_head().select(F.expr("concat('reg.x.img', traj_id % 5)").alias("image"), "output_patch")
    return selection.submission(heads, "m1")


@query("t07_shuffled_examples", """
SELECT row_number() OVER (ORDER BY md5('s7' || doc_id), doc_id) AS place, doc_id, chr(10) || chr(10) || 'Example ' || row_number() OVER (ORDER BY md5('s7' || doc_id), doc_id) || ':' || chr(10) || chr(10) || '[ISSUE]' || chr(10) || text || chr(10) || '[/ISSUE]' || chr(10) AS example FROM documents""")
def shuffled_examples(v: Views):
    return J.shuffled_examples(v.table("documents"), "doc_id", "text", "s7")
