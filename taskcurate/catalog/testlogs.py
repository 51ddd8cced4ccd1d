"""Queries over test logs, outcomes and rewards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import logs as L
from ..operators import testlogs as T
from .registry import query
from .views import Views

_PIVOT = """p AS (SELECT instance, test_id, max(status) FILTER (phase = 'pre') AS pre, max(status) FILTER (phase = 'post') AS post FROM v_last_runs GROUP BY ALL),
  c AS (SELECT *, CASE WHEN pre <> 'PASSED' AND post = 'PASSED' THEN 'FAIL2PASS' WHEN pre = 'PASSED' AND post = 'PASSED' THEN 'PASS2PASS'
    WHEN pre <> 'PASSED' AND post <> 'PASSED' THEN 'FAIL2FAIL' ELSE 'PASS2FAIL' END AS transition FROM p)"""


@query("j05_transitions", f"WITH {_PIVOT} SELECT instance, test_id, transition FROM c")
def transitions(v: Views):
    return T.transitions(T.pre_post(v.test_runs())).select("instance", "test_id", "transition")


@query("j06_test_lists", f"""
WITH {_PIVOT} SELECT instance, CASE transition WHEN 'FAIL2PASS' THEN 'FAIL_TO_PASS' ELSE 'PASS_TO_PASS' END AS list, test_id FROM c WHERE transition IN ('FAIL2PASS', 'PASS2PASS')""")
def test_lists(v: Views):
    return T.test_lists(T.pre_post(v.test_runs()))


@query("a23_sorted_list_cells", f"""
WITH {_PIVOT} SELECT instance, coalesce(string_agg(test_id, ',' ORDER BY test_id) FILTER (transition = 'FAIL2PASS'), '') AS f2p,
  coalesce(string_agg(test_id, ',' ORDER BY test_id) FILTER (transition = 'PASS2PASS'), '') AS p2p FROM c WHERE transition IN ('FAIL2PASS', 'PASS2PASS') GROUP BY instance""")
def sorted_list_cells(v: Views):
    df = T.list_cells(T.test_lists(T.pre_post(v.test_runs())))
    return df.select("instance", F.array_join("FAIL_TO_PASS", ",").alias("f2p"), F.array_join("PASS_TO_PASS", ",").alias("p2p"))


@query("a21_score_against_lists", f"""
WITH {_PIVOT}, r AS (SELECT instance, test_id, pre AS status FROM p), l AS (SELECT instance, test_id, transition FROM c WHERE transition IN ('FAIL2PASS', 'PASS2PASS'))
SELECT r.instance, count(*) AS total_tests, count(*) FILTER (status = 'PASSED') AS total_passed, count(*) FILTER (transition = 'FAIL2PASS') AS f2p_total,
  count(*) FILTER (transition = 'FAIL2PASS' AND status = 'PASSED') AS f2p_passed, count(*) FILTER (transition = 'PASS2PASS') AS p2p_total,
  count(*) FILTER (transition = 'PASS2PASS' AND status = 'PASSED') AS p2p_passed FROM r LEFT JOIN l USING (instance, test_id) GROUP BY r.instance""")
def score_against_lists(v: Views):
    outcomes = T.pre_post(v.test_runs())
    return T.score_against_lists(outcomes.select("instance", "test_id", F.col("pre").alias("status")), T.test_lists(outcomes))


@query("a32_pass_counts", "SELECT instance, count(*) FILTER (status = 'PASSED') AS passed, count(*) AS tests FROM v_last_runs WHERE phase = 'post' GROUP BY instance")
def pass_counts(v: Views):
    return T.pass_counts(T.pre_post(v.test_runs()).select("instance", F.col("post").alias("status")), "instance")


@query("a34_outcome_counts", f"WITH {_PIVOT} SELECT transition, count(*) AS n FROM c GROUP BY transition")
def outcome_counts(v: Views):
    return T.outcome_counts(T.transitions(T.pre_post(v.test_runs())), "transition")


@query("a33_reproduction_scores", """
SELECT image, cand, coalesce(string_agg(s, ',' ORDER BY i), '') AS scores, coalesce(sum(s), 0)::BIGINT AS score
FROM (SELECT image, cand, i, CASE WHEN cand % 3 > 0 THEN (regression_pass + i) % 2 END AS s FROM v_cands, range(0, 3) r(i)) GROUP BY image, cand""")
def reproduction_scores(v: Views):
    c = v.cands()
    scores = c.filter("cand % 3 > 0").select("image", "cand", "regression_pass", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("test_idx"))
    scores = scores.withColumn("score", ((F.col("regression_pass") + F.col("test_idx")) % 2).cast("int"))
    df = T.reproduction_scores(c.select("image", "cand"), scores, ["image", "cand"])
    return df.select("image", "cand", F.array_join(F.col("scores").cast("array<string>"), ",").alias("scores"), F.col("score").cast("long").alias("score"))


@query("f24_failed_instances", f"""
WITH {_PIVOT}, w AS (SELECT instance, max(transition) FILTER (transition <> 'PASS2PASS') AS k FROM c GROUP BY instance)
SELECT instance, coalesce(k, 'unknown') AS classification FROM w WHERE coalesce(k, 'unknown') <> 'FAIL2PASS'""")
def failed_instances(v: Views):
    t = T.transitions(T.pre_post(v.test_runs()))
    worst = t.groupBy("instance").agg(F.max(F.when(F.col("transition") != "PASS2PASS", F.col("transition"))).alias("classification"))
    return T.failed_instances(worst)


@query("j13_exact_reward", f"""
WITH {_PIVOT}, o AS (SELECT instance, test_id, post AS s FROM p), e AS (SELECT instance, test_id, CASE WHEN instance % 3 = 0 THEN post ELSE pre END AS s FROM p WHERE NOT (instance % 5 = 0 AND contains(test_id, 't1.py')))
SELECT instance, CASE WHEN count(o.s) = count(e.s) AND bool_and(o.s IS NULL OR coalesce(o.s = e.s, false)) THEN 1.0 ELSE 0.0 END::DOUBLE AS reward
FROM o FULL JOIN e USING (instance, test_id) GROUP BY instance""")
def exact_reward(v: Views):
    p = T.pre_post(v.test_runs())
    seen = p.select("instance", F.concat(F.lit("\u001b[1m"), "test_id", F.lit("\u001b[0m - x")).alias("test_id"), F.col("post").alias("status"))
    want = p.filter("NOT (instance % 5 = 0 AND contains(test_id, 't1.py'))").selectExpr(
        "instance", "test_id", "CASE WHEN instance % 3 = 0 THEN post ELSE pre END AS status")
    return T.exact_reward(seen, want)


@query("j14_expected_passed_reward", f"""
WITH {_PIVOT}, o AS (SELECT instance, CASE WHEN instance % 2 = 0 THEN 'p[' || test_id || ']' ELSE test_id END AS test_id, test_id AS e, post AS s FROM p),
  e AS (SELECT instance, test_id FROM p WHERE contains(test_id, 't1.py')),
  m AS (SELECT e.instance, e.test_id, arg_min(o.s, o.test_id) AS s FROM e JOIN o ON o.instance = e.instance AND contains(o.test_id, e.test_id)
        AND (o.test_id = e.test_id OR NOT EXISTS (SELECT 1 FROM o x WHERE x.instance = e.instance AND x.test_id = e.test_id)) GROUP BY ALL)
SELECT a.instance, CASE WHEN coalesce(bool_and(m.s = 'PASSED'), true) THEN 1.0 ELSE 0.0 END::DOUBLE AS reward
FROM (SELECT DISTINCT instance FROM p) a LEFT JOIN m USING (instance) GROUP BY a.instance""")
def expected_passed_reward(v: Views):
    p = T.pre_post(v.test_runs())
    name = F.when(F.col("instance") % 2 == 0, F.concat(F.lit("p["), "test_id", F.lit("]"))).otherwise(F.col("test_id"))
    seen = p.select("instance", name.alias("test_id"), F.col("post").alias("status"), name.alias("at"))
    return T.expected_passed_reward(seen, p.filter("contains(test_id, 't1.py')").select("instance", "test_id"))


@query("j14b_reward_by_dotted_names", f"""
WITH {_PIVOT} SELECT instance, CASE WHEN coalesce(bool_and(post = 'PASSED') FILTER (contains(test_id, 't1.py')), true) AND bool_and(post = 'PASSED' OR NOT contains(test_id, 't1.py') OR post IS NOT NULL) THEN 1.0 ELSE 0.0 END::DOUBLE AS reward FROM p GROUP BY instance""")
def reward_by_dotted_names(v: Views):
    p = T.pre_post(v.test_runs())
    seen = p.select("instance", F.replace("test_id", F.lit("::"), F.lit(".")).alias("test_id"), F.col("post").alias("status"), F.col("test_id").alias("at"))
    wanted = p.filter("contains(test_id, 't1.py')").select("instance", L.dotted_name(F.concat(F.lit("pkg::"), "test_id")).alias("test_id"))
    return T.expected_passed_reward(seen, wanted)


@query("j15_exit_code_reward", """
SELECT l_orderkey AS instance, pos, CASE WHEN l_tax > 0.02 THEN cast(l_quantity AS int) % 2 END::BIGINT AS code,
  CASE WHEN l_tax > 0.02 AND cast(l_quantity AS int) % 2 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS reward FROM v_items""")
def exit_code_reward(v: Views):
    return v.logs().select("instance", "pos", L.exit_code(F.col("log")).alias("code"), L.exit_code_reward(F.col("log")).alias("reward"))


@query("x12_classify_exit_codes", """
WITH e AS (SELECT l_orderkey AS instance, pos, CASE WHEN l_tax > 0.02 THEN cast(l_quantity AS int) % 2 END AS pre, l_suppkey % 2 AS post FROM v_items)
SELECT instance, pos, CASE WHEN pre IS NULL THEN 'ERROR' WHEN pre <> 0 AND post = 0 THEN 'FAIL2PASS' WHEN pre = 0 AND post = 0 THEN 'PASS2PASS' WHEN pre <> 0 THEN 'FAIL2FAIL' ELSE 'PASS2FAIL' END AS classification FROM e""")
def classify_exit_codes(v: Views):
    df = v.logs().join(v.items().selectExpr("l_orderkey AS instance", "pos", "l_suppkey % 2 AS post"), ["instance", "pos"])
    return df.select("instance", "pos", L.classify_exit_codes(L.exit_code(F.col("log")), F.col("post")).alias("classification"))


@query("j25_salvage", f"""
WITH {_PIVOT}, k AS (SELECT *, split_part(test_id, '::', 1) AS path FROM c WHERE instance IN (SELECT instance FROM c WHERE transition = 'FAIL2PASS')),
  f AS (SELECT DISTINCT instance, 'tests/t' || i || '.py' AS path FROM k, range(0, 6) r(i))
SELECT DISTINCT instance, path, split_part(test_id, '::', 2) AS test_name FROM k WHERE transition IN ('FAIL2PASS', 'PASS2PASS')
UNION ALL SELECT instance, path, NULL FROM f WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.instance = f.instance AND k.path = f.path)""")
def salvage(v: Views):
    outcomes = T.pre_post(v.test_runs())
    files = outcomes.select("instance").distinct().select("instance", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("i"))
    return T.salvage(outcomes, files.select("instance", F.concat(F.lit("tests/t"), F.col("i").cast("string"), F.lit(".py")).alias("path")))


@query("x13_verbose_results", """
SELECT instance, pos, test_id, arg_max(status, i) AS status FROM v_log_lines WHERE status IN ('PASSED', 'FAILED') GROUP BY ALL""")
def verbose_results(v: Views):
    return T.results_table(v.logs(), ["instance", "pos"], L.verbose_results)


@query("x13b_full_results", "SELECT instance, pos, test_id, arg_max(status, i) AS status FROM v_log_lines GROUP BY ALL")
def full_results(v: Views):
    return T.results_table(v.logs(), ["instance", "pos"], L.full_results)


@query("x13c_results_with_summary", """
WITH a AS (SELECT instance, pos, test_id, status, i FROM v_log_lines WHERE status IN ('PASSED', 'FAILED')
  UNION ALL SELECT l_orderkey, pos, 'tests/t' || l_partkey % 3 || '.py::K::test_' || l_suppkey % 4, 'FAILED', 1000 FROM v_items)
SELECT instance, pos, test_id, arg_max(status, i) AS status FROM a GROUP BY ALL""")
def results_with_summary(v: Views):
    return T.results_table(v.logs(), ["instance", "pos"], L.results_with_summary)


@query("x14_short_summary_results", """
SELECT l_orderkey AS instance, pos, unnest(['K.test_' || l_suppkey % 4, 'test_ok', 'test_' || l_suppkey % 3]) AS test_id, unnest(['FAILED', 'PASSED', 'ERROR']) AS status FROM v_items""")
def short_summary_results(v: Views):
    return T.results_table(v.logs(), ["instance", "pos"], L.parser_for("numpy"))


@query("x15_without_colour", """
SELECT event_id, event_type || ' done' AS clean, event_type AS key FROM events""")
def without_colour(v: Views):
    text = F.concat(F.lit("\u001b[1;31m"), "event_type", F.lit("\u001b[0m done\r"))
    keyed = L.colourless_keys(F.create_map(F.concat(F.lit("\u001b[31m"), "event_type", F.lit("\u001b[0m")), F.lit(1)))
    return v.table("events").select("event_id", L.without_control(text).alias("clean"), F.element_at(F.map_keys(keyed), 1).alias("key"))


@query("x16_failure_sections", """
SELECT l_orderkey AS instance, pos, unnest(['test_a' || l_suppkey % 5, 'test_b', 'test_c']) AS test, unnest(['setup' || chr(10) || 'line', 'E   boom', 'E   bang']) AS body FROM v_items""")
def failure_sections(v: Views):
    log = F.expr("""concat('head\\n==== ERRORS ====\\n____ ERROR at setup of test_a', l_suppkey % 5, '[p0] ____\\nsetup\\nline\\n',
        '==== FAILURES ====\\n____ test_b[1] ____\\n\\nE   boom\\n____ test_c ____\\nE   bang\\n====== warnings summary =========\\nw')""")
    rows = v.spread(v.items().select("l_orderkey", "pos", "l_suppkey"), "l_orderkey", "pos")
    return rows.select(F.col("l_orderkey").alias("instance"), "pos", F.inline(L.failure_sections(log)))


@query("f15_infra_failure", """
SELECT doc_id, lang = 'en' OR contains(lower(text), 'pytest') OR contains(lower(text), 'docker') OR contains(lower(text), 'dependency') OR contains(lower(text), 'environment')
  OR contains(lower(text), '.venv') OR contains(lower(text), 'importerror') OR source = 'src1' AS infra FROM documents""")
def infra_failure(v: Views):
    cls = F.when(F.col("lang") == "en", F.lit("FAIL2FAIL"))
    hint = F.when(F.col("source") == "src1", F.lit("Run PIP install first")).otherwise(F.lit(""))
    return v.table("documents").select("doc_id", L.infra_failure(cls, F.col("text"), hint).alias("infra"))


@query("f16_import_error", """
SELECT doc_id, source = 'src1' OR coalesce(list_bool_or(list_transform(string_split(lower(text), chr(10)), lambda l: (contains(l, 'attribute') OR contains(l, 'import')) AND (contains(l, 'error') OR contains(l, 'fail')))), false) AS hit FROM documents""")
def import_error(v: Views):
    log = F.concat(F.col("text"), F.when(F.col("source") == "src1", F.lit("\nE ImportError: no x")).otherwise(F.lit("\nimport ok\nfailed")))
    return v.table("documents").select("doc_id", L.import_error(log).alias("hit"))


@query("u06_listed_test_files", f"""
WITH {_PIVOT} SELECT DISTINCT instance, split_part(test_id, '::', 1) AS path FROM c WHERE transition IN ('FAIL2PASS', 'PASS2PASS')""")
def listed_test_files(v: Views):
    return T.listed_test_files(T.test_lists(T.pre_post(v.test_runs())))


@query("u06b_test_selectors", """
WITH t AS (SELECT l_orderkey AS instance, l_partkey % 4 AS k, l_suppkey % 3 AS r FROM lineitem)
SELECT DISTINCT instance, CASE r WHEN 0 THEN 'a' || k || '.ts' WHEN 1 THEN 'T' || k ELSE 'x/u' || k || '.test.js' END AS selector FROM t
UNION SELECT instance, 'ConfigTestCases' FROM t WHERE r = 2 AND k = 1""")
def test_selectors(v: Views):
    tests = v.table("lineitem").selectExpr(
        "l_orderkey AS instance", "CASE l_suppkey % 3 WHEN 0 THEN 'ms/TypeScript' WHEN 1 THEN 'google/gson' ELSE 'webpack/webpack' END AS repo",
        """inline(array(named_struct('path', CASE l_suppkey % 3 WHEN 0 THEN concat('a', l_partkey % 4, '.ts') WHEN 1 THEN concat('s/T', l_partkey % 4, '.java')
             ELSE concat('x/u', l_partkey % 4, '.test.js') END),
           named_struct('path', CASE WHEN l_suppkey % 3 = 2 AND l_partkey % 4 = 1 THEN 'test/configCases/a' ELSE 'README' END)))""")
    return T.test_selectors(tests)
