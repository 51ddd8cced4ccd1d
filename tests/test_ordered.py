"""Running aggregates, ranks and percentiles against brute force, with and without heavy keys."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from taskcurate.operators import ordered as O
from taskcurate.operators import selection

ROWS = [("hot" if i % 3 == 0 else f"k{i % 7}", i, random.Random(i).randint(-50, 50)) for i in range(300)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "k string, t long, v long").repartition(4)


def brute(exclusive):
    out = {}
    for k in {r[0] for r in ROWS}:
        rows = sorted((r for r in ROWS if r[0] == k), key=lambda r: r[1])
        for i, r in enumerate(rows):
            part = [x[2] for x in (rows[:i] if exclusive else rows[: i + 1])]
            out[(k, r[1])] = (sum(part), max(part, default=None), min(part, default=None))
    return out


@pytest.mark.parametrize("exclusive", [True, False])
@pytest.mark.parametrize("levels", [(16,), (64, 16), (128, 32, 4)])
def test_running(df, exclusive, levels):
    got = O.running(
        df, ["k"], [F.col("t")], [F.floor(F.col("t") / n) for n in levels], exclusive=exclusive,
        s=("sum", F.col("v")), hi=("max", F.col("v")), lo=("min", F.col("v")),
    )
    assert {(r.k, r.t): (r.s, r.hi, r.lo) for r in got.collect()} == brute(exclusive)


def test_numbered_without_keys(df):
    got = O.numbered(df, [], [F.col("t")], O.id_blocks(F.col("t"), 3, 6), "n").collect()
    assert {r.t: r.n for r in got} == {i: i + 1 for i in range(300)}


ODD = st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True), st.sampled_from([0.0, 0.25, 0.5, 0.999, 1e-300, 1.7e9, 1.7e9 + 1, -3.0]))
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def rising(x):
    """Spark's rising order: null, numbers, NaN."""
    return (x is not None, x is not None and x != x, 0.0 if x is None or x != x else x)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), ODD), min_size=1, max_size=40))
def test_ranks_with_nulls_and_nan(spark, rows):
    from taskcurate.operators import reports

    rows = [(k, i, v) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k string, i long, v double")
    got = {r.i: r.place for r in reports.ranked_by_size(df, "k", "v", "i").collect()}
    want, best = {}, set()
    for k in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == k), key=lambda r: (rising(r[2]), r[1]))
        want |= {r[1]: n + 1 for n, r in enumerate(group)}
        falling = sorted(sorted(group, key=lambda r: r[1]), key=lambda r: rising(r[2]), reverse=True)
        best |= {r[1] for r in falling[: max(1, len(group) // 2)]}
    assert got == want
    top = O.top_rows(df, ["k"], "v", "i", F.floor(F.col("i") / 4), lambda n: F.greatest(F.lit(1), F.floor(n / 2)))
    assert {r.i for r in top.collect()} == best


def test_only_large_groups_are_cut_into_blocks(spark, monkeypatch):
    """Small groups are ranked by one window, whatever their size the rows are the same; null keys are a group."""
    r = random.Random(12)
    rows = [(k, i, r.choice((None, 0.5, float("nan"), float(r.randrange(9))))) for i, k in enumerate(r.choices(["a", "b", "c", None], [9, 3, 1, 2], k=90))]
    want = set()
    for k in {x[0] for x in rows}:
        group = sorted(sorted((x for x in rows if x[0] == k), key=lambda x: x[1]), key=lambda x: rising(x[2]), reverse=True)
        want |= {x[1] for x in group[: max(1, len(group) // 2)]}
    df = spark.createDataFrame(rows, "k string, i long, v double")
    for whole in (4096, 20, 0):
        monkeypatch.setattr(O, "WHOLE", whole)
        top = O.top_rows(df, ["k"], "v", "i", F.floor(F.col("i") / 4), lambda n: F.greatest(F.lit(1), F.floor(n / 2)))
        assert top.columns == df.columns and {x.i for x in top.collect()} == want
        if whole == 4096:
            ran = top._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            assert ran.count("Exchange hashpartitioning") <= 3


@pytest.mark.parametrize("offset", [0.0, 1.7e9])
def test_percentiles(spark, offset):
    probs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    rows = [(k, t, None if t % 11 == 3 else float(v) + offset) for k, t, v in ROWS]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    for keys in (["k"], []):
        for r in O.exact_percentiles(df, keys, "v", probs, moments=True).collect():
            vals = [x[2] for x in rows if x[2] is not None and (not keys or x[0] == r.k)]
            assert r.n == len(vals) and r.mean == pytest.approx(np.mean(vals)) and r["std"] == pytest.approx(np.std(vals, ddof=1))
            for n, p in probs.items():
                assert r[n] == pytest.approx(np.quantile(vals, p))


def test_percentiles_with_nan_and_infinity(spark):
    vals = [float("-inf"), 1.0, 2.0, float("inf"), float("nan")]
    r = O.exact_percentiles(spark.createDataFrame([(v,) for v in vals], "v double"), [], "v", {"lo": 0.0, "mid": 0.5, "hi": 1.0}).first()
    assert (r.n, r.lo, r.mid) == (5, float("-inf"), 2.0) and r.hi != r.hi


@SETTINGS
@given(st.lists(ODD, min_size=2, max_size=30))
def test_log_bucket_keeps_order(spark, values):
    got = spark.createDataFrame([(v,) for v in values], "v double").withColumn("b", O.log_bucket(F.col("v"))).collect()
    for a in got:
        for b in got:
            assert not (rising(a.v) < rising(b.v) and a.b > b.b)


def test_single_candidate_is_kept(spark):
    df = spark.createDataFrame([("i", 1, 0.2, 0, 0)], "image string, cand long, verifier_prob double, regression_pass int, reproduction_score int")
    assert selection.select_best(df, "hybrid").count() == 1
    with pytest.raises(ValueError):
        selection.select_best(df, "other")


def test_keep_first_and_last(df):
    first = {r.k: r.t for r in O.keep_first(df, ["k"], [F.col("t")]).collect()}
    last = {r.k: r.t for r in O.keep_last(df, ["k"], [F.col("t")]).collect()}
    assert first["hot"] == 0 and last["hot"] == 297


def test_longest_view_run(spark):
    from taskcurate.operators import trajectories as J

    view = "<function=file_editor><parameter=command>view</parameter><parameter=path>%s</parameter></function>"
    plan = {1: "aaxaab", 2: "x", 3: "abab", 4: "bbb"}
    rows = [(k, i, view % f"{c}.py" if c != "x" else "<function=execute_bash></function>") for k, cs in plan.items() for i, c in enumerate(cs)]
    steps = J.with_actions(spark.createDataFrame(rows, "run int, step_idx int, action string"))
    got = {r.run: r.longest for r in J.longest_view_run(steps, "run").collect()}
    assert got == {1: 2, 2: 0, 3: 1, 4: 3}


def test_running_xor_matches_a_plain_fold(spark):
    rows = [(k, i, (i * 2654435761 + k * 97) % (1 << 40)) for k in (0, 1) for i in range(0, 9000, 7)]
    df = spark.createDataFrame(rows, "k int, i long, v long")
    out = O.running(df, ["k"], [F.col("i")], O.id_blocks(F.col("i")), x=("xor", F.col("v")))
    want, now = {}, {}
    for k, i, v in rows:
        now[k] = now.get(k, 0) ^ v
        want[k, i] = now[k]
    assert {(r.k, r.i): r.x for r in out.collect()} == want
