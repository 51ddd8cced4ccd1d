"""What physical plans may and may not hold."""

import re

import pytest

from taskcurate import catalog
from taskcurate.catalog.views import Views
from taskcurate.operators import instances, selection, votes

from .conftest import SF_DIR

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
# these write files or run a stream while the query is built
EAGER = tuple(n for n in catalog.registered() if n[0] in "sr")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.registered()) - set(EAGER)))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(catalog.registered()[name](spark, SF_DIR))
    assert not [f for f in FORBIDDEN if f in text]


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(instances.before_cutoff(Views(spark, SF_DIR).pulls(), catalog.views.F.expr("TIMESTAMP_NTZ '1997-01-01 00:00:00'")).select("number"))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in text
    assert "o_totalprice" not in text


def test_grouped_selection_needs_one_shuffle(spark):
    v = Views(spark, SF_DIR)
    assert plan(selection.by_model(v.cands())).count("Exchange hashpartitioning") == 1
    assert plan(votes.keep_or_reject(v.votes())).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", "a02_patch_stats a07b_edited_lines_switches f25_filter_funnel w07_minimal_hunks x06_round_trip x07_code_test_split".split())
def test_patches_are_not_cut_into_lines(spark, name):
    """Cells are made without lambdas and read by file or hunk: no array of lines, no fold over them."""
    made = Views(spark, SF_DIR).patches()._jdf.queryExecution().optimizedPlan().toString()
    read = catalog.registered()[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in made
    assert ", \n, -1)" not in read and "aggregate(split" not in read


def test_sources_are_cut_into_lines_where_they_are(spark):
    """Spans of a source are found once, and files are dealt before they become lines."""
    requests = catalog.registered()["x26c_issue_requests"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert requests.count("Generate posexplode(arrays_zip(") == 1
    spans = plan(catalog.registered()["w15_entity_spans"](spark, SF_DIR))
    assert spans.count("Exchange") == 1 and "REPARTITION_BY_NUM" in spans


@pytest.mark.parametrize("name,reads", [("w08b_assign_tests", 2), ("w08c_sub_instances", 4)])
def test_sub_instances_read_their_files_once(spark, name, reads):
    """Code and test files of a commit meet once: the window over its files is not made again for each rule."""
    text = catalog.registered()[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation [") <= reads


def test_patches_are_measured_where_they_are(spark):
    """Only the size of a patch is joined, not its text."""
    text = catalog.registered()["t02_ranked_by_size"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in text and not re.search(r"Join [^\n]*\n[ :+-]*Generate explode\(array\(patch", text)


def test_scores_meet_their_lists_in_one_group(spark):
    text = catalog.registered()["a21_score_against_lists"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text and text.count("Relation [") == 2


def test_logs_are_read_once_for_a_report(spark):
    """One pass makes the scores, one the lists; ids come without the logs."""
    text = catalog.registered()["c03_evaluation_report"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Generate explode(array(log#") == 2


def test_code_parts_are_made_once(spark):
    """Only candidates are cut into code and tests, and once: not in a filter below their join too."""
    text = catalog.registered()["c02_judged_instances"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"lambdafunction\(NOT RLIKE\(lower\(substring_index", text)) == 1 and "forall" not in text
