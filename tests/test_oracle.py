"""Registered queries against DuckDB.

By default one query per operator family runs; ``TASKCURATE_ALL=1`` runs all.
"""

import os

import pytest

from taskcurate import catalog

from . import oracle
from .conftest import SF_DIR

SAMPLE = (
    "c01_instance_table c02_judged_instances c03_evaluation_report c04_best_submission s03_tolerant_scan s11_replace_with_manifest "
    "f01_valid_pulls f10_small_commits f25_filter_funnel f27_bad_paths j01_combined j05_transitions j09_hunk_owners j10_touched_entities "
    "j14_expected_passed_reward j16_gated_prefix j19_file_recall j21_commit_pull a01_linked_issues a03_keep_or_reject "
    "a05_strict_quality_verdict a09b_distribution_rollup a11_box_figures a15_describe a22_run_report w03_best_by_both w04_running_success "
    "w06_longest_view_run w07_minimal_hunks w08b_assign_tests w12_condense_plan w14_line_numbers w15_entity_spans w16_keep_tests "
    "w18_sanitised_script t07_shuffled_examples u02_with_precedence x06_round_trip x16_failure_sections x18_actions x21_version_from_text "
    "r01_incremental_ingest d02_selector_by_name s08b_case_instances f25b_eight_step_funnel j11_match_tests j17b_test_targets x21b_version_from_files "
    "x26c_issue_requests w17_substantive r01b_ingest_any_age d05_results_of_logs x11_exit_code"
).split()
NAMES = sorted(catalog.registered()) if os.environ.get("TASKCURATE_ALL") else SAMPLE


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    ok, why = oracle.compare(catalog.registered()[name](spark, SF_DIR), con, catalog.oracles()[name])
    assert ok, why


def test_every_query_has_sql():
    assert set(catalog.registered()) == set(catalog.oracles())
