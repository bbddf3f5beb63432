"""Registered queries against their SQL on the smallest tables. ALL_QUERIES=1 runs every one of them."""

import os

import pytest

import __spark_entry__ as entry
from tools.oracle_check import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
CHOSEN = ["a01_numeric_profile", "a02_categorical_profile", "a06_dropped_features", "a09_drift_psi", "a10_drift_ks",
          "b00_multiclass_metrics", "c00_binary_metrics", "c00_binary_metrics_tied", "d02_confidence_regression",
          "d03_confidence_classification", "f04_text_tfidf", "f07_tenc", "f11_select_features", "g01_optimal_threshold",
          "j02_join_logged_by_position", "j06_truth_semi_anti", "l01_best_model", "l04_version_lineage", "m08_nbc",
          "m09_blend", "n01_node_properties", "p06_contract_report", "p07_type_policy", "r00_regression_metrics",
          "t02_derivation_lags", "t03_derivation_aggs", "t05_attach_apriori", "u02_calinski_harabaz", "w03_stream_usage",
          "w05_resource_status", "x05_search_brute_force", "x06_search_cluster_pruning"]


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_contract(spark):
    assert set(ORACLES) <= set(QUERIES)
    assert set(CHOSEN) <= set(ORACLES)
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES) if os.environ.get("ALL_QUERIES") else CHOSEN)
def test_query_matches_sql(spark, con, small, key):
    ok, note = compare(spark, con, key, QUERIES[key], ORACLES.get(key), small)
    assert ok, note
