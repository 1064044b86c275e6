"""Plan tests: no Cartesian products / nested-loop joins and no Python evaluation in
native operators; filters and projections reach the Parquet scan."""
from __future__ import annotations

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NATIVE = ["clean_funnel", "keyed_dedup_first", "customer_pareto", "hourly_lag_roll", "hourly_decomposition",
          "top_ngrams", "tfidf_weights", "user_knn_recommendations", "near_duplicate_vectors",
          "association_rules", "roc_auc_exact", "recall_grid", "click_view_overlap", "flag_cooccurrence",
          "knn_segment_recommendation", "group_split", "text_message_features", "stream_hourly_alerts",
          "dbscan_customers", "adasyn_rows", "linear_models", "recommender_tuning_grid", "doc_polarity_in_context", "misclassified_documents"]
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NATIVE)
def test_no_cross_join_or_python(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert not [k for k in FORBIDDEN if k in plan], plan


def test_pushdown_and_pruning(spark):
    df = E.queries()["text_range_filter"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(text)" in plan and "In(lang" in plan
    assert "ReadSchema: struct<text:string,lang:string>" in plan or "ReadSchema: struct<lang:string,text:string>" in plan
