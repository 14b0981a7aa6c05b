"""Plan checks over the registered queries: no cartesian products or nested
loop joins, no Python UDF nodes, pruned scans."""

import pytest

import __spark_entry__ as E

HEAVY = {"train_eval", "score_batch", "score_tables", "backend_equivalence", "model_tables", "missing_artifacts",
         "quantized_equivalence", "stream_score", "stream_quarantine", "stream_metrics", "stream_rates", "end_to_end_job",
         "scan_documents", "land_documents", "fit_thresholds"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(k for k in E.queries() if k not in HEAVY))
def test_plan_shape(spark, sf001, name):
    df = E.queries()[name](spark, sf001)
    plan = _plan(df)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_is_pruned_and_filter_pushed(spark, sf001):
    from pyspark.sql import functions as F

    from prioritext.sources import tables as tb

    df = tb.read_table(spark, sf001, "events").filter(F.col("event_type") == "click").select("event_id")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in text
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in text


def test_feature_aggregation_reuses_document_partitioning(spark, sf001):
    from prioritext.operators import features as fe
    from prioritext.sources import tables as tb

    docs = tb.read_table(spark, sf001, "documents").select("doc_id", "text")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = fe.doc_term_counts(docs, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # one exchange: the hash repartition by id; the (id, term) aggregate reuses it
    assert plan.count("Exchange") == 1
