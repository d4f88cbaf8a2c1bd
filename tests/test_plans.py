"""Physical-plan properties the design relies on."""

import pytest

from murmur.plans.catalog import QUERIES
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cartesian_or_nested_loop_join(spark, key):
    p = plan(QUERIES[key](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_pending_curation_is_an_anti_join(spark):
    assert "LeftAnti" in plan(QUERIES["pending_curation"](spark, SF_SMALL))


def test_latest_run_uses_partial_window_group_limit(spark):
    p = plan(QUERIES["comment_insights_report"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_report_does_not_run_language_model(spark):
    o = optimized(QUERIES["comment_insights_report"](spark, SF_SMALL))
    assert "documents" not in o


def test_language_is_scored_where_the_rows_lie(spark):
    """No join, no broadcast of grams, no exchange but the spreading of the one-row-group file; the
    scoring goes when the language is not selected."""
    scored = QUERIES["language_id"](spark, SF_SMALL)
    p = plan(scored)
    assert "Join" not in p and "Broadcast" not in p and p.count("ArrowEvalPython") == 2
    assert p.count("Exchange") == 1 and "RoundRobinPartitioning" in p
    assert plan(scored.select("doc_id", "lang")).count("ArrowEvalPython") == 0
    assert "Join" not in plan(QUERIES["curate_comments"](spark, SF_SMALL))


def test_no_exchange_where_the_table_has_files_enough(spark, scratch):
    from murmur.sources import fixtures as fx
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(8).write.parquet(f"{scratch}/documents.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert "Exchange" not in plan(fx.documents(spark, scratch))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_curation_has_one_python_udf_node(spark):
    p = plan(QUERIES["curate_dedup"](spark, SF_SMALL).select("text_clean"))
    assert p.count("ArrowEvalPython") == 1
    assert "BatchEvalPython" not in p


def test_filters_and_columns_reach_the_scan(spark):
    from murmur.operators import annotate
    from murmur.sources import fixtures as fx
    df = annotate.pending_inference(fx.curated(spark, SF_SMALL), fx.insights(spark, SF_SMALL), "m0")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<conv_id:bigint,turn:bigint,role:string,text:string>" in p or "conv_id" in p
    assert "value" not in [f.name for f in df.schema.fields]
