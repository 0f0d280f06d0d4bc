"""Physical-plan properties that matter at scale."""

import re

import pytest

from basketlens.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = QUERIES[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["churn_trend", "churn_trend_asof", "return_windows", "cohort_retention_long",
                                  "negative_review_themes", "top_customers", "rfm_segmentation"])
def test_no_product_joins(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_top_customers_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top_customers")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_row_at_a_time_python(spark, name):
    if name in ("read_raw", "write_table"):
        pytest.skip("file round trip")
    assert "BatchEvalPython" not in plan(spark, name)


def test_text_jobs_stay_in_the_jvm(spark):
    for name in ("lexicon_polarity", "label_reviews"):
        p = plan(spark, name)
        assert "ArrowEvalPython" not in p and "PythonUDF" not in p


@pytest.mark.parametrize("name", ["lexicon_polarity", "label_reviews", "customer_sentiment_rfm", "negative_review_themes"])
def test_texts_are_read_once_and_never_shuffled(spark, name):
    """One scan reads the texts; no exchange has a text column."""
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    p = QUERIES[name](spark, SF)._jdf.queryExecution().explainString(mode)
    scans = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", p) if re.search(r"\btext:string", s)]
    assert len(scans) == 1
    exchanged = re.findall(r"\) (?:Broadcast)?Exchange\nInput \[\d+\]: \[([^\]]*)\]", p)
    assert exchanged and not any(re.search(r"\b(text|review_comment_message|_toks)#", e) for e in exchanged)


def test_scans_are_pruned(spark):
    p = plan(spark, "monthly_revenue")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    li = [s for s in schemas if "l_extendedprice" in s]
    assert li and all("l_comment" not in s and "l_shipdate" not in s for s in li)


def test_quintiles_move_no_rows(spark):
    """Scores compare rows with the selected pairs: no window, no range shuffle, no join of the ranks."""
    p = plan(spark, "quintile_qcut")
    assert "Window" not in p and "rangepartitioning" not in p and "Join" not in p and "Exchange" not in p


def test_orders_stored_by_person_are_not_shuffled(spark):
    for name in ("customer_metrics_stored", "return_windows_stored"):
        assert "hashpartitioning(customer_unique_id" not in plan(spark, name)
    assert "hashpartitioning(customer_unique_id" in plan(spark, "customer_metrics")


def test_key_audit_reads_each_table_once(spark):
    p = plan(spark, "key_audit")
    for column in ("l_linenumber", "p_partkey"):
        assert len([s for s in re.findall(r"ReadSchema: struct<([^>]*)>", p) if column in s]) == 1
