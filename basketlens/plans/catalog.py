"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the generated test tables through the adapter and runs
over whole tables and whole texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.functions.lexicon import DEMO_BOOSTERS, DEMO_NEGATORS, DEMO_THEMES, lexicon_frame
from basketlens.operators import (audit, churn, clean, cohorts, facts, ranking, revenue, rfm,
                                 sentiment, themes)
from basketlens.plans import extracts
from basketlens.plans.model import Model
from basketlens.schemas import RAW_ORDER_ITEMS, RAW_REVIEWS
from basketlens.session import ensure_checkpoint_dir
from basketlens.sources import files
from basketlens.sources import testdata as td

Query = Callable[[SparkSession, str], DataFrame]


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp dir)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ---------- I. ingest and modelling ----------

def q_read_raw(spark, d):
    r = td.raw_reviews(spark, d)
    out = _scratch(spark, "raw-reviews-csv")
    (r.select(F.col("review_id").cast("string"), F.col("order_id").cast("string"), "review_score",
              F.lit(None).cast("string").alias("review_comment_title"), "review_comment_message",
              F.lit(None).cast("timestamp_ntz").alias("review_creation_date"),
              F.lit(None).cast("timestamp_ntz").alias("review_answer_timestamp"))
     .write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(out))
    return files.read_raw(spark, out, RAW_REVIEWS, multi_line=True)


def q_split_raw(spark, d):
    """I1 with rejects: the items as raw lines, every price over 50 000 spelled out, every order line 7 cut short."""
    items = td.raw_order_items(spark, d)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("order_id", "order_item_id", "product_id", "seller_id")]
    price = F.when(F.col("price") > 50_000, F.lit("much")).otherwise(F.col("price").cast("string"))
    line = F.when(F.col("order_item_id") == 7, F.concat_ws(",", *fields)).otherwise(
        F.concat_ws(",", *fields, F.lit(""), price, F.col("freight_value").cast("string")))
    out = _scratch(spark, "raw-items-csv")
    # every file gets its header
    (items.select(line.alias(",".join(f.name for f in RAW_ORDER_ITEMS.fields)))
     .write.option("header", True).option("quote", "").option("sep", "\t").csv(out))
    good, rejects = files.split_raw(spark, out, RAW_ORDER_ITEMS, _scratch(spark, "items-split"))
    return (good.agg(F.lit("good").alias("kind"), F.count(F.lit(1)).alias("row_count"), F.sum("price").cast("decimal(28,2)").alias("price"))
            .unionByName(rejects.groupBy(F.when(F.try_element_at(F.split("line", ","), F.lit(6)) == "much", F.lit("spelled out"))
                                         .otherwise(F.lit("cut short")).alias("kind"))
                         .agg(F.count(F.lit(1)).alias("row_count"), F.lit(None).cast("decimal(28,2)").alias("price"))))


def q_write_table(spark, d):
    m = Model.from_testdata(spark, d)
    out = _scratch(spark, "orders-parquet")
    files.write_table(m.orders, out, partition_by=["order_month"])
    back = spark.read.parquet(out)
    return back.select(*m.orders.columns)


def q_write_extract(spark, d):
    months = revenue.monthly_revenue(Model.from_testdata(spark, d).orders)
    out = _scratch(spark, "months-csv")
    files.write_extract(months, out, single_file=True)
    return spark.read.schema(months.schema).option("header", True).csv(out)


def q_standardize_customers(spark, d):
    return Model.from_testdata(spark, d).customers


def q_reviews_with_customer(spark, d):
    m = Model.from_testdata(spark, d)
    return facts.reviews_with_customer(m.raw_reviews, m.orders)


def q_products_clean(spark, d):
    return Model.from_testdata(spark, d).products


def _modelled_tables(spark, d) -> dict[str, DataFrame]:
    m = Model.from_testdata(spark, d)
    orders_sql = clean.orders_clean(m.raw_orders, m.customers, m.raw_items, how="inner")
    return {
        "customers": clean.customers_dim(m.customers, m.raw_orders),
        "products": clean.products_clean(m.raw_products, m.raw_translations, flavour="sql"),
        "orders": orders_sql,
        "order_items": clean.items_valid(m.raw_items, orders_sql, m.products),
        "order_reviews": clean.reviews_dedup(m.raw_reviews, orders_sql),
    }


def q_row_counts(spark, d):
    return audit.row_counts(_modelled_tables(spark, d))


def q_row_counts_written(spark, d):
    """I5 while the tables are written: counts observed by the writing jobs."""
    counts = files.write_observed(_modelled_tables(spark, d), _scratch(spark, "modelled"))
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")


def q_key_audit(spark, d):
    m = Model.from_testdata(spark, d)
    return audit.key_audit(m.raw_customers, m.raw_orders, m.raw_items, m.raw_products, m.raw_reviews)


def q_order_financials(spark, d):
    return clean.order_financials(td.raw_order_items(spark, d))


def q_orders_clean(spark, d):
    return Model.from_testdata(spark, d).orders


def q_orders_clean_inner(spark, d):
    m = Model.from_testdata(spark, d)
    return clean.orders_clean(m.raw_orders, m.customers, m.raw_items, how="inner")


def q_customers_clean(spark, d):
    return Model.from_testdata(spark, d).customers_clean


def q_customers_dim(spark, d):
    m = Model.from_testdata(spark, d)
    return clean.customers_dim(m.customers, m.raw_orders)


def q_sales_fact(spark, d):
    return Model.from_testdata(spark, d).sales_fact


def q_items_valid(spark, d):
    m = Model.from_testdata(spark, d)
    return clean.items_valid(m.raw_items, m.raw_orders, m.raw_products)


def q_reviews_dedup(spark, d):
    return clean.reviews_dedup(td.raw_reviews_repeated(spark, d), td.raw_orders(spark, d))


def q_customer_order_summary(spark, d):
    m = Model.from_testdata(spark, d)
    return facts.customer_order_summary(m.persons, m.orders)


# ---------- R. RFM ----------

def q_customer_metrics(spark, d):
    return rfm.customer_metrics(Model.from_testdata(spark, d).orders)


def _stored_by_person(spark, d) -> Model:
    name = f"orders_by_person_{uuid.uuid4().hex}"
    return Model.from_testdata(spark, d).with_stored_orders(name, _scratch(spark, name), buckets=8)


def q_customer_metrics_stored(spark, d):
    """R1 over orders stored by person."""
    return rfm.customer_metrics(_stored_by_person(spark, d).orders)


def q_return_windows_stored(spark, d):
    """V2 over orders stored by person."""
    return revenue.return_windows(_stored_by_person(spark, d).orders)


def q_quintile_qcut(spark, d):
    mm = rfm.customer_metrics(Model.from_testdata(spark, d).orders)
    s = ranking.quantile_scores(mm, rfm._rfm_specs(), "customer_unique_id", method="qcut")
    return s.select("customer_unique_id", "recency_score", "frequency_score", "monetary_score")


def q_quintile_ntile(spark, d):
    m = Model.from_testdata(spark, d)
    mm = rfm.customer_metrics_sql(m.orders, m.persons)
    s = ranking.quantile_scores(mm, rfm._rfm_specs(), "customer_unique_id", method="ntile")
    return s.select("customer_unique_id", "recency_score", "frequency_score", "monetary_score")


def q_score_and_tier(spark, d):
    return Model.from_testdata(spark, d).rfm.select("customer_unique_id", "rfm_score", "value_tier")


def q_rfm_segmentation(spark, d):
    return Model.from_testdata(spark, d).rfm


def q_rfm_segmentation_ntile(spark, d):
    m = Model.from_testdata(spark, d)
    return rfm.rfm_segmentation_ntile(m.orders, m.persons)


def q_segment_summary(spark, d):
    return rfm.segment_summary(Model.from_testdata(spark, d).rfm)


def q_fixed_threshold_segments(spark, d):
    m = Model.from_testdata(spark, d)
    return rfm.fixed_threshold_segments(m.orders, m.persons)


# ---------- C. cohorts ----------

def q_cohort_assign(spark, d):
    return cohorts.cohort_assign(Model.from_testdata(spark, d).orders)


def q_retention_trend(spark, d):
    return cohorts.retention_trend(Model.from_testdata(spark, d).orders, offset=1)


def q_cohort_retention_long(spark, d):
    return cohorts.cohort_retention_long(Model.from_testdata(spark, d).orders)


def q_cohort_retention_sql(spark, d):
    return cohorts.cohort_retention_sql(Model.from_testdata(spark, d).orders)


def q_cohort_revenue_retention_sql(spark, d):
    return cohorts.cohort_revenue_retention_sql(Model.from_testdata(spark, d).orders)


#: Month offsets shown as columns of the matrices (eight years), so that their columns do not depend on the data.
MATRIX_OFFSETS = list(range(96))
#: Customers a state needs for its rates (the reference takes 100 of its larger data).
STATE_MINIMUM = 50


def q_cohort_retention_matrix(spark, d):
    return cohorts.matrix_columns(cohorts.cohort_retention_matrix(Model.from_testdata(spark, d).orders), MATRIX_OFFSETS)


def q_cohort_revenue_matrix(spark, d):
    return cohorts.matrix_columns(cohorts.cohort_revenue_matrix(Model.from_testdata(spark, d).orders), MATRIX_OFFSETS)


# ---------- H. churn ----------

def q_customer_churn_clv(spark, d):
    return Model.from_testdata(spark, d).churn


def q_churn_by_segment(spark, d):
    return churn.churn_by_segment(Model.from_testdata(spark, d).churn)


def q_churn_by_region(spark, d):
    return churn.churn_by_region(Model.from_testdata(spark, d).churn)


def q_churn_trend(spark, d):
    return churn.churn_trend(Model.from_testdata(spark, d).orders)


def q_churn_trend_events(spark, d):
    """H4 on purchase events: orders with a time of day over several months, 20-day rule."""
    return churn.churn_trend(td.purchase_events(spark, d), churn_days=20)


def q_churn_trend_asof(spark, d):
    m = Model.from_testdata(spark, d)
    return churn.churn_trend_asof(m.orders, m.persons)


def q_executive_kpis(spark, d):
    m = Model.from_testdata(spark, d)
    return churn.executive_kpis(m.churn, m.orders)


def q_churn_by_rule_segment(spark, d):
    m = Model.from_testdata(spark, d)
    return churn.churn_by_rule_segment(rfm.fixed_threshold_segments(m.orders, m.persons))


def q_revenue_impact_of_churn(spark, d):
    return churn.revenue_impact_of_churn(Model.from_testdata(spark, d).orders)


# ---------- V. revenue ----------

def q_top_customers(spark, d):
    m = Model.from_testdata(spark, d)
    return ranking.top_customers(m.orders, m.persons, n=100)


def q_return_windows(spark, d):
    return revenue.return_windows(Model.from_testdata(spark, d).orders)


def q_region_repeat_rate(spark, d):
    m = Model.from_testdata(spark, d)
    return revenue.region_repeat_rate(m.persons, m.orders, min_customers=STATE_MINIMUM)


def q_region_repeat_rate_all_states(spark, d):
    m = Model.from_testdata(spark, d)
    return revenue.region_repeat_rate(m.persons, m.orders, min_customers=1)


def q_monthly_revenue(spark, d):
    return revenue.monthly_revenue(Model.from_testdata(spark, d).orders)


# ---------- T. sentiment ----------

def _scored_reviews(spark, d, m: Model | None = None, word_lists: dict | None = None) -> DataFrame:
    m = m or Model.from_testdata(spark, d)
    return m.labeled_reviews(lexicon_frame(spark), DEMO_NEGATORS, DEMO_BOOSTERS, word_lists)


def q_lexicon_polarity(spark, d):
    def scored(texts):
        return sentiment.lexicon_polarity(texts, lexicon_frame(spark), DEMO_NEGATORS, DEMO_BOOSTERS).drop("review_comment_message")

    return td.raw_reviews(spark, d, scored).select("review_id", "polarity")


def q_label_reviews(spark, d):
    return _scored_reviews(spark, d).select("review_id", "customer_unique_id", "review_score", "polarity",
                                            "has_comment", "sentiment_label")


def q_customer_sentiment(spark, d):
    return sentiment.customer_sentiment(_scored_reviews(spark, d))


def _csr(spark, d) -> DataFrame:
    m = Model.from_testdata(spark, d)
    return sentiment.customer_sentiment_rfm(sentiment.customer_sentiment(_scored_reviews(spark, d, m)), m.rfm)


def q_customer_sentiment_rfm(spark, d):
    return _csr(spark, d)


def q_negative_review_themes(spark, d):
    m = Model.from_testdata(spark, d)
    return themes.negative_review_themes(_scored_reviews(spark, d, m), m.rfm)


def q_negative_review_themes_wordlist(spark, d):
    m = Model.from_testdata(spark, d)
    return themes.negative_review_themes(_scored_reviews(spark, d, m, DEMO_THEMES), m.rfm, themes=DEMO_THEMES)


def q_sentiment_distribution(spark, d):
    return sentiment.sentiment_distribution(_csr(spark, d))


def q_negative_concentration(spark, d):
    return sentiment.negative_concentration(_csr(spark, d))


# ---------- B. dashboard datasets ----------

def q_kpi_cards(spark, d):
    m = Model.from_testdata(spark, d)
    return extracts.kpi_cards(m.churn, m.orders)


def q_revenue_by_month(spark, d):
    return extracts.revenue_by_month(Model.from_testdata(spark, d).orders)


def q_revenue_by_state(spark, d):
    return extracts.revenue_by_state(Model.from_testdata(spark, d).sales_fact)


def q_tier_profile(spark, d):
    return extracts.tier_profile(Model.from_testdata(spark, d).rfm)


def q_cohort_heatmaps(spark, d):
    return extracts.cohort_heatmaps(Model.from_testdata(spark, d).orders)


def q_returning_customers_by_month(spark, d):
    return extracts.returning_customers_by_month(Model.from_testdata(spark, d).orders)


def q_churn_dashboard(spark, d):
    m = Model.from_testdata(spark, d)
    return extracts.churn_dashboard(m.churn, m.orders)


def q_rfm_scatter_bins(spark, d):
    return extracts.rfm_scatter_bins(Model.from_testdata(spark, d).rfm)


def q_vip_customers(spark, d):
    return extracts.vip_customers(Model.from_testdata(spark, d).rfm)


def q_churned_revenue_by_state(spark, d):
    return extracts.churned_revenue_by_state(Model.from_testdata(spark, d).churn)


def q_active_retention_by_state(spark, d):
    return extracts.active_retention_by_state(Model.from_testdata(spark, d).churn, min_customers=STATE_MINIMUM)


def q_return_rate_all_customers(spark, d):
    return extracts.return_rate_all_customers(Model.from_testdata(spark, d).orders)


def q_action_list(spark, d):
    return extracts.action_list(Model.from_testdata(spark, d).rfm)


def q_sales_by_category_month(spark, d):
    return extracts.sales_by_category_month(Model.from_testdata(spark, d).sales_fact)


def q_sales_by_category_month_totals(spark, d):
    return facts.sales_by_category_month_totals(Model.from_testdata(spark, d).sales_fact)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
