"""The job that writes a model's tables (Parquet) and extracts (CSV with header)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketlens.operators import churn, cohorts, rfm, sentiment, themes
from basketlens.plans.model import Model
from basketlens.session import reliable_checkpoint
from basketlens.sources.files import write_extract, write_table


def outputs(model: Model, lexicon: DataFrame, negators: list[str] = (), boosters: list[str] = ()) -> dict[str, tuple[DataFrame, bool]]:
    """Every output by name: its rows, and whether they are few (months, tiers, states: one CSV file)."""
    # scored once: four outputs read these text-free rows
    labeled = reliable_checkpoint(model.labeled_reviews(lexicon, negators, boosters))
    people = sentiment.customer_sentiment_rfm(sentiment.customer_sentiment(labeled), model.rfm)
    return {
        "customers_clean": (model.customers_clean, False),
        "orders_clean": (model.orders, False),
        "order_items_clean": (model.raw_items, False),
        "products_clean": (model.products, False),
        "sales_fact": (model.sales_fact, False),
        "rfm_segmentation": (model.rfm, False),
        "segment_summary": (rfm.segment_summary(model.rfm), True),
        "cohort_retention_long": (cohorts.cohort_retention_long(model.orders), True),
        "cohort_retention_matrix": (cohorts.matrix_columns(cohorts.cohort_retention_matrix(model.orders)), True),
        "cohort_revenue_retention_matrix": (cohorts.matrix_columns(cohorts.cohort_revenue_matrix(model.orders)), True),
        "customer_churn_clv": (model.churn, False),
        "churn_by_segment": (churn.churn_by_segment(model.churn), True),
        "churn_by_region": (churn.churn_by_region(model.churn), True),
        "churn_trend": (churn.churn_trend(model.orders, model.churn_days), True),
        "executive_kpis": (churn.executive_kpis(model.churn, model.orders, model.churn_days), True),
        "customer_sentiment_rfm": (people, False),
        "negative_review_themes": (themes.negative_review_themes(labeled, model.rfm), True),
        "sentiment_distribution": (sentiment.sentiment_distribution(people), True),
        "negative_sentiment_concentration": (sentiment.negative_concentration(people), True),
    }


def write_outputs(frames: dict[str, tuple[DataFrame, bool]], folder: str, prefix: str = "extract_") -> None:
    """``folder``/processed/<name> as Parquet, then from that table ``folder``/exports/<prefix><name> as CSV.

    An extract reads the written table, so no output is computed twice.  Outputs of
    few rows are one file, which keeps the order that their operator gave.
    """
    for name, (df, few) in frames.items():
        table = f"{folder.rstrip('/')}/processed/{name}"
        write_table(df.coalesce(1) if few else df, table)
        write_extract(df.sparkSession.read.schema(df.schema).parquet(table),
                      f"{folder.rstrip('/')}/exports/{prefix}{name}", single_file=few)
