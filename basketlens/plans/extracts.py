"""Dashboard and report datasets (B1-B14).  Each is a small composition of operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.numeric import pct
from basketlens.operators import churn, cohorts, facts, revenue, rfm as rfm_ops
from basketlens.schemas import MONEY

PERSON = "customer_unique_id"

# Per-tier actions named in the reference's recommendations.
TIER_ACTIONS = {
    "VIP": "VIP protection",
    "Loyal": "Loyal upsell",
    "At Risk": "At Risk reactivation",
    "Lost": "Lost win-back",
}


def kpi_cards(churn_table: DataFrame, orders: DataFrame, churn_days: int = churn.CHURN_DAYS) -> DataFrame:
    """B1 = H6."""
    return churn.executive_kpis(churn_table, orders, churn_days)


def revenue_by_month(orders: DataFrame) -> DataFrame:
    """B2."""
    return revenue.revenue_by_month(orders)


def revenue_by_state(fact: DataFrame) -> DataFrame:
    """B3."""
    return facts.revenue_by_state(fact)


def tier_profile(rfm: DataFrame) -> DataFrame:
    """Distribution of customers by tier, mean recency and CLV by tier."""
    s = rfm_ops.segment_summary(rfm)
    total = rfm.filter(F.col("value_tier").isNotNull()).agg(F.countDistinct(PERSON)).scalar()
    return s.withColumn("customer_share_pct", pct("customers", total))


def cohort_heatmaps(orders: DataFrame) -> DataFrame:
    """Both heatmaps in long form (cohort x offset)."""
    return cohorts.cohort_retention_long(orders).select(
        "cohort_month", "months_since_first_purchase", "retention_pct", "revenue_retention_pct")


def returning_customers_by_month(orders: DataFrame) -> DataFrame:
    """B6."""
    return revenue.returning_customers_by_month(orders)


def churn_dashboard(churn_table: DataFrame, orders: DataFrame, churn_days: int = churn.CHURN_DAYS) -> DataFrame:
    """Churn by segment, by region and by month end stacked in one long table (months have no revenue at risk)."""
    seg = churn.churn_by_segment(churn_table).select(
        F.lit("value_tier").alias("dimension"), F.col("value_tier").alias("dimension_value"),
        "customers", "churned_customers", "churn_rate_pct", "revenue_at_risk")
    reg = churn.churn_by_region(churn_table).select(
        F.lit("customer_state").alias("dimension"), F.col("customer_state").alias("dimension_value"),
        "customers", "churned_customers", "churn_rate_pct", "revenue_at_risk")
    trend = churn.churn_trend(orders, churn_days).select(
        F.lit("month").alias("dimension"), F.col("month").cast("string").alias("dimension_value"),
        F.col("known_customers").alias("customers"), "churned_customers", "churn_rate_pct",
        F.lit(None).cast(churn.AOV_SUM).alias("revenue_at_risk"))
    return seg.unionByName(reg).unionByName(trend)


def rfm_scatter_bins(rfm: DataFrame, bins: int = 16) -> DataFrame:
    """Customers by frequency bin, monetary bin and tier (keeps the scatter extract small).

    A bin is named by its least value.  Each axis has at most ``bins`` bins of about as many
    customers each, so the extract has at most ``bins`` x ``bins`` rows a tier at any size.
    The edges come from a mergeable quantile summary (exact up to some ten thousand customers,
    ranks off by at most 1 in 10 000 of them beyond).
    """
    edges = rfm.agg(*[F.percentile_approx(c, [k / bins for k in range(bins)], 10_000).alias(c) for c in ("frequency", "monetary")])

    def least(c: str) -> Column:
        at = edges.select(c).scalar()
        return F.greatest(*[F.when(F.col(c) >= at[k], at[k]) for k in range(bins)])

    return (rfm.groupBy(least("frequency").alias("frequency_bin"), least("monetary").alias("monetary_bin"), "value_tier")
            .agg(F.count(F.lit(1)).alias("customers")))


def vip_customers(rfm: DataFrame) -> DataFrame:
    """VIP customers by monetary value (descending, id as tie-break)."""
    return (rfm.filter(F.col("value_tier") == "VIP")
            .select(PERSON, "customer_state", "customer_city", "frequency", "monetary", "recency_days")
            .orderBy(F.col("monetary").desc(), F.col(PERSON).asc()))


def churned_revenue_by_state(churn_table: DataFrame) -> DataFrame:
    """Historical revenue of churned customers per state."""
    return (churn_table.filter(F.col("is_churned") & F.col("customer_state").isNotNull())
            .groupBy("customer_state")
            .agg(F.count(F.lit(1)).alias("churned_customers"),
                 F.sum("historical_clv").cast(MONEY).alias("churned_historical_revenue")))


def active_retention_by_state(churn_table: DataFrame, min_customers: int = 100) -> DataFrame:
    """Active share per state with at least ``min_customers`` customers."""
    r = churn.churn_by_region(churn_table).filter(F.col("customers") >= min_customers)
    return r.select("customer_state", "customers", "churned_customers", "churn_rate_pct",
                    pct(F.col("customers") - F.col("churned_customers"), "customers").alias("active_rate_pct"))


def return_rate_all_customers(orders: DataFrame, days: int = 90) -> DataFrame:
    """B12."""
    return revenue.return_rate_all_customers(orders, days)


def action_list(rfm: DataFrame, min_monetary_score: int = 4, min_recency_days: int = 180) -> DataFrame:
    """Per-tier action lists and the win-back flag (high monetary score, recency over the limit)."""
    action = reduce(lambda acc, kv: acc.when(F.col("value_tier") == kv[0], F.lit(kv[1])),
                    list(TIER_ACTIONS.items())[1:],
                    F.when(F.col("value_tier") == list(TIER_ACTIONS)[0], F.lit(list(TIER_ACTIONS.values())[0])))
    return (rfm.filter(F.col("value_tier").isin(*TIER_ACTIONS))
            .select(PERSON, "value_tier", action.alias("action"), "monetary", "monetary_score",
                    "recency_days", "customer_state",
                    ((F.col("monetary_score") >= min_monetary_score)
                     & (F.col("recency_days") > min_recency_days)).alias("win_back_target")))


def sales_by_category_month(fact: DataFrame) -> DataFrame:
    """B14."""
    return facts.sales_by_category_month(fact)
