"""RFM segmentation.

Person-level metrics are one partial+final aggregate keyed by person.  The
quintile scores need exact global ranks; they come from
``ranking.quantile_scores`` (the pairs where a score ends, selected by
histograms), never from a window without PARTITION BY.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.dates import (AS_OF_ALL_ORDERS, AS_OF_DELIVERED_PLUS_1D, as_of_date,
                                       calendar_days, elapsed_days)
from basketlens.functions.numeric import half_up_ratio, money_mean, money_mean_dec
from basketlens.operators.ranking import quantile_scores
from basketlens.schemas import MONEY

DELIVERED = "delivered"
PERSON = "customer_unique_id"

# Tier names and rules of the reference (ordered; first match wins).
TIER_VIP, TIER_LOYAL, TIER_AT_RISK, TIER_LOST, TIER_DEVELOPING = "VIP", "Loyal", "At Risk", "Lost", "Developing"


def customer_metrics(orders: DataFrame, as_of: str = AS_OF_DELIVERED_PLUS_1D) -> DataFrame:
    """R1 (pandas flavour): delivered orders per person.

    ``as_of='delivered_plus_1d'``: recency in elapsed 24-hour days from the
    latest delivered purchase + 1 day; ``'all_orders'``: calendar days from
    the latest purchase date over every order (divergences D1, D2).
    """
    ref = as_of_date(orders, as_of)
    d = orders.filter((F.col("order_status") == DELIVERED) & F.col(PERSON).isNotNull())
    m = (d.groupBy(PERSON)
         .agg(F.max("order_purchase_timestamp").alias("last_purchase_date"),
              F.min("order_purchase_timestamp").alias("first_purchase_date"),
              F.countDistinct("order_id").alias("frequency"),
              F.sum("order_revenue").cast(MONEY).alias("monetary"),
              F.count("order_revenue").alias("_cnt")))
    recency = elapsed_days(ref, "last_purchase_date") if as_of == AS_OF_DELIVERED_PLUS_1D \
        else calendar_days(ref, "last_purchase_date")
    return (m.withColumn("avg_order_value", money_mean_dec("monetary", "_cnt"))
            .withColumn("recency_days", recency.cast("long"))
            .withColumn("customer_lifespan_days",
                        F.greatest(elapsed_days("last_purchase_date", "first_purchase_date"), F.lit(1)).cast("long"))
            .drop("_cnt"))


def score_and_tier(scored: DataFrame) -> DataFrame:
    """rfm_score and the ordered tier rules."""
    r, f, m = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    tier = (F.when((r >= 4) & (f >= 4) & (m >= 4), TIER_VIP)
            .when((r >= 3) & (f >= 3), TIER_LOYAL)
            .when((r <= 2) & (m >= 3), TIER_AT_RISK)
            .when(r <= 2, TIER_LOST)
            .otherwise(TIER_DEVELOPING))
    return scored.withColumn("rfm_score", r + f + m).withColumn("value_tier", tier)


def _rfm_specs() -> list[tuple[str, Column, bool]]:
    return [("recency_score", F.col("recency_days"), True),
            ("frequency_score", F.col("frequency"), False),
            ("monetary_score", F.col("monetary"), False)]


def rfm_segmentation(orders: DataFrame, customers: DataFrame, as_of: str = AS_OF_DELIVERED_PLUS_1D) -> DataFrame:
    """R5 (pandas flavour): metrics, qcut quintiles of first-rank, tiers, location (left join)."""
    m = customer_metrics(orders, as_of)
    scored = score_and_tier(quantile_scores(m, _rfm_specs(), PERSON, method="qcut"))
    loc = customers.select(PERSON, "customer_city", "customer_state")
    return (scored.join(loc, PERSON, "left")
            .select(PERSON, "last_purchase_date", "first_purchase_date", "frequency", "monetary",
                    "avg_order_value", "recency_days", "customer_lifespan_days", "recency_score",
                    "frequency_score", "monetary_score", "rfm_score", "value_tier",
                    "customer_city", "customer_state"))


def customer_metrics_sql(orders: DataFrame, persons: DataFrame, as_of: str = AS_OF_ALL_ORDERS) -> DataFrame:
    """SQL-flavour metrics: persons inner join delivered orders, calendar recency (queries 2 and 3).

    Orders are aggregated per person first, then joined (one row per side).
    """
    ref = as_of_date(orders, as_of)
    per = (orders.filter((F.col("order_status") == DELIVERED) & F.col(PERSON).isNotNull())
           .groupBy(PERSON)
           .agg(F.max(F.col("order_purchase_timestamp").cast("date")).alias("last_purchase_date"),
                F.countDistinct("order_id").alias("frequency"),
                F.sum("order_revenue").cast(MONEY).alias("monetary")))
    recency = calendar_days(ref, "last_purchase_date") if as_of == AS_OF_ALL_ORDERS \
        else elapsed_days(ref, "last_purchase_date")
    return (persons.select(PERSON, "customer_state").join(per, PERSON, "inner")
            .withColumn("recency_days", recency.cast("long")))


def rfm_segmentation_ntile(orders: DataFrame, persons: DataFrame) -> DataFrame:
    """R6 (SQL flavour, query 2): NTILE(5) scores over exact row numbers, tiers."""
    m = customer_metrics_sql(orders, persons)
    scored = score_and_tier(quantile_scores(m, _rfm_specs(), PERSON, method="ntile"))
    return scored.select(PERSON, "customer_state", "recency_days", "frequency", "monetary",
                         "recency_score", "frequency_score", "monetary_score", "rfm_score", "value_tier")


def segment_summary(rfm: DataFrame) -> DataFrame:
    """Per tier customers, revenue, mean CLV, mean recency (tier-sized result), most revenue first."""
    return (rfm.filter(F.col("value_tier").isNotNull())
            .groupBy("value_tier")
            .agg(F.countDistinct(PERSON).alias("customers"),
                 F.sum("monetary").cast(MONEY).alias("revenue"),
                 F.count("monetary").alias("_nm"),
                 F.sum("recency_days").alias("_sr"),
                 F.count("recency_days").alias("_nr"))
            .withColumn("avg_clv", money_mean("revenue", "_nm", 6))
            .withColumn("avg_recency_days", half_up_ratio("_sr", "_nr", 1, 6))
            .select("value_tier", "customers", "revenue", "avg_clv", "avg_recency_days")
            .orderBy(F.col("revenue").desc(), "value_tier"))


def fixed_threshold_segments(orders: DataFrame, persons: DataFrame, vip_days: int = 90, vip_orders: int = 2,
                             vip_revenue: float = 500, loyal_days: int = 180, loyal_orders: int = 2,
                             at_risk_days: tuple[int, int] = (181, 365), churn_days: int = 180) -> DataFrame:
    """R8 (query 3 CTE): rule segments on calendar recency; recent one-time buyers fall to Lost."""
    m = customer_metrics_sql(orders, persons)
    rd, fr, mo = F.col("recency_days"), F.col("frequency"), F.col("monetary")
    seg = (F.when((rd <= vip_days) & (fr >= vip_orders) & (mo >= F.lit(vip_revenue)), TIER_VIP)
           .when((rd <= loyal_days) & (fr >= loyal_orders), TIER_LOYAL)
           .when(rd.between(at_risk_days[0], at_risk_days[1]), TIER_AT_RISK)
           .otherwise(TIER_LOST))
    return (m.withColumn("customer_segment", seg)
            .withColumn("churned_flag", F.when(rd > churn_days, 1).otherwise(0)))
