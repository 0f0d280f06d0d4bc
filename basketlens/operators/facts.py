"""Joined facts and summary views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.numeric import money_mean
from basketlens.schemas import MONEY


def reviews_with_customer(reviews: DataFrame, orders: DataFrame,
                          columns: tuple = ("review_id", "order_id", "review_score", "review_comment_message")) -> DataFrame:
    """Review text and score with the order's customer keys (inner equi-join on order id).

    ``columns`` names what a review brings: scored reviews leave their text behind.
    """
    o = orders.select("order_id", "customer_id", "customer_unique_id")
    return reviews.select(*columns).join(o, "order_id", "inner")


def customer_order_summary(persons: DataFrame, orders: DataFrame) -> DataFrame:
    """View over all orders (no status filter); persons without orders are kept.

    Orders are aggregated per person first (partial aggregate), then joined to
    the person dimension: the join sees one row per person on both sides.
    """
    per_person = (orders.groupBy("customer_unique_id")
                  .agg(F.countDistinct("order_id").alias("total_orders"),
                       F.min("order_purchase_timestamp").alias("first_purchase_date"),
                       F.max("order_purchase_timestamp").alias("last_purchase_date"),
                       F.sum("order_revenue").cast(MONEY).alias("total_revenue"),
                       F.count("order_revenue").alias("_n")))
    return (persons.select("customer_unique_id", "customer_city", "customer_state")
            .join(per_person, "customer_unique_id", "left")
            .withColumn("total_orders", F.coalesce("total_orders", F.lit(0)).cast("long"))
            .withColumn("avg_order_value", money_mean("total_revenue", "_n", 6))
            .drop("_n"))


def revenue_by_state(fact: DataFrame) -> DataFrame:
    """Revenue by state from the sales fact (line revenue includes freight, D9)."""
    return (fact.groupBy("customer_state")
            .agg(F.sum("line_revenue").cast(MONEY).alias("revenue"),
                 F.countDistinct("order_id").alias("orders_count"),
                 F.count(F.lit(1)).alias("item_rows")))


def _sales(groups, *more) -> DataFrame:
    return groups.agg(F.sum("price").cast(MONEY).alias("item_revenue"),
                      F.sum("line_revenue").cast(MONEY).alias("line_revenue"),
                      F.count(F.lit(1)).alias("items_sold"),
                      F.countDistinct("order_id").alias("orders_count"), *more)


def sales_by_category_month(fact: DataFrame) -> DataFrame:
    """Sales by product category and month."""
    return _sales(fact.groupBy("product_category_english", "order_month"))


def sales_by_category_month_totals(fact: DataFrame) -> DataFrame:
    """B14 with subtotals: also per category over all months, and over all.

    ``level`` is 0 for a category's month, 1 for a category, 3 for all (the grouping id): it
    tells a subtotal's nulls from a missing category.
    """
    keys = ("product_category_english", "order_month")
    return _sales(fact.rollup(*keys), F.grouping_id().cast("int").alias("level"))
