"""Ingest and modelling operators.

Both flavours of the reference are kept where they disagree:
pandas flavour (``customers_clean``, left joins, delivered-only dates) and
SQL flavour (``customers_dim``, inner joins, all-order dates).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.dates import month_start
from basketlens.functions.text import nfkd_ascii, strip_space
from basketlens.schemas import MONEY

DELIVERED = "delivered"


def standardize_customers(customers: DataFrame) -> DataFrame:
    """City stripped of white space, lower-cased, NFKD-folded to ASCII; state upper-cased.

    Strip and lower run in the JVM.  Only cities that still hold a non-ASCII
    character are handed to the Arrow UDF; the other rows hand it a null.  No
    join and no job: a plan that reads no city has none of this.
    """
    city = F.lower(strip_space(F.col("customer_city").cast("string")))
    non_ascii = F.col("_city").rlike("[^\\x00-\\x7F]")
    return (customers.withColumn("_city", city)
            .withColumn("customer_state", F.upper(F.col("customer_state").cast("string")))
            .withColumn("customer_city", F.coalesce(nfkd_ascii(F.when(non_ascii, F.col("_city"))), "_city"))
            .select(*customers.columns))


def products_clean(products: DataFrame, translations: DataFrame, flavour: str = "pandas") -> DataFrame:
    """I4: translate categories; NULL category -> 'unknown'; English falls back to the source name.

    The translation table is a category list (tens of rows); Spark's size
    statistics decide the broadcast.  BOM and CR are stripped from the keys and names.
    """
    t = translations.select(
        F.regexp_replace(F.col("product_category_name"), "^﻿|\r$", "").alias("_cat"),
        F.regexp_replace(F.col("product_category_name_english"), "\r$", "").alias("_en"),
    ).groupBy("_cat").agg(F.min("_en").alias("_en"))
    p = products.join(t, products["product_category_name"] == t["_cat"], "left")
    if flavour == "pandas":
        p = (p.withColumn("product_category_name", F.coalesce("product_category_name", F.lit("unknown")))
             .withColumn("product_category_english", F.coalesce("_en", "product_category_name")))
    elif flavour == "sql":
        p = p.withColumn("product_category_english",
                         F.coalesce("_en", "product_category_name", F.lit("unknown")))
    else:
        raise ValueError(flavour)
    p = p.drop("_cat", "_en")
    for bad, good in (("product_name_lenght", "product_name_length"),
                      ("product_description_lenght", "product_description_length")):
        if bad in p.columns:
            p = p.withColumnRenamed(bad, good)
    return p


def order_financials(items: DataFrame) -> DataFrame:
    """Per order, sum of price, sum of freight, item rows.  Partial + final aggregate."""
    return (items.groupBy("order_id")
            .agg(F.sum("price").cast(MONEY).alias("order_revenue"),
                 F.sum("freight_value").cast(MONEY).alias("order_freight"),
                 F.count("order_item_id").alias("order_items")))


def orders_clean(orders: DataFrame, customers: DataFrame, items: DataFrame, how: str = "left") -> DataFrame:
    """Orders + person id + financials (0 when the order has no items) + month.

    Items are aggregated per order *before* the join, so the join sees one
    row per order on both sides.  ``how='inner'`` is the SQL flavour (D10).
    """
    fin = order_financials(items)
    keys = customers.select("customer_id", "customer_unique_id")
    return (orders.join(keys, "customer_id", how)
            .join(fin, "order_id", "left")
            .withColumn("order_revenue", F.coalesce("order_revenue", F.lit(0).cast(MONEY)))
            .withColumn("order_freight", F.coalesce("order_freight", F.lit(0).cast(MONEY)))
            .withColumn("order_items", F.coalesce("order_items", F.lit(0)).cast("int"))
            .withColumn("order_month", month_start("order_purchase_timestamp")))


def customers_clean(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """I8 (pandas flavour): one row per person.

    Location from the raw row with the smallest ``customer_id`` (``min_by``,
    a partial aggregate, so a person with millions of rows costs nothing
    extra); first/last/count over *delivered* orders, left-joined.
    """
    loc = (customers.filter(F.col("customer_unique_id").isNotNull())
           .groupBy("customer_unique_id")
           .agg(F.min_by(F.struct("customer_city", "customer_state"), F.col("customer_id")).alias("_loc"))
           .select("customer_unique_id", "_loc.customer_city", "_loc.customer_state"))
    dates = (orders.filter(F.col("order_status") == DELIVERED)
             .filter(F.col("customer_unique_id").isNotNull())
             .groupBy("customer_unique_id")
             .agg(F.min("order_purchase_timestamp").alias("first_seen_date"),
                  F.max("order_purchase_timestamp").alias("last_seen_date"),
                  F.countDistinct("order_id").alias("total_orders")))
    return loc.join(dates, "customer_unique_id", "left")


def customers_dim(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """I9 (SQL flavour): independent minima of city and state; dates and count over all orders.

    ``customers`` LEFT JOIN ``orders`` on ``customer_id`` then one aggregate per
    person.  The single distinct count is planned by Spark as a two-phase
    aggregate keyed on (person, order), so a person with a third of all
    orders is still spread over many tasks.
    """
    o = orders.select("customer_id", "order_id", "order_purchase_timestamp")
    return (customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state")
            .join(o, "customer_id", "left")
            .groupBy("customer_unique_id")
            .agg(F.min("customer_city").alias("customer_city"),
                 F.min("customer_state").alias("customer_state"),
                 F.min("order_purchase_timestamp").cast("date").alias("first_seen_date"),
                 F.max("order_purchase_timestamp").cast("date").alias("last_seen_date"),
                 F.countDistinct("order_id").alias("total_orders")))


def sales_fact(orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Delivered orders x person x items (inner) x category (left); line revenue incl. freight."""
    d = (orders.filter(F.col("order_status") == DELIVERED)
         .select("order_id", "customer_id", "order_purchase_timestamp"))
    c = customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state")
    p = products.select("product_id", "product_category_english")
    return (d.join(c, "customer_id", "left")
            .join(items, "order_id", "inner")
            .join(p, "product_id", "left")
            .withColumn("line_revenue", (F.col("price") + F.col("freight_value")).cast(MONEY))
            .withColumn("order_month", month_start("order_purchase_timestamp")))


def items_valid(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Keep items whose order and product exist (semi joins: never multiply rows)."""
    return (items.join(orders.select("order_id"), "order_id", "left_semi")
            .join(products.select("product_id"), "product_id", "left_semi"))


def reviews_dedup(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """Reviews of known orders, one row per review id (min order, max score, max non-empty message)."""
    r = reviews.join(orders.select("order_id"), "order_id", "left_semi")
    return (r.groupBy("review_id")
            .agg(F.min("order_id").alias("order_id"),
                 F.max("review_score").alias("review_score"),
                 F.max(F.nullif(F.col("review_comment_message"), F.lit(""))).alias("review_comment_message")))
