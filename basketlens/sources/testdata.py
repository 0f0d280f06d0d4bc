"""Adapter: logical raw tables of the reference built from the generated test tables.


* customers (one row per ``customer_id``): an order key is the customer id,
  ``o_custkey`` the person (``customer_unique_id``), the order priority the city,
  the nation name the state;
* orders: status F -> delivered, O -> shipped, P -> processing;
* order_items: line items; price in cents rounded half-up, freight = price x tax;
* products: parts, category = part type, with an inline translation table that
  leaves two categories out (fallback path);
* order_reviews: documents (review and order id = doc id), score from labels;
* repeated review ids: conversations (one review id per conversation, one order per turn).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.schemas import PRICE

# Fixed values of the adapter (status codes and the inline category translation).
STATUS_NAMES = {"F": "delivered", "O": "shipped", "P": "processing"}
CATEGORY_TRANSLATION = [
    ("STANDARD", "standard_goods"),
    ("ECONOMY", "economy_goods"),
    ("MEDIUM", "medium_goods"),
    ("PROMO", "promo_goods"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _status(col: str):
    expr = F.lit(None).cast("string")
    for code, name in STATUS_NAMES.items():
        expr = F.when(F.col(col) == code, F.lit(name)).otherwise(expr)
    return expr


def _half_up_cents(col: str):
    # same IEEE operations in every engine, then exact decimal
    return (F.floor(F.col(col) * 100 + 0.5).cast("decimal(16,0)") * F.lit(0.01).cast("decimal(2,2)"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    person = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
    return (orders.join(person, orders.o_custkey == person.c_custkey, "left")
            .select(F.col("o_orderkey").alias("customer_id"),
                    F.col("o_custkey").alias("customer_unique_id"),
                    F.col("c_nationkey").alias("customer_zip_code_prefix"),
                    F.col("o_orderpriority").alias("customer_city"),
                    F.col("n_name").alias("customer_state")))


def raw_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL-flavour customer dimension straight from ``customer`` (one row per person)."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
            .select(F.col("c_custkey").alias("customer_unique_id"),
                    F.col("c_mktsegment").alias("customer_city"),
                    F.col("n_name").alias("customer_state")))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("order_id"),
                    F.col("o_orderkey").alias("customer_id"),
                    _status("o_orderstatus").alias("order_status"),
                    F.col("o_orderdate").alias("order_purchase_timestamp"))


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    price = _half_up_cents("l_extendedprice")
    tax = _half_up_cents("l_tax")
    return li.select(F.col("l_orderkey").alias("order_id"),
                     F.col("l_linenumber").alias("order_item_id"),
                     F.col("l_partkey").alias("product_id"),
                     F.col("l_suppkey").alias("seller_id"),
                     F.col("l_shipdate").alias("shipping_limit_date"),
                     price.cast(PRICE).alias("price"),
                     F.round(price * tax, 2).cast(PRICE).alias("freight_value"))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("product_id"),
                    F.col("p_type").alias("product_category_name"),
                    F.length("p_name").cast("int").alias("product_name_lenght"),
                    F.length("p_brand").cast("int").alias("product_description_lenght"),
                    F.col("p_size").alias("product_photos_qty"))


def translations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORY_TRANSLATION,
                                 "product_category_name string, product_category_name_english string")


def raw_reviews(spark: SparkSession, sf_dir: str, prepared: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Reviews; ``prepared`` is applied to (review_id, order_id, text) where the texts are read, before the scores are joined."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("review_id"), F.col("doc_id").alias("order_id"),
                                                 F.col("text").alias("review_comment_message"))
    d = prepared(d) if prepared else d
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    score = (F.when(F.col("toxic") == 1, F.lit(1))
             .when(F.col("quality") == 1, F.lit(5))
             .when(F.col("quality") == 0, F.lit(2)))
    return (d.join(lab, F.col("review_id") == F.col("doc_id"), "left")
            .select("review_id", "order_id", score.cast("tinyint").alias("review_score"), *d.columns[2:]))


def raw_reviews_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review rows with repeated review ids: one per conversation turn."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("review_id"),
                    (F.col("conv_id") + F.col("turn")).alias("order_id"),
                    ((F.col("turn") % 5) + 1).cast("tinyint").alias("review_score"),
                    F.col("text").alias("review_comment_message"))


def purchase_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a time of day: purchase events as delivered orders of their user.

    The events cover one month; event ids modulo 6 spread them over half a year.
    """
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return e.select(F.col("event_id").alias("order_id"),
                    F.col("user_id").alias("customer_unique_id"),
                    F.lit("delivered").alias("order_status"),
                    F.timestamp_add("DAY", ((F.col("event_id") % 6) * 30).cast("int"), F.col("ts").cast("timestamp_ntz"))
                    .alias("order_purchase_timestamp"),
                    F.floor(F.col("value") * 100 + 0.5).cast("decimal(16,0)")
                    .__mul__(F.lit(0.01).cast("decimal(2,2)")).cast("decimal(28,2)").alias("order_revenue"))
