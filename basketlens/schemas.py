"""Fixed schemas of the raw inputs and money/percent types.

Types follow the reference DDL: ids are strings in the raw CSV files,
amounts are DECIMAL(12,2), datetimes have no zone.  Operators themselves
are generic in the key type (the test tables use bigint ids).
"""

from pyspark.sql import types as T

MONEY = T.DecimalType(28, 2)        # widened from (12,2) so that sums never overflow under ANSI mode
PRICE = T.DecimalType(12, 2)

RAW_CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_unique_id", T.StringType()),
    T.StructField("customer_zip_code_prefix", T.IntegerType()),
    T.StructField("customer_city", T.StringType()),
    T.StructField("customer_state", T.StringType()),
])

RAW_ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("order_purchase_timestamp", T.TimestampNTZType()),
    T.StructField("order_approved_at", T.TimestampNTZType()),
    T.StructField("order_delivered_carrier_date", T.TimestampNTZType()),
    T.StructField("order_delivered_customer_date", T.TimestampNTZType()),
    T.StructField("order_estimated_delivery_date", T.TimestampNTZType()),
])

RAW_ORDER_ITEMS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("order_item_id", T.IntegerType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("seller_id", T.StringType()),
    T.StructField("shipping_limit_date", T.TimestampNTZType()),
    T.StructField("price", PRICE),
    T.StructField("freight_value", PRICE),
])

# two column names are misspelt in the source file; kept here, renamed by products_clean
RAW_PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_category_name", T.StringType()),
    T.StructField("product_name_lenght", T.IntegerType()),
    T.StructField("product_description_lenght", T.IntegerType()),
    T.StructField("product_photos_qty", T.IntegerType()),
    T.StructField("product_weight_g", T.IntegerType()),
    T.StructField("product_length_cm", T.IntegerType()),
    T.StructField("product_height_cm", T.IntegerType()),
    T.StructField("product_width_cm", T.IntegerType()),
])

RAW_TRANSLATIONS = T.StructType([
    T.StructField("product_category_name", T.StringType()),
    T.StructField("product_category_name_english", T.StringType()),
])

RAW_REVIEWS = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("review_score", T.ByteType()),
    T.StructField("review_comment_title", T.StringType()),
    T.StructField("review_comment_message", T.StringType()),
    T.StructField("review_creation_date", T.TimestampNTZType()),
    T.StructField("review_answer_timestamp", T.TimestampNTZType()),
])

RAW_SCHEMAS = {
    "customers": RAW_CUSTOMERS,
    "orders": RAW_ORDERS,
    "order_items": RAW_ORDER_ITEMS,
    "products": RAW_PRODUCTS,
    "translations": RAW_TRANSLATIONS,
    "order_reviews": RAW_REVIEWS,
}
