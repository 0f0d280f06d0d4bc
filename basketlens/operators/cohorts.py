"""Monthly cohorts.

Orders are first reduced to one row per (person, month) with a partial
aggregate; the per-person minimum month is a window over that grain, whose
size per person is bounded by the number of calendar months, so a person
holding a third of all orders is still a small group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.dates import month_diff, month_start
from basketlens.functions.numeric import money_pct, pct
from basketlens.operators.skew import all_salts, heavy_values, salt
from basketlens.schemas import MONEY

DELIVERED = "delivered"
PERSON = "customer_unique_id"


def _delivered(orders: DataFrame) -> DataFrame:
    return orders.filter((F.col("order_status") == DELIVERED) & F.col(PERSON).isNotNull())


def person_months(orders: DataFrame) -> DataFrame:
    """(person, order_month, revenue, cohort_month, months_since_first_purchase)."""
    pm = (_delivered(orders)
          .withColumn("order_month", month_start("order_purchase_timestamp"))
          .groupBy(PERSON, "order_month")
          .agg(F.sum("order_revenue").alias("revenue")))
    w = Window.partitionBy(PERSON)
    return (pm.withColumn("cohort_month", F.min("order_month").over(w))
            .withColumn("months_since_first_purchase", month_diff("order_month", "cohort_month")))


def cohort_assign(orders: DataFrame, salts: int = 16) -> DataFrame:
    """Every delivered order with its person's cohort month and month offset.

    The cohort (one row per person, the least month of its orders) is joined
    back on the person.  Orders of persons who hold 1/256 of them or more are
    dealt to ``salts`` groups, and only the rows of those persons (256 at
    most) are repeated for each group.
    """
    o = (_delivered(orders).select("order_id", PERSON, "order_purchase_timestamp", "order_revenue")
         .withColumn("order_month", month_start("order_purchase_timestamp")))
    heavy = heavy_values(o, PERSON)
    cohorts = (o.groupBy(PERSON).agg(F.min("order_month").alias("cohort_month"))
               .withColumn("_salt", F.explode(all_salts(heavy, PERSON, salts))))
    return (o.withColumn("_salt", salt(heavy, PERSON, "order_id", salts))
            .join(cohorts, [PERSON, "_salt"], "inner").drop("_salt")
            .withColumn("months_since_first_purchase", month_diff("order_month", "cohort_month")))


def cohort_retention_long(orders: DataFrame) -> DataFrame:
    """Per cohort and offset: active customers, revenue, size, month-0 revenue, retention %."""
    counts = (person_months(orders)
              .groupBy("cohort_month", "months_since_first_purchase")
              .agg(F.count(F.lit(1)).alias("active_customers"),
                   F.sum("revenue").cast(MONEY).alias("revenue")))
    # cohort x offset sized (months^2 at most): a window per cohort is cheap
    w = Window.partitionBy("cohort_month")
    base = F.when(F.col("months_since_first_purchase") == 0, F.col("active_customers"))
    base_rev = F.when(F.col("months_since_first_purchase") == 0, F.col("revenue"))
    return (counts.withColumn("cohort_size", F.max(base).over(w))
            .withColumn("month_0_revenue", F.max(base_rev).over(w))
            .withColumn("retention_pct", pct("active_customers", "cohort_size"))
            .withColumn("revenue_retention_pct", money_pct("revenue", "month_0_revenue"))
            .select("cohort_month", "months_since_first_purchase", "active_customers", "revenue",
                    "cohort_size", "month_0_revenue", "retention_pct", "revenue_retention_pct"))


def retention_trend(orders: DataFrame, offset: int = 1) -> DataFrame:
    """Month-``offset`` retention of every cohort (0 when nobody came back)."""
    at = lambda k: F.max(F.when(F.col("months_since_first_purchase") == k, F.col("active_customers")))
    return (cohort_retention_long(orders).groupBy("cohort_month")
            .agg(at(0).alias("cohort_size"), F.coalesce(at(offset), F.lit(0)).cast("long").alias("active_customers"))
            .withColumn("months_since_first_purchase", F.lit(offset))
            .withColumn("retention_pct", pct("active_customers", "cohort_size"))
            .select("cohort_month", "cohort_size", "active_customers", "months_since_first_purchase", "retention_pct"))


def cohort_retention_sql(orders: DataFrame) -> DataFrame:
    """C4 (query 7): cohort size from the offset-0 row; same rows as C3."""
    return cohort_retention_long(orders).select(
        "cohort_month", "months_since_first_purchase", "cohort_size", "active_customers", "retention_pct")


def cohort_revenue_retention_sql(orders: DataFrame) -> DataFrame:
    """C5 (query 8)."""
    return cohort_retention_long(orders).select(
        "cohort_month", "months_since_first_purchase", "revenue", "month_0_revenue", "revenue_retention_pct")


def _matrix(long: DataFrame, value: str) -> DataFrame:
    """Per cohort a map from month offset to value: as wide as the data, whatever the offsets."""
    return long.groupBy("cohort_month").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("months_since_first_purchase", value)))).alias("by_month"))


def cohort_retention_matrix(orders: DataFrame) -> DataFrame:
    """Per cohort its retention % by month offset, as a map."""
    return _matrix(cohort_retention_long(orders), "retention_pct")


def cohort_revenue_matrix(orders: DataFrame) -> DataFrame:
    """Per cohort its revenue retention % by month offset, as a map."""
    return _matrix(cohort_retention_long(orders), "revenue_retention_pct")


def observed_offsets(matrix: DataFrame) -> list[int]:
    """The month offsets that some cohort has, ascending (as many as months at most)."""
    rows = matrix.select(F.explode(F.map_keys("by_month")).alias("m")).distinct().collect()
    return sorted(r.m for r in rows)


def matrix_columns(matrix: DataFrame, offsets: list[int] | None = None) -> DataFrame:
    """A matrix as a table for a sink: a column per offset (default: the observed ones), 0 where a cohort has none."""
    offsets = observed_offsets(matrix) if offsets is None else offsets
    kind = matrix.schema["by_month"].dataType.valueType
    return matrix.select("cohort_month", *[
        F.coalesce(F.try_element_at("by_month", F.lit(o).cast(matrix.schema["by_month"].dataType.keyType)), F.lit(0).cast(kind))
        .alias(str(o)) for o in offsets])
