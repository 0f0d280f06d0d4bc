"""Revenue, repeat and return behaviour."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.dates import month_start
from basketlens.functions.numeric import cents, pct
from basketlens.schemas import MONEY

DELIVERED = "delivered"
PERSON = "customer_unique_id"


def _min_gaps(orders: DataFrame) -> DataFrame:
    """Per person with delivered orders: row count and smallest calendar-day gap between consecutive orders.

    Consecutive orders by time are 0 days apart on a date holding two or more
    orders, otherwise as far apart as consecutive order dates.  So the work
    is done on the (person, date) grain, whose size per person is bounded by
    the calendar: a window over it never sees an order-sized group.
    """
    pd_ = (orders.filter((F.col("order_status") == DELIVERED) & F.col(PERSON).isNotNull())
           .groupBy(PERSON, F.col("order_purchase_timestamp").cast("date").alias("day"))
           .agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy(PERSON).orderBy("day")
    gaps = (pd_.withColumn("prev_day", F.lag("day").over(w))
            .withColumn("gap", F.least(F.when((F.col("n") > 1) & F.col("day").isNotNull(), F.lit(0)),
                                       F.datediff("day", "prev_day"))))
    return gaps.groupBy(PERSON).agg(F.sum("n").alias("orders"), F.min("gap").alias("min_gap"))


def return_windows(orders: DataFrame, days: tuple[int, ...] = (30, 60, 90)) -> DataFrame:
    """V2 (query 4): among customers with two or more delivered orders, % that ever came back within d days."""
    g = _min_gaps(orders).filter(F.col("orders") >= 2)
    aggs = [F.count(F.lit(1)).alias("returning_customers")]
    aggs += [F.count_if(F.col("min_gap") <= d).alias(f"_r{d}") for d in days]
    r = g.agg(*aggs)
    return r.select("returning_customers",
                    *[pct(f"_r{d}", "returning_customers").alias(f"returned_within_{d}_days_pct") for d in days])


def return_rate_all_customers(orders: DataFrame, days: int = 90) -> DataFrame:
    """Share of *all* delivered-order customers that came back within ``days``."""
    g = _min_gaps(orders)
    r = g.agg(F.count(F.lit(1)).alias("delivered_customers"),
              F.count_if((F.col("orders") >= 2) & (F.col("min_gap") <= days)).alias(f"returned_within_{days}_days"))
    return r.withColumn(f"returned_within_{days}_days_pct",
                        pct(f"returned_within_{days}_days", "delivered_customers"))


def region_repeat_rate(persons: DataFrame, orders: DataFrame, min_customers: int = 100) -> DataFrame:
    """V3 (query 5): per state customers, repeat customers (>= 2 delivered orders), rate; small states dropped, highest rate first.

    The delivered test sits in the join condition of the query, i.e. the right
    side is filtered first; orders are counted per person before the join.
    """
    per = (orders.filter((F.col("order_status") == DELIVERED) & F.col(PERSON).isNotNull())
           .groupBy(PERSON).agg(F.countDistinct("order_id").alias("order_count")))
    act = (persons.select("customer_state", PERSON).join(per, PERSON, "left")
           .withColumn("order_count", F.coalesce("order_count", F.lit(0))))
    return (act.groupBy("customer_state")
            .agg(F.count(F.lit(1)).alias("customers"),
                 F.count_if(F.col("order_count") >= 2).alias("repeat_customers"))
            .filter(F.col("customers") >= min_customers)
            .withColumn("repeat_customer_rate_pct", pct("repeat_customers", "customers"))
            .orderBy(F.col("repeat_customer_rate_pct").desc(), "customer_state"))


def monthly_revenue(orders: DataFrame) -> DataFrame:
    """V4 (query 9): per month orders, customers, revenue, running total, prior month, MoM %.

    Orders are reduced per (month, person) first: one distinct count there
    and none per month, so no row is expanded.  An order has one person (the
    key audit I5 checks it).  The windows run over the month-sized table (a
    window without PARTITION BY is bounded by the calendar).
    """
    m = (orders.filter(F.col("order_status") == DELIVERED)
         .groupBy(month_start("order_purchase_timestamp").alias("revenue_month"), PERSON)
         .agg(F.countDistinct("order_id").alias("_orders"), F.sum("order_revenue").alias("_revenue"))
         .groupBy("revenue_month")
         .agg(F.sum("_orders").alias("orders_count"),
              F.count(PERSON).alias("active_customers"),
              F.sum("_revenue").cast(MONEY).alias("revenue")))
    w = Window.orderBy("revenue_month")
    prior = F.lag("revenue").over(w)
    return (m.withColumn("running_revenue",
                         F.sum("revenue").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast(MONEY))
            .withColumn("prior_month_revenue", prior)
            .withColumn("mom_revenue_growth_pct",
                        pct(cents(F.col("revenue")) - cents(F.col("prior_month_revenue")),
                            cents(F.col("prior_month_revenue")))))


def revenue_by_month(orders: DataFrame) -> DataFrame:
    """B2: monthly revenue line."""
    return monthly_revenue(orders).select("revenue_month", "revenue", "running_revenue")


def returning_customers_by_month(orders: DataFrame) -> DataFrame:
    """Per month, active customers split into new (first month) and returning (earlier first month)."""
    pm = (orders.filter((F.col("order_status") == DELIVERED) & F.col(PERSON).isNotNull())
          .groupBy(PERSON, month_start("order_purchase_timestamp").alias("order_month"))
          .agg(F.count(F.lit(1)).alias("_n")))
    w = Window.partitionBy(PERSON)   # person-month grain: calendar-bounded per person
    pm = pm.withColumn("first_month", F.min("order_month").over(w))
    return (pm.groupBy("order_month")
            .agg(F.count(F.lit(1)).alias("active_customers"),
                 F.count_if(F.col("first_month") == F.col("order_month")).alias("new_customers"),
                 F.count_if(F.col("first_month") < F.col("order_month")).alias("returning_customers"))
            .withColumn("returning_pct", pct("returning_customers", "active_customers")))
