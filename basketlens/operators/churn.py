"""Churn, CLV and revenue at risk (H1-H8).

The two churn trends are computed without a loop over months and without
a months x customers product: each person contributes a handful of
(month, delta) events, the events are counted per month (a month-sized
table) and running sums over the calendar spine give the answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.dates import AS_OF_ALL_ORDERS, as_of_date, calendar_days, month_start
from basketlens.functions.numeric import half_up_ratio, money_mean, money_mean_dec, pct
from basketlens.schemas import MONEY

DELIVERED = "delivered"
PERSON = "customer_unique_id"
CHURN_DAYS = 180   # fixed value of the reference: inactivity rule in days
AOV = "decimal(20,6)"
AOV_SUM = "decimal(28,6)"


def _delivered(orders: DataFrame) -> DataFrame:
    return orders.filter((F.col("order_status") == DELIVERED) & F.col(PERSON).isNotNull())


def customer_churn_clv(rfm: DataFrame, churn_days: int = CHURN_DAYS) -> DataFrame:
    """H1: one row per person of R5: orders, CLV, AOV, days since last, churn flag, lifespan, at-risk AOV, place, tier.

    R5 already holds the delivered orders per person and its recency is the
    days since the last purchase, so no order is read again.
    """
    churned = F.col("recency_days") > churn_days
    return rfm.select(
        PERSON, "first_purchase_date", "last_purchase_date", F.col("frequency").alias("order_count"),
        F.col("monetary").alias("historical_clv"), "avg_order_value",
        F.col("recency_days").alias("days_since_last_purchase"), churned.alias("is_churned"), "customer_lifespan_days",
        F.when(churned, F.col("avg_order_value")).otherwise(F.lit(0)).cast(AOV).alias("estimated_revenue_at_risk"),
        "customer_city", "customer_state", "value_tier")


def _churn_by(churn: DataFrame, key: str) -> DataFrame:
    return (churn.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.countDistinct(PERSON).alias("customers"),
                 F.count_if(F.col("is_churned")).alias("churned_customers"),
                 F.sum("historical_clv").cast(MONEY).alias("historical_revenue"),
                 F.sum("estimated_revenue_at_risk").cast(AOV_SUM).alias("revenue_at_risk"))
            .withColumn("churn_rate_pct", pct("churned_customers", "customers")))


def churn_by_segment(churn: DataFrame) -> DataFrame:
    """H2: per value tier (null tier dropped, as a pandas group-by does)."""
    return _churn_by(churn, "value_tier")


def churn_by_region(churn: DataFrame) -> DataFrame:
    """H3: per state."""
    return _churn_by(churn, "customer_state")


def executive_kpis(churn: DataFrame, orders: DataFrame, churn_days: int = CHURN_DAYS) -> DataFrame:
    """H6: one row of headline figures (global aggregates: partial per task, one row shuffled)."""
    revenue = (orders.filter(F.col("order_status") == DELIVERED)
               .agg(F.sum("order_revenue").cast(MONEY)).scalar())
    k = churn.agg(F.countDistinct(PERSON).alias("total_customers"),
                  F.count_if(~F.col("is_churned")).alias("active_customers"),
                  F.count_if(F.col("is_churned")).alias("churned_customers"),
                  F.count("is_churned").alias("_n"),
                  F.sum("historical_clv").alias("_clv"),
                  F.count("historical_clv").alias("_nclv"),
                  F.sum("customer_lifespan_days").alias("_life"),
                  F.count("customer_lifespan_days").alias("_nlife"),
                  F.sum("estimated_revenue_at_risk").alias("_risk"))
    return k.select(
        "total_customers", "active_customers", "churned_customers",
        pct("churned_customers", "_n").alias("churn_rate_pct"),
        F.round(F.coalesce(revenue, F.lit(0).cast(MONEY)), 2).cast(MONEY).alias("revenue"),
        money_mean("_clv", "_nclv", 2).alias("average_historical_clv"),
        half_up_ratio("_life", "_nlife", 1, 2).alias("average_customer_lifespan_days"),
        F.round(F.coalesce(F.col("_risk"), F.lit(0)), 2).cast(MONEY).alias("revenue_at_risk"),
        F.lit(churn_days).alias("churn_definition_days"))


def _month_end(month: F.Column, tod_micros: F.Column) -> F.Column:
    """Timestamp of the month's last day plus a time of day (in microseconds)."""
    return F.timestamp_add("MICROSECOND", tod_micros, F.last_day(month).cast("timestamp_ntz"))


def _first_month_end_on_or_after(ts: F.Column, tod_micros: F.Column) -> F.Column:
    m = month_start(ts)
    return F.when(_month_end(m, tod_micros) >= ts, m).otherwise(F.add_months(m, 1))


def churn_trend(orders: DataFrame, churn_days: int = CHURN_DAYS, normalize: bool = False) -> DataFrame:
    """H4 (pandas flavour): month-end snapshots judged on each person's final last purchase.

    Month ends run from the first delivered purchase to the last one and carry
    the first purchase's time of day (D7); ``normalize=True`` uses midnight.
    known(m) = #persons with first <= end(m); churned(m) = #persons with
    last + (churn_days + 1) days <= end(m).  Each person is counted in the
    first month whose end passes the threshold; running sums finish the job.
    """
    d = _delivered(orders)
    v = d.groupBy(PERSON).agg(F.min("order_purchase_timestamp").alias("first"),
                              F.max("order_purchase_timestamp").alias("last"))
    spark = orders.sparkSession
    # one scalar subquery for the month-end calendar; without orders its ends are null and the spine is empty
    ends = d.agg(F.struct(F.min("order_purchase_timestamp").cast("timestamp_ntz").alias("lo"),
                          F.max("order_purchase_timestamp").cast("timestamp_ntz").alias("hi"))).scalar()
    lo, hi = ends["lo"], ends["hi"]
    midnight = lo.cast("date").cast("timestamp_ntz")
    tod = F.lit(0).cast("long") if normalize else F.timestamp_diff("MICROSECOND", midnight, lo)

    known = _first_month_end_on_or_after(F.col("first"), tod)
    churned = _first_month_end_on_or_after(F.timestamp_add("DAY", F.lit(churn_days + 1), F.col("last")), tod)
    events = (v.select(F.inline(F.array(
        F.struct(known.alias("month"), F.lit(1).alias("dk"), F.lit(0).alias("dc")),
        F.struct(churned.alias("month"), F.lit(0).alias("dk"), F.lit(1).alias("dc")))))
              .groupBy("month").agg(F.sum("dk").alias("dk"), F.sum("dc").alias("dc")))
    spine = (spark.range(1).select(F.explode(F.sequence(month_start(lo), month_start(hi),
                                                        F.expr("INTERVAL 1 MONTH"))).alias("month"))
             .filter(_month_end(F.col("month"), tod) <= hi)
             .filter(_month_end(F.col("month"), tod) >= lo))
    w = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)   # calendar-sized input
    return (spine.join(events, "month", "left")
            .select("month",
                    F.sum(F.coalesce("dk", F.lit(0))).over(w).cast("long").alias("known_customers"),
                    F.sum(F.coalesce("dc", F.lit(0))).over(w).cast("long").alias("churned_customers"))
            .withColumn("churn_rate_pct",
                        F.coalesce(pct("churned_customers", "known_customers"), F.lit(0.0))))


def churn_trend_asof(orders: DataFrame, persons: DataFrame, churn_days: int = CHURN_DAYS) -> DataFrame:
    """H5 (SQL flavour, query 10): churn judged on the last purchase *as of* each month with orders.

    For a person with active months a1 < a2 < ... and last purchase date L_i in
    a_i: known from a1 on; churned in months [month(L_i + churn_days + 1), a_{i+1}).
    Events are counted per month and summed; the spine is the set of months
    with delivered orders, as in the query.
    """
    d = orders.filter(F.col("order_status") == DELIVERED)
    cm = (d.filter(F.col(PERSON).isNotNull())
          .withColumn("order_month", month_start("order_purchase_timestamp"))
          .groupBy(PERSON, "order_month")
          .agg(F.max(F.col("order_purchase_timestamp").cast("date")).alias("last_in_month"))
          .join(persons.select(PERSON), PERSON, "left_semi"))
    w = Window.partitionBy(PERSON).orderBy("order_month")   # months per person: calendar-bounded
    cm = (cm.withColumn("prev_month", F.lag("order_month").over(w))
          .withColumn("next_month", F.lead("order_month").over(w))
          .withColumn("churn_month", F.trunc(F.date_add("last_in_month", churn_days + 1), "month")))
    starts = cm.filter(F.col("prev_month").isNull()).select(
        F.col("order_month").alias("month"), F.lit(1).alias("dk"), F.lit(0).alias("dc"))
    churn_on = cm.filter(F.col("next_month").isNull() | (F.col("churn_month") < F.col("next_month"))).select(
        F.col("churn_month").alias("month"), F.lit(0).alias("dk"), F.lit(1).alias("dc"))
    churn_off = cm.filter(F.col("next_month").isNotNull() & (F.col("churn_month") < F.col("next_month"))).select(
        F.col("next_month").alias("month"), F.lit(0).alias("dk"), F.lit(-1).alias("dc"))
    events = (starts.unionByName(churn_on).unionByName(churn_off)
              .groupBy("month").agg(F.sum("dk").alias("dk"), F.sum("dc").alias("dc")))
    spine = (d.select(month_start("order_purchase_timestamp").alias("month")).distinct()
             .withColumn("in_spine", F.lit(True)))
    allm = events.join(spine, "month", "full")
    wr = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)   # months-sized input
    res = (allm.select("month", "in_spine",
                       F.sum(F.coalesce("dk", F.lit(0))).over(wr).cast("long").alias("known_customers"),
                       F.sum(F.coalesce("dc", F.lit(0))).over(wr).cast("long").alias("churned_customers"))
           .filter(F.col("in_spine") & (F.col("known_customers") > 0)))
    return res.select(F.col("month").alias("month_start"), "known_customers", "churned_customers",
                      pct("churned_customers", "known_customers").alias("churn_rate_pct"))


def churn_by_rule_segment(segments: DataFrame) -> DataFrame:
    """H7 (query 3): per rule segment: customers, churned, churn %, revenue of churned customers; highest rate first."""
    return (segments.groupBy("customer_segment")
            .agg(F.count(F.lit(1)).alias("customers"),
                 F.sum("churned_flag").cast("long").alias("churned_customers"),
                 F.sum(F.when(F.col("churned_flag") == 1, F.col("monetary")).otherwise(F.lit(0)))
                 .cast(MONEY).alias("historical_revenue_from_churned"))
            .withColumn("churn_rate_pct", pct("churned_customers", "customers"))
            .orderBy(F.col("churn_rate_pct").desc(), "customer_segment"))


def revenue_impact_of_churn(orders: DataFrame, churn_days: int = CHURN_DAYS) -> DataFrame:
    """H8 (query 6): Active vs Churned on calendar days from the latest order date of any status.

    The AOV sum is called revenue at risk for both groups, as in the query (D8).
    """
    ref = as_of_date(orders, AS_OF_ALL_ORDERS)
    v = (_delivered(orders).groupBy(PERSON)
         .agg(F.max(F.col("order_purchase_timestamp").cast("date")).alias("last_purchase_date"),
              F.sum("order_revenue").cast(MONEY).alias("historical_clv"),
              F.count("order_revenue").alias("_cnt"))
         .withColumn("avg_order_value", money_mean_dec("historical_clv", "_cnt")))
    status = F.when(calendar_days(ref, "last_purchase_date") > churn_days, "Churned").otherwise("Active")
    return (v.withColumn("lifecycle_status", status)
            .groupBy("lifecycle_status")
            .agg(F.count(F.lit(1)).alias("customers"),
                 F.sum("historical_clv").cast(MONEY).alias("historical_revenue"),
                 F.sum("avg_order_value").cast(AOV_SUM).alias("estimated_revenue_at_risk"),
                 F.count("historical_clv").alias("_n"))
            .withColumn("avg_historical_clv",
                        half_up_ratio((F.col("historical_revenue") * 100).cast("long"), F.col("_n") * 100, 1, 6))
            .drop("_n"))
