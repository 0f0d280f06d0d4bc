"""Exact money arithmetic at large totals, white-space stripping, matrix offsets and hot persons."""

from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from basketlens.functions.numeric import money_mean, money_mean_dec, money_pct
from basketlens.operators import clean, cohorts
from basketlens.operators.skew import all_salts, heavy_values

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("total,count", [("0.05", 3), ("-12.35", 2), ("50000000000.00", 1000), ("99999999999.99", 7),
                                         ("1000000000000000.01", 12345), ("100000000000000000.03", 99999)])
def test_money_at_any_size(spark, total, count):
    df = spark.createDataFrame([(Decimal(total), count, Decimal(total) * 3)], "s decimal(28,2), n bigint, d decimal(28,2)")
    r = df.select(money_mean("s", "n", 2).alias("m2"), money_mean("s", "n", 6).alias("m6"),
                  money_mean_dec("s", "n").alias("dec"), money_pct("s", "d").alias("pct")).first()
    exact = Decimal(total) / count
    up = lambda places: exact.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)
    assert r.m2 == float(up(2)) and r.m6 == pytest.approx(float(up(6)), rel=1e-15)
    assert r.dec == up(6) and r.pct == 33.33


def test_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(Decimal("5.00"), 0)], "s decimal(28,2), n bigint")
    assert df.select(money_mean("s", "n")).first()[0] is None


def test_city_is_stripped_of_all_white_space(spark):
    df = spark.createDataFrame([(1, "\tRio\n", "rj"), (2, " São Paulo \r", "sp"), (3, None, None), (4, " \t", "x")],
                               "customer_id int, customer_city string, customer_state string")
    got = {r.customer_id: r.customer_city for r in clean.standardize_customers(df).collect()}
    assert got == {1: "rio", 2: "sao paulo", 3: None, 4: ""}


def _orders(spark, n=400):
    return spark.range(n).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("customer_unique_id"),
        F.lit("delivered").alias("order_status"),
        F.timestamp_add("DAY", (F.col("id") % 200).cast("int"), F.lit("2020-01-15 10:00:00").cast("timestamp_ntz"))
        .alias("order_purchase_timestamp"), F.lit(10).cast("decimal(28,2)").alias("order_revenue"))


def test_matrices_are_as_wide_as_the_data(spark):
    """Order months up to six after the first; a late order widens the map and the sink's columns, and is no error."""
    orders = _orders(spark)
    late = orders.limit(1).withColumn("order_id", F.lit(9999).cast("long")).withColumn(
        "order_purchase_timestamp", F.lit("2035-03-01 00:00:00").cast("timestamp_ntz"))
    for matrix in (cohorts.cohort_retention_matrix, cohorts.cohort_revenue_matrix):
        narrow, wide = matrix(orders), matrix(orders.unionByName(late))
        assert cohorts.observed_offsets(narrow) == list(range(7))
        assert cohorts.observed_offsets(wide)[-1] > 150
        table = cohorts.matrix_columns(wide)
        assert table.columns == ["cohort_month", *map(str, cohorts.observed_offsets(wide))]
        cells = {(r.cohort_month, r.months_since_first_purchase): (r.retention_pct, r.revenue_retention_pct)
                 for r in cohorts.cohort_retention_long(orders.unionByName(late)).collect()}
        pick = 0 if matrix is cohorts.cohort_retention_matrix else 1
        for r in table.collect():
            assert all(r[str(o)] == cells.get((r.cohort_month, o), (0.0, 0.0))[pick] for o in cohorts.observed_offsets(wide))


def test_hot_person_is_split(spark):
    """A person with half of all orders is dealt to several groups, no order is lost, and no other person is repeated."""
    orders = _orders(spark, 4000)
    assert orders.select(heavy_values(orders, "customer_unique_id").alias("h")).first().h == [7]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        got = cohorts.cohort_assign(orders)
        parts = {(r.p, r.hot): r.n for r in got.groupBy(F.spark_partition_id().alias("p"), (F.col("customer_unique_id") == 7).alias("hot"))
                 .agg(F.count("*").alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[0])
        spark.conf.set("spark.sql.adaptive.enabled", old[1])
    hot = [n for (_, is_hot), n in parts.items() if is_hot]
    assert sum(parts.values()) == 4000 and sum(hot) == 2001 and len(hot) >= 3 and max(hot) < 1000
    heavy = heavy_values(orders, "customer_unique_id")
    people = orders.select("customer_unique_id").distinct()
    repeated = people.select("customer_unique_id", F.explode(all_salts(heavy, "customer_unique_id", 16)).alias("s"))
    assert repeated.count() == people.count() + 15


def test_heavy_values_of_strings_nulls_and_nothing(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "often").when(F.col("id") % 3 == 1, None)
                                    .otherwise(F.col("id").cast("string")).alias("k"))
    assert rows.select(heavy_values(rows, "k").alias("h")).first().h == ["often"]
    assert not (spark.range(1).select(heavy_values(rows.limit(0), "k").alias("h")).first().h or [])


def test_no_jobs_while_plans_are_built(spark):
    from basketlens.plans.model import Model
    from basketlens.operators import churn
    m = Model.from_testdata(spark, SF)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        m.orders, m.customers, churn.churn_trend(m.orders), cohorts.cohort_retention_matrix(m.orders)
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
