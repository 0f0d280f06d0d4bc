"""Reference-style SQL over the registered views agrees with the DataFrame operators."""

from basketlens.operators import revenue
from basketlens.plans.model import Model
from basketlens.plans.views import register_views

SF = "/root/testdata/sf0.001"


def test_sql_over_views_matches_operators(spark):
    m = Model.from_testdata(spark, SF)
    assert "customer_order_summary" in register_views(m)
    sql = spark.sql("""
        SELECT customer_state, count(*) AS customers, count_if(delivered > 1) AS repeat_customers
        FROM (SELECT first(c.customer_state) AS customer_state, count_if(o.order_status = 'delivered') AS delivered
              FROM orders o RIGHT JOIN customers c USING (customer_unique_id)
              GROUP BY customer_unique_id)
        GROUP BY ALL""")
    got = sorted((r.customer_state, r.customers, r.repeat_customers) for r in sql.collect())
    op = revenue.region_repeat_rate(spark.table("customers"), spark.table("orders"), min_customers=1)
    assert got == sorted((r.customer_state, r.customers, r.repeat_customers) for r in op.collect())
    monthly = spark.sql("""
        SELECT trunc(order_purchase_timestamp, 'MM') AS revenue_month, COUNT(DISTINCT order_id) AS orders_count,
               SUM(order_revenue) AS revenue
        FROM orders WHERE order_status = 'delivered' GROUP BY 1""")
    exp = {r.revenue_month: (r.orders_count, r.revenue)
           for r in revenue.monthly_revenue(spark.table("orders")).collect()}
    assert {r.revenue_month: (r.orders_count, r.revenue) for r in monthly.collect()} == exp
    rows = spark.sql("SELECT count(*) AS n FROM customer_order_summary").first().n
    assert rows == spark.table("customers").count()
