"""SQL access: the modelled tables as temp views under the reference's table names.

After ``register_views(model)`` analytical SQL written against the
reference schema runs through ``spark.sql`` (Catalyst plans it like the
DataFrame operators; MySQL-only functions need their Spark names, e.g.
``date_format(ts, 'yyyy-MM-01')`` or ``trunc(ts, 'MM')`` for month starts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketlens.operators import clean, facts
from basketlens.plans.model import Model


def modelled_tables(m: Model) -> dict[str, DataFrame]:
    """SQL-flavour modelled tables (inner join of orders to customers, validated items, deduplicated reviews)."""
    orders = clean.orders_clean(m.raw_orders, m.customers, m.raw_items, how="inner")
    customers = clean.customers_dim(m.customers, m.raw_orders)
    products = clean.products_clean(m.raw_products, m.raw_translations, flavour="sql")
    return {
        "customers": customers,
        "products": products,
        "orders": orders,
        "order_items": clean.items_valid(m.raw_items, orders, products),
        "order_reviews": clean.reviews_dedup(m.raw_reviews, orders),
        "customer_order_summary": facts.customer_order_summary(customers, orders),
    }


def register_views(m: Model, prefix: str = "") -> list[str]:
    names = []
    for name, df in modelled_tables(m).items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
