"""Row counts of the modelled tables and a key/orphan audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of ``count(*)`` per table: ``(table_name, row_count)``."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _key(df: DataFrame, columns: tuple) -> Column:
    """One text per key value; nulls and every split of the parts stay apart."""
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
             for c in columns]
    return F.concat(*parts)


def audit(tables: dict[str, DataFrame], unique: list[tuple[str, tuple]],
          references: list[tuple[str, str, str, str]]) -> DataFrame:
    """Duplicate and orphan keys of all ``tables``: ``(table_name, check, violations)``, zeros included.

    ``unique``: (table, columns): key values found more than once, null a value of its own.
    ``references``: (table, column, parent table, parent column): rows whose non-null key has no
    parent.  Every table is read once: a row gives one (check, key) pair for each check it takes
    part in, as child or as parent, and all pairs are counted in one aggregate.
    """
    checks = [(t, f"duplicate {','.join(columns)}") for t, columns in unique]
    checks += [(t, f"orphan {column}") for t, column, _, _ in references]
    cells: dict[str, list] = {t: [] for t in tables}

    def cell(table: str, check: int, columns: tuple, child: int) -> Column:
        row = F.struct(F.lit(check).alias("check"), _key(tables[table], columns).alias("key"),
                       F.lit(child).cast("long").alias("child"), F.lit(1 - child).cast("long").alias("parent"))
        return row if check < len(unique) else F.when(F.col(columns[0]).isNotNull(), row)

    for k, (table, columns) in enumerate(unique):
        cells[table].append(cell(table, k, columns, 1))
    for k, (table, column, parent, parent_column) in enumerate(references, len(unique)):
        cells[table].append(cell(table, k, (column,), 1))
        cells[parent].append(cell(parent, k, (parent_column,), 0))
    pairs = reduce(DataFrame.unionByName, [tables[t].select(F.inline(F.array_compact(F.array(*c)))) for t, c in cells.items() if c])
    keys = pairs.groupBy("check", "key").agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"))
    bad = (F.when((F.col("check") < len(unique)) & (F.col("child") > 1), F.lit(1))
           .when((F.col("check") >= len(unique)) & (F.col("parent") == 0), F.col("child")).otherwise(F.lit(0)))
    sums = keys.agg(*[F.sum(F.when(F.col("check") == k, bad)).alias(f"_{k}") for k in range(len(checks))])
    rows = F.array(*[F.struct(F.lit(t).alias("table_name"), F.lit(check).alias("check"),
                              F.coalesce(F.col(f"_{k}"), F.lit(0)).cast("long").alias("violations"))
                     for k, (t, check) in enumerate(checks)])
    return sums.select(F.inline(rows))


def key_audit(customers: DataFrame, orders: DataFrame, items: DataFrame,
              products: DataFrame, reviews: DataFrame) -> DataFrame:
    """Primary-key duplicates and foreign-key orphans of the reference schema (not enforced by Spark)."""
    return audit(
        {"customers": customers, "orders": orders, "order_items": items, "products": products, "order_reviews": reviews},
        unique=[("customers", ("customer_id",)), ("orders", ("order_id",)), ("order_items", ("order_id", "order_item_id")),
                ("products", ("product_id",)), ("order_reviews", ("review_id",))],
        references=[("orders", "customer_id", "customers", "customer_id"), ("order_items", "order_id", "orders", "order_id"),
                    ("order_items", "product_id", "products", "product_id"), ("order_reviews", "order_id", "orders", "order_id")])
