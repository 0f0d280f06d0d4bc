"""Exact global ranking without a single-partition window.

``global_row_number`` gives every row its exact position 1..n in a total
order.  Plan: one range shuffle on the sort keys (balanced by sampling; the
keys end with a unique id, so even a value shared by most rows is split
across partitions), a sort inside each partition, a position tag, a
reliable checkpoint (so the second pass sees the very same partitions even
after an executor loss), per-partition counts (one row per partition),
prefix sums over those counts and a broadcast join of that partition-sized
table.  ``ORDER BY .. ROW_NUMBER()`` without PARTITION BY would instead
move every row into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.operators.selection import select_ranks
from basketlens.session import reliable_checkpoint

_POS_BITS = 33  # monotonically_increasing_id = partition index << 33 | position in partition


def _ranged(df: DataFrame, order: list[Column], num_partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``order`` with a position tag ``_mid``, checkpointed."""
    n_parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return reliable_checkpoint(df.repartitionByRange(n_parts, *order)
                               .sortWithinPartitions(*order)
                               .withColumn("_mid", F.monotonically_increasing_id()))


def global_row_number(df: DataFrame, order: list[Column], out: str = "row_number",
                      total: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = exact 1-based position under ``order`` (must be a total order).

    ``total`` (optional) adds the row count n as a column.
    """
    tagged = (_ranged(df, order, num_partitions).withColumn("_pid", F.shiftright("_mid", _POS_BITS))
              .withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid"), _POS_BITS) + 1))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # at most one row per partition: a window without PARTITION BY is fine here
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid",
                            F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_offset"),
                            F.sum("_cnt").over(Window.partitionBy(F.lit(1))).alias("_total"))
    res = (tagged.join(F.broadcast(offsets), "_pid")
           .withColumn(out, F.col("_offset") + F.col("_local")))
    if total:
        res = res.withColumn(total, F.col("_total"))
    return res.drop("_mid", "_pid", "_local", "_offset", "_total")


def qcut_last_rank(n: int, label: int, q: int = 5) -> int:
    """Last of ranks 1..n with a label of at most ``label`` when pandas ``qcut`` cuts ``rank(method='first')``.

    The label of rank r is ceil(q (r-1) / (n-1)), at least 1.
    """
    return label * (n - 1) // q + 1 if n else 0


def ntile_last_rank(n: int, label: int, q: int = 5) -> int:
    """Last of ranks 1..n in the first ``label`` buckets of SQL ``NTILE(q)``: the first n mod q have one more row."""
    return label * (n // q) + min(label, n % q)


def _is_after(value: Column, row_id: Column, at: Column, at_id: Column, descending: bool) -> Column:
    """Whether (value, id) sorts after (at, at_id): nulls first ascending, last descending; ids ascending."""
    beyond = (value < at) if descending else (value > at)
    null_beyond = (value.isNull() & at.isNotNull()) if descending else (value.isNotNull() & at.isNull())
    id_beyond = F.coalesce(row_id > at_id, row_id.isNotNull() & at_id.isNull())
    return F.coalesce(beyond, F.lit(False)) | null_beyond | (value.eqNullSafe(at) & id_beyond)


def quantile_scores(df: DataFrame, specs: list[tuple[str, Column, bool]], id_col: str,
                    method: str = "qcut", q: int = 5, materialize_input: bool = True) -> DataFrame:
    """Add one score column per ``(out_col, value, descending)`` spec.

    Ties are broken by ``id_col`` ascending, also for descending values (D20).
    The q - 1 pairs (value, id) where a score ends are found by histograms
    (``selection.select_ranks``) and compared with each row: the rows are
    neither sorted, shuffled nor joined.  ``materialize_input`` checkpoints
    the (person-sized) input first, as every pass reads it.
    """
    last_rank = qcut_last_rank if method == "qcut" else ntile_last_rank
    if materialize_input:
        df = reliable_checkpoint(df)
    found = select_ranks(df, [(value, down) for _, value, down in specs], id_col,
                         lambda n: [[last_rank(n, label, q) for label in range(1, q)]] * len(specs))
    kinds = [f.dataType for f in df.select(*[v for _, v, _ in specs]).schema.fields]
    id_kind = df.schema[id_col].dataType
    for i, (out, value, down) in enumerate(specs):
        passed = [_is_after(value, F.col(id_col), F.lit(at).cast(kinds[i]), F.lit(at_id).cast(id_kind), down).cast("int")
                  for at, at_id in found[i]]
        df = df.withColumn(out, sum(passed, F.lit(1)))
    return df


def top_customers(orders: DataFrame, persons: DataFrame, n: int = 100,
                  delivered: str = "delivered") -> DataFrame:
    """V1: top n customers by delivered revenue with global RANK and per-state DENSE_RANK.

    Every customer whose revenue is above a survivor's also survives the
    ordered limit, so both ranks computed over the n survivors equal the
    ranks over all customers.  ``orderBy().limit()`` plans TakeOrdered: each
    task keeps n rows, so the single final merge sees n x tasks rows.
    """
    per = (orders.filter(F.col("order_status") == delivered)
           .groupBy("customer_unique_id")
           .agg(F.countDistinct("order_id").alias("orders_count"),
                F.sum("order_revenue").alias("total_revenue"),
                F.count("order_revenue").alias("_cnt")))
    cr = (persons.select("customer_unique_id", "customer_state", "customer_city")
          .join(per, "customer_unique_id", "inner")
          .withColumn("total_revenue", F.col("total_revenue").cast("decimal(18,2)"))
          .withColumn("avg_order_value", _money_mean6("total_revenue", "_cnt"))
          .drop("_cnt"))
    top = cr.orderBy(F.col("total_revenue").desc(), F.col("customer_unique_id").asc()).limit(n)
    return (top.withColumn("revenue_rank", F.rank().over(Window.orderBy(F.col("total_revenue").desc())))
            .withColumn("state_revenue_rank",
                        F.dense_rank().over(Window.partitionBy("customer_state")
                                            .orderBy(F.col("total_revenue").desc()))))


def _money_mean6(sum_col: str, cnt_col: str) -> Column:
    from basketlens.functions.numeric import money_mean
    return money_mean(sum_col, cnt_col, digits=6)
