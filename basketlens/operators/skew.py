"""Values that hold so many rows that one task should not have them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def heavy_values(df: DataFrame, column: str, share: int = 256) -> Column:
    """Values of ``column`` on at least 1/``share`` of the rows, as a one-row scalar subquery (an array).

    They come from a mergeable frequent-items summary, kept map-side in a
    bounded number of counters and merged without a shuffle of the rows.  Its
    counts are off by 1/(4 ``share``) of the rows at most and never too low, so
    no such value is missed; at most ``share`` values are returned.
    """
    top = F.expr(f"approx_top_k(`{column}`, {share}, {16 * share})")
    found = (df.where(F.col(column).isNotNull())
             .agg(top.alias("top"), F.count(F.lit(1)).alias("n")))
    often = F.filter("top", lambda x: x["count"] * share >= F.col("n"))
    return found.select(F.transform(often, lambda x: x["item"]).alias("heavy")).scalar()


def is_heavy(heavy: Column, column: str) -> Column:
    return F.coalesce(F.array_contains(heavy, F.col(column)), F.lit(False))


def salt(heavy: Column, column: str, spread: str, salts: int) -> Column:
    """0 for a row of an ordinary value; rows of a heavy one are dealt to ``salts`` groups by ``spread``."""
    return F.when(is_heavy(heavy, column), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(F.lit(0))


def all_salts(heavy: Column, column: str, salts: int) -> Column:
    """The salts under which a row of the other side of the join is wanted: one, or all of a heavy value."""
    return F.when(is_heavy(heavy, column), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
