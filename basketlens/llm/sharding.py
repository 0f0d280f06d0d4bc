"""Proportional stratified interleaving of rows into shards of equal row count.

Rows of each source are put in a seeded random order; row number r of a
source with n rows stands at (r - 0.5) / n.  Sorted by that fraction, every
stretch of the whole holds the sources in proportion, so cutting the order
into equal stretches gives shards that all match the mixture.

Both exact ranks (within a source, and over all rows) are found without a
window over a whole source: rows fall into equal slices of the random order
(then of the fraction), slices are counted, and a row's rank is the count
of the slices before its own plus its rank inside it.  There are as many slices
as keep one at about ``slice_rows`` rows, however large the table or a source is.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import column, written

NULL_SOURCE = "\u0000"


def _earlier(counts: DataFrame, by: list, at: str) -> DataFrame:
    """Adds how many rows stand in earlier slices, and in all, to a table of one row per slice."""
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = whole.orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    return (counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
            .withColumn("total", F.sum("n").over(whole)))


def stratified_shards(df: DataFrame, shards: int = 16, seed: int = 7, slices: int | None = None,
                      slice_rows: int = 100_000) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of ``df`` (doc_id, text, source).

    ``size`` is the UTF-8 bytes of the text plus 1.  Law ``rows``: shard row
    counts differ by one at most.  ``slot`` is gapless from 0 in each shard.
    Null text counts as empty; null sources form one stratum; null ids and
    repeated rows are rows like others (rows that agree in id, size and
    checksum are interchangeable).  An empty table gives an empty result.
    """
    slices = slices or max(1024, df.count() // slice_rows)
    rows = df.select(
        column(df, "doc_id", "bigint").alias("doc_id"),
        F.coalesce(column(df, "source", "string"), F.lit(NULL_SOURCE)).alias("stratum"),
        (F.coalesce(F.octet_length(column(df, "text", "string")), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32(column(df, "text", "string").cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"))
    rows = rows.withColumn("shuffled", F.xxhash64(F.lit(seed), F.coalesce("doc_id", F.lit(-1)), "text_crc32"))
    # the high bits choose the slice, so slices follow the random order
    rows = written(rows.withColumn("slice", (F.shiftrightunsigned("shuffled", 33) * slices / F.lit(1 << 31))
                                   .cast("int")))
    # unsigned order of the hash inside a slice: flip the sign bit
    order = F.col("shuffled").bitwiseXOR(F.lit(-(1 << 63)))
    within = Window.partitionBy("stratum", "slice").orderBy(order, "doc_id", "size", "text_crc32")
    counts = _earlier(rows.groupBy("stratum", "slice").agg(F.count("*").alias("n")), ["stratum"], "slice")
    ranked = (rows.withColumn("r", F.row_number().over(within))
              .join(counts, ["stratum", "slice"])
              .select("doc_id", "size", "text_crc32", "stratum", "shuffled",
                      # integer cross-multiplication is not needed: equal doubles are broken by stratum
                      ((F.col("before") + F.col("r") - F.lit(0.5)) / F.col("total")).alias("fraction")))
    ranked = written(ranked.withColumn("cut", F.least(F.lit(slices - 1), F.floor(F.col("fraction") * slices))
                                       .cast("int")))
    cuts = _earlier(ranked.groupBy("cut").agg(F.count("*").alias("n")), [], "cut")
    inside = Window.partitionBy("cut").orderBy("fraction", "stratum", order, "doc_id", "size", "text_crc32")
    placed = (ranked.withColumn("r", F.row_number().over(inside)).join(cuts, "cut")
              .withColumn("at", F.col("before") + F.col("r") - 1)
              .withColumn("shard", F.expr(f"cast(at * {int(shards)} div total as int)")))
    first = F.expr(f"(shard * total + {int(shards) - 1}) div {int(shards)}")
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("at") - first).cast("bigint").alias("slot"))


def write_shards(df: DataFrame, assigned: DataFrame, path: str) -> None:
    """Write the rows of ``df``, one folder per shard, in slot order inside each file.

    Needs unique doc_ids; a shard is cut into files by slot range, never gathered in one task.
    """
    out = df.join(assigned.select("doc_id", "shard", "slot"), "doc_id")
    (out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard").parquet(path))
