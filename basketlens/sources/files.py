"""I1 ``read_raw`` / ``split_raw`` and I14 ``write_table`` / ``write_extract`` / person-bucketed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.operators.skew import heavy_values, salt

TIMESTAMP = "yyyy-MM-dd HH:mm:ss"
REJECT = "_rejected_line"
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def _csv(spark: SparkSession, schema: T.StructType, timestamp_format: str, multi_line: bool):
    return (spark.read.schema(schema)
            .option("header", True)
            .option("multiLine", multi_line)
            .option("quote", '"')
            .option("escape", '"')
            .option("encoding", "UTF-8")
            .option("timestampNTZFormat", timestamp_format)
            .option("timestampFormat", timestamp_format)
            .option("mode", "PERMISSIVE"))


def read_raw(spark: SparkSession, path: str, schema: T.StructType,
             timestamp_format: str = TIMESTAMP, multi_line: bool = False) -> DataFrame:
    """Header CSV with optional double quotes, doubled-quote escapes, CRLF, UTF-8 BOM;
    empty fields read as NULL; fixed schema (never inferred).  A field that does not fit its
    type reads as NULL; ``split_raw`` keeps such lines apart.

    ``multi_line`` allows newlines inside quoted fields (the review texts) and makes every
    file one split; without it files are split.
    """
    return _csv(spark, schema, timestamp_format, multi_line).csv(path)


def split_raw(spark: SparkSession, path: str, schema: T.StructType, folder: str,
              timestamp_format: str = TIMESTAMP, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """The good rows and the rejected lines of raw files, parsed in one pass.

    A line is rejected if it has too few or too many fields or one that does not fit its type.
    Both kinds are written below ``folder`` (Parquet, apart by a partition column), so together
    they are all lines of the files.  Rejects have the line as it stood and its file.
    """
    with_line = T.StructType([*schema.fields, T.StructField(REJECT, T.StringType())])
    # all columns are read: a field is only checked where it is parsed
    rows = (_csv(spark, with_line, timestamp_format, multi_line).option("columnNameOfCorruptRecord", REJECT)
            .option("columnPruning", False).csv(path)
            .withColumn("_file", F.when(F.col(REJECT).isNotNull(), F.col("_metadata.file_path")))
            .withColumn("_is_rejected", F.col(REJECT).isNotNull()))
    # a task keeps both files open: it would sort its rows by the partition column otherwise
    before = spark.conf.get(OPEN_WRITERS, None)
    spark.conf.set(OPEN_WRITERS, 2)
    try:
        rows.write.mode("overwrite").partitionBy("_is_rejected").parquet(folder)
    finally:
        spark.conf.unset(OPEN_WRITERS) if before is None else spark.conf.set(OPEN_WRITERS, before)
    stored = spark.read.schema(T.StructType([*with_line.fields, T.StructField("_file", T.StringType()),
                                             T.StructField("_is_rejected", T.BooleanType())])).parquet(folder)
    return (stored.where(~F.col("_is_rejected")).select(*[f.name for f in schema.fields]),
            stored.where("_is_rejected").select(F.col(REJECT).alias("line"), F.col("_file").alias("file")))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """Hand-off table: Parquet, written in parallel, optionally partitioned (e.g. by order_month).

    A rebalance gathers a partition value's rows before they are written and
    splits large ones by size, so files grow with the data, not with tasks x values.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_extract(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """Dashboard extract as CSV with header.

    ``single_file`` is meant for aggregate-sized results only (segments, months,
    states); row-sized tables are written by every task in parallel.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)


def write_observed(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Write each table to ``folder``/<name> and return its row count, taken while it is written (no further scan)."""
    counts = {}
    for name, df in tables.items():
        seen = Observation()
        write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{folder.rstrip('/')}/{name}")
        counts[name] = seen.get["rows"]
    return counts


def write_bucketed(df: DataFrame, table: str, path: str, by: str, spread: str, buckets: int,
                   sort_by: tuple = (), salts: int = 16) -> DataFrame:
    """Write ``df`` as table ``table`` at ``path``, bucketed and sorted by ``by``; returns the table.

    Aggregates and joins by ``by`` then need no shuffle.  A bucket is one file, but for those of
    values on 1/256 of the rows or more: their rows are dealt to ``salts`` tasks by ``spread``
    and lie in as many files.  (A scan by bucket still reads such a bucket in one task.)
    """
    heavy = heavy_values(df, by)
    bucket = F.pmod(F.hash(by), F.lit(buckets))   # the hash of Spark's bucketed tables
    (df.repartition(buckets, bucket, salt(heavy, by, spread, salts))
     .write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, by).sortBy(by, *sort_by).saveAsTable(table))
    return df.sparkSession.table(table)


def attach_bucketed(spark: SparkSession, table: str, path: str, schema: T.StructType, by: str, buckets: int,
                    sort_by: tuple = ()) -> DataFrame:
    """Name a table that ``write_bucketed`` has written in the catalog of another session."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    order = ", ".join(f"`{c}`" for c in (by, *sort_by))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
              f"CLUSTERED BY (`{by}`) SORTED BY ({order}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)
