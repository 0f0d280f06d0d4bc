"""Shared folder, written tables, and null-safe input columns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketlens.session import ensure_checkpoint_dir


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """A fresh path below the session's checkpoint folder, which driver and executors share."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    base = configured or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/corpus-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again: lineage ends there.

    A lost executor then costs a re-read.  Both sides of a later join become
    plain scans, whose shuffles the adaptive skew-join rule can split.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_at(df: DataFrame) -> tuple[DataFrame, str]:
    """The same with the table's path, for ``removed``; the shuffle files of its job go when it ends."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table that ``written_at`` made and that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def column(df: DataFrame, name: str, kind: str) -> Column:
    """Column ``name`` as ``kind``, or a typed null when the table lacks it."""
    return F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)


def documents(df: DataFrame, *extra: str) -> DataFrame:
    """``doc_id`` and ``text`` (and ``extra`` string columns) only: other columns cannot clash."""
    return df.select(column(df, "doc_id", "bigint").alias("doc_id"), column(df, "text", "string").alias("text"),
                     *[column(df, c, "string").alias(c) for c in extra])


def text_bytes(df: DataFrame, name: str = "text") -> int:
    """UTF-8 bytes of a text column over all rows (one aggregate)."""
    return int(df.agg(F.sum(F.octet_length(name))).first()[0] or 0)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
