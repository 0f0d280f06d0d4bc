"""Documents to packed training windows: language id, near-duplicates, repeated strings, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet into the shared folder and reads it again for the next
stage.  All but the last keep the columns of ``documents``.  Null texts have
no language and go in the first stage.  Rows without an id cannot be told
apart by it: they all stay in the second stage and match nothing in the
fourth.  Of rows that repeat an id, the second stage keeps one of each text.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketlens.llm import decontaminate, language, neardup, packing, repeats
from basketlens.llm.catalog import tokenizer_path
from basketlens.llm.common import documents, read, written

MIN_SCORE = 0.5
#: Rows that go to a Python worker at a time: a few megabytes of ordinary documents, in the worker and in the JVM beside it.
BATCH_ROWS = 2000


def spare(docs: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    while name in docs.columns:
        name += "_"
    return name


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose most likely language has a calibrated probability of MIN_SCORE at least."""
    train = documents(docs, "lang").where(F.col("doc_id").isNotNull() & (language.remainder("doc_id", 3) != 1))
    said = language.predicted(language.fit(train))(F.col("text"))
    name = spare(docs, "said")
    return (docs.withColumn(name, said).where((F.col(f"{name}.lang_pred") != language.UNDETERMINED)
                                              & (F.col(f"{name}.score") >= MIN_SCORE)).drop(name))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at a similarity of 0.8."""
    kept = neardup.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id")
    alone = docs.join(kept, "doc_id", "left_semi").withColumn(text := spare(docs, "text_hash"), F.xxhash64("text"))
    alone = alone.dropDuplicates(["doc_id", text])
    return alone.select(*docs.columns).unionAll(docs.where("doc_id is null"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of 400-byte strings and of runs of over 50 words cut out; documents that lose all their words go."""
    carry = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    out = repeats.remove_repeats(docs, with_text=True, carry=carry, words=51)
    out = out.where(~((F.col("n_removed") > 0) & ~F.col("kept_text").rlike(r"\S")))
    out = out.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("text").cast("bigint"))
    return out.select(*docs.columns)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    leaks = decontaminate.benchmark_matches(docs, read(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 2048 tokens."""
    return packing.retrieval_packing(docs, tokenizer_path())


def in_small_batches(stage):
    """The stage with ``BATCH_ROWS`` rows in an Arrow batch; the setting stays, as the stage's rows are made later."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)
    return run_stage


STAGES = [(name, in_small_batches(stage)) for name, stage in (
    ("language id", identified), ("near-duplicates", without_near_duplicates), ("repeated strings", without_repeats),
    ("benchmark leaks", without_leaks), ("packing", packed))]
#: No stage can be told in SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
