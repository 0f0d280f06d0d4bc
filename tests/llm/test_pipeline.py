"""Every pipeline stage, and the whole run, on a small table with planted cases, against brute force."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import decontaminate
from tests.llm.test_operators import brute_near

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Generated documents and: nulls, no letters, near copies, one id with two texts, a shared passage, a leak, taken column names."""
    folder = str(tmp_path_factory.mktemp("pipe"))
    base = spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en' and length(text) < 6000").limit(60)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    rng = np.random.default_rng(3)
    known = sorted({w for r in base.collect() for w in r.text.split()})
    prose = lambda n: " ".join(rng.choice(known, n))
    shared, copied = prose(55), prose(120)
    rows = [(90001, None, "en"), (90002, "", "en"), (90003, "123 456 $$", "en"), (90004, copied, "en"), (90005, copied + " tail", "en"),
            (90006, copied, None), (90007, prose(40) + " " + shared + " " + prose(40), "en"), (90008, prose(50) + " " + shared, "en"),
            (90009, prose(60) + " " + item + " " + prose(20), "en"), (90010, prose(70), "en"), (90010, prose(80), "en"),
            (None, prose(90), "en"), (90011, prose(8000), "en")]
    extra = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    docs = (base.select("doc_id", "text", "lang").unionByName(extra).withColumn("source", F.lit("s"))
            .withColumn("n_chars", F.length("text").cast("bigint")).withColumns({"said": F.lit(1), "text_hash": F.lit(2), "kept": F.lit("k")}))
    docs.coalesce(3).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    return folder, spark.read.parquet(f"{folder}/documents.parquet")


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_language_stage(spark, planted):
    import corpus_pipeline
    folder, docs = planted
    got = corpus_pipeline.identified(spark, docs, folder)
    assert got.columns == docs.columns
    gone = bag(docs, "doc_id", "text") - bag(got, "doc_id", "text")
    # all texts are English prose: only those without a letter have no language
    assert {i for i, _ in gone} == {90001, 90002, 90003} and not bag(got, *docs.columns) - bag(docs, *docs.columns)


def test_near_duplicate_stage(spark, planted):
    import corpus_pipeline
    folder, docs = planted
    got = corpus_pipeline.without_near_duplicates(spark, docs, folder)
    assert got.columns == docs.columns
    rows = [r.asDict() for r in docs.where("doc_id is not null").collect()]
    unique = [r for r in rows if r["doc_id"] != 90010]
    component = brute_near(unique, 5, 80)
    expected = {r["doc_id"] for r in unique if component[r["doc_id"]][1] == r["doc_id"]} | {90010, None}
    assert {r.doc_id for r in got.collect()} == expected and {90004, 90005, 90006} & expected == {90004}
    assert got.where("doc_id = 90010").count() == 2  # both texts of a repeated id stay
    repeated = docs.unionAll(docs.where("doc_id = 90010"))
    assert corpus_pipeline.without_near_duplicates(spark, repeated, folder).where("doc_id = 90010").count() == 2


def test_leak_stage(spark, planted):
    import corpus_pipeline
    folder, docs = planted
    got = corpus_pipeline.without_leaks(spark, docs, folder)
    assert got.columns == docs.columns
    low = lambda t: " ".join((t or "").lower().split())
    items = [low(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in docs.where("doc_id is not null and length(text) < 2500").collect()
             if any(decontaminate.best_distance(i, low(r.text)) <= int(0.2 * len(i)) for i in items)}
    assert 90009 in leaks
    short = {r.doc_id for r in got.where("length(text) < 2500 or text is null").collect()}
    assert short == {r.doc_id for r in docs.where("length(text) < 2500 or text is null").collect()} - leaks


def test_run_and_packing_stage(spark, planted):
    import corpus_pipeline
    folder, docs = planted
    made = []
    stages = corpus_pipeline.STAGES
    assert [n for n, _ in stages] == ["language id", "near-duplicates", "repeated strings", "benchmark leaks", "packing"]
    now = docs
    for _, stage in stages[:4]:
        now = corpus_pipeline.written(stage(spark, now, folder))
        made.append(now)
    left = {r.doc_id: r.text for r in made[3].collect()}
    assert not {90001, 90002, 90003, 90005, 90006, 90009} & set(left)
    assert len(left[90007].split()) == 135 and len(left[90008].split()) == 50  # the later copy of the shared passage is gone
    from tests.llm.test_sequences import plain_ids
    expected = Counter()
    for r in made[3].collect():
        ids = plain_ids([r.text], 1)[0]
        expected[r.doc_id, len(ids)] += len(ids)
    got = corpus_pipeline.run(spark, folder).collect()
    pieces = Counter()
    for r in got:
        pieces[r.doc_id, r.doc_tokens] += r.length
    assert pieces == expected
    whole = [r for r in got if r.length == r.doc_tokens and r.doc_id not in (None, 90010)]
    assert whole and all(r.ids_crc32 == zlib.crc32(np.array(plain_ids([left[r.doc_id]], 1)[0], "<u4").tobytes()) for r in whole)


def test_run_on_an_empty_table(spark, planted, tmp_path):
    import corpus_pipeline
    folder, docs = planted
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
