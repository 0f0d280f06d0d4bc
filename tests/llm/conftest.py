import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Generated documents plus nulls, empties, a long text, repeated rows, ties, and extra columns with taken names."""
    base = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    line = "this licence line is the same in many texts and is rather long so that it repeats. " * 6
    rows = [(9001, None, "en", "s"), (9002, "", None, None), (9003, " \t\n", "en", "s"), (9004, "1234 $$$ 5678", "en", "s"),
            (9005, "one", "en", "s"), (9006, "One", "en", "s"), (9007, "Word " * 6000 + "end", "en", "s"),
            (9008, "alpha " + line + "omega", "en", "s"), (9009, "beta " + line + "psi", "de", "s"),
            (9010, "a b c d e f g h i j k a b c d e f g h", "fr", "t"), (9010, "a b c d e f g h i j k a b c d e f g h", "fr", "t"),
            (None, "no id but a text of several words here", "en", "s"), (9012, "über élan ñandú " * 40, "xx", "s"),
            (9013, "x퟿€😀 " * 150, "de", None)]
    edge = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return base.unionByName(edge).withColumns({
        "slice": F.lit(3), "shard": F.lit("x"), "key": F.lit(None).cast("string"), "n": F.lit(1.5),
        "a": F.lit("b"), "part": F.lit("p"), "score": F.lit(-1)}).repartition(5).cache()


@pytest.fixture(scope="session")
def rows(edge_docs):
    return [r.asDict() for r in edge_docs.select("doc_id", "text", "lang", "source").collect()]


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
