"""Quality rules by distribution divergence.

A document is a histogram over character classes and one over the common
words of its language.  The mean histograms of a language's documents are
its references; a document whose Jensen-Shannon distance to either
reference exceeds a limit fails.  Short documents, whose histograms are
noise, are left to the base rules alone.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import documents, written

# Frequent function words of the languages.
COMMON_WORDS = {
    "en": "the of and to in a is that for it was on are be with as by this at from".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un une du que est pour qui dans au sur par plus avec".split(),
    "es": "de la que el en y los se del las un por con una su para es al lo como".split(),
}
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
# counted classes: capitals, lower-case letters, other letters, digits, symbols, punctuation; white space is counted
# from the words, and the rest are controls, marks, replacement characters and the like
CLASSES = (r"\p{Lu}+", r"\p{Ll}+", r"[\p{L}&&[^\p{Lu}\p{Ll}]]+", r"\p{Nd}+", SYMBOLS, r"[\p{P}&&[^#*$%&|<>]]+")


def _matches(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _with_repeat_words(docs: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words that lie in a 5-word window found twice or more in the array ``words``.

    Each step is a column of its own: an expression used inside a lambda
    would be worked out again for every element.
    """
    n = F.size("words")
    docs = docs.withColumn("windows", F.when(n >= 5, F.transform(
        F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(5)]))))
    # sorted by hash, equal windows are neighbours; only documents that have any go that way
    docs = docs.withColumn("placed", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    docs = docs.withColumn("at", F.array_sort(F.filter(F.transform("placed", lambda x, j: F.when(
        (F.get(F.col("placed"), j - 1)["h"] == x["h"]) | (F.get(F.col("placed"), j + 1)["h"] == x["h"]), x["i"])),
        lambda i: i.isNotNull())))
    steps = F.transform("at", lambda a, j: F.least(F.lit(5), F.coalesce(F.get(F.col("at"), j + 1) - a, F.lit(5))))
    return docs.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(steps, F.lit(0), lambda total, x: total + x), F.lit(0)).cast("bigint"))


def features(df: DataFrame) -> DataFrame:
    """Base counts and both histograms of every document; null text has no words."""
    docs = documents(df, "lang").withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    docs = _with_repeat_words(docs)
    every = sorted({w for ws in COMMON_WORDS.values() for w in ws})
    own = F.coalesce(*[F.when(F.col("lang") == code, F.array(*map(F.lit, ws))) for code, ws in COMMON_WORDS.items()])
    docs = docs.withColumn("lines", lines).withColumn("own", own).withColumn(
        "common", F.filter("words", lambda w: w.isin(every)))
    docs = docs.withColumn("word_chars", F.length(F.array_join("words", "")))
    docs = docs.withColumn("classes", F.array(*[_matches(F.col("text"), c) for c in CLASSES],
                                              F.length("text") - F.col("word_chars")))
    return docs.select(
        "doc_id", "lang", F.size("words").cast("bigint").alias("n_words"),
        F.length("text").alias("n_chars"),
        F.col("word_chars").cast("bigint").alias("word_chars"), "classes",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
        F.transform("own", lambda w: F.size("common") - F.size(F.array_remove(F.col("common"), w))).alias("common"))


def _shares(counts: str, total: Column) -> Column:
    """The counts and the rest of ``total`` as shares; zeros when total is 0."""
    rest = F.concat(counts, F.array(total - F.aggregate(F.col(counts), F.lit(0), lambda a, x: a + x)))
    return F.transform(rest, lambda x: F.when(total > 0, F.greatest(x, F.lit(0)) / total).otherwise(F.lit(0.0)))


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two arrays of shares."""
    def part(x, y):
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    parts = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2))


def quality_verdicts(df: DataFrame, class_limit: float = 0.15, word_limit: float = 0.22,
                     class_noise: float = 1.0, word_noise: float = 0.7, min_chars: int = 200, min_words: int = 60) -> DataFrame:
    """Base counts, both distances and the verdict for every document of ``df`` (doc_id, text, lang).

    References are the mean histograms of each language's documents that
    pass the base rules and are long enough.  A histogram of few words is far
    from its reference by chance alone, so a limit is raised by its noise
    over the root of the number of words.  Every value of ``lang`` has a class
    reference (null is a group of its own; a group of one is its own
    reference); the word distance needs a word list.  A distance is null, and
    fails nobody, for a document under the minimum length, of a group without
    reference, or, by words, of a language without word list.  Ids may be null or repeat; every
    row is judged by itself.  An empty table gives an empty result.
    """
    rows = written(features(df))
    rows = rows.withColumn("n_symbols", F.get("classes", CLASSES.index(SYMBOLS)).cast("bigint")).withColumn(
        "base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    rows = rows.withColumn("p", _shares("classes", F.col("n_chars"))).withColumn(
        "w", F.when(F.col("common").isNotNull(), _shares("common", F.col("n_words").cast("int"))))
    long = (F.col("n_chars") >= min_chars) & (F.col("n_words") >= min_words)
    n, k = len(CLASSES) + 2, max(map(len, COMMON_WORDS.values())) + 1
    means = rows.where(long & ~F.col("base_failed")).groupBy("lang").agg(
        F.array(*[F.avg(F.get("p", i)) for i in range(n)]).alias("p_ref"),
        F.array(*[F.avg(F.get("w", i)) for i in range(k)]).alias("w_ref"))
    # one row per language; written, so that its size decides whether it is sent to every task
    means = written(means).withColumnRenamed("lang", "ref_lang")
    rows = rows.join(means, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    rows = rows.withColumn("class_distance", F.when(long, js_distance(F.col("p"), F.col("p_ref")))).withColumn(
        "word_distance", F.when(long, js_distance(F.col("w"), F.col("w_ref"))))
    root = F.sqrt(F.greatest("n_words", F.lit(1)))
    fits = (F.coalesce(F.col("class_distance") <= class_limit + class_noise / root, F.lit(True))
            & F.coalesce(F.col("word_distance") <= word_limit + word_noise / root, F.lit(True)))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", (~F.col("base_failed") & fits).alias("kept"),
                       "class_distance", "word_distance")
