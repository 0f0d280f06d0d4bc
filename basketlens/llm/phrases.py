"""Frequent phrases and their collocation scores, mined over persisted occurrence relations (SETM).

The relation of length k holds, in order of piece and position, each place
where a frequent phrase of k words starts, with the phrase's number.  A row of
the written table is the stretch of the relation that lies in a few megabytes
of text: one number per word, -1 where no frequent phrase starts and between
pieces.  Per length:

1. merge join: a stretch is joined with itself at the next position of the
   piece.  Both sides are in the same order in the same row, so this moves
   nothing; two phrases of k words that start one word apart make one of k + 1;
2. group-count: occurrences are counted per stretch, and the counts, not the
   occurrences, are shuffled and sorted by phrase and added;
3. semi-join: in that order each count meets its phrase's total; the rows of
   frequent phrases go back, with the phrase's number, to the stretches they
   came from, and all other occurrences leave the relation.

Phrases are known by the exact pair of numbers of the two phrases they were
joined from (words by language and spelling), never by a hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import column, removed, written, written_at
from .tokens import stretches

STRETCH_BYTES = 8 << 20
#: A place is a stretch's number and a local number in it: of 2**28 words at most, far more than a text can hold.
LOCAL_BITS, SERIAL_BITS = 28, 14
UNDETERMINED = "und"
#: Fixed values of the contract: what ends a piece.
PIECE_ENDS = r"[.,;:!?\n\x0b\x0c\r]"


def word_places(langs: pa.Array, texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array, np.ndarray]:
    """Places of a stretch: local word number or -1 per slot; and language, spelling and count of each local word."""
    lower = pc.replace_substring(pc.ascii_lower(texts), "\t", " ")
    pieces = pc.replace_substring_regex(lower, PIECE_ENDS, " \n ")
    slots = pc.split_pattern(pc.binary_join_element_wise(pieces, "\n", " "), " ")  # a text ends its last piece
    coded = slots.flatten().dictionary_encode()
    code, spelled = np.asarray(coded.indices), coded.dictionary
    lang = langs.dictionary_encode()
    of_slot = np.repeat(np.asarray(lang.indices), np.asarray(pc.list_value_length(slots)))
    full = code != pc.index(spelled, "").as_py()
    code, of_slot = code[full], of_slot[full]
    at = np.flatnonzero(code != pc.index(spelled, "\n").as_py())
    distinct, local, n = np.unique(of_slot[at].astype(np.int64) * len(spelled) + code[at], return_inverse=True,
                                   return_counts=True)
    places = np.full(len(code), -1, np.int32)
    places[at] = local
    return (places, lang.dictionary.take(pa.array(distinct // len(spelled))),
            spelled.take(pa.array(distinct % len(spelled))), n)


def packed(places: np.ndarray) -> bytes:
    """Places as compressed bytes: all first bytes of the numbers, then all second ones, and so on."""
    planes = places.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(places).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], 4 * n, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(4, n).T.copy().view("<i4").ravel()


WORDS = pa.schema([("place", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()),
                   ("stretch", pa.int64()), ("places", pa.binary())])


def _stretches(stretch_bytes: int):
    """The relation of single words: the places of each stretch, and a row for each of its words."""
    def run(batches):
        part, k = TaskContext.get().partitionId(), 0
        held, size = [], 0

        def done():
            table = pa.Table.from_batches(held).combine_chunks()
            places, langs, words, n = word_places(*(c.chunk(0) for c in table.columns))
            stretch = (part << SERIAL_BITS) + k
            local = (stretch << LOCAL_BITS) + np.arange(len(n))
            yield pa.RecordBatch.from_arrays([pa.array(local), langs, words, pa.array(n), pa.nulls(len(n), pa.int64()),
                                              pa.nulls(len(n), pa.binary())], schema=WORDS)
            yield pa.RecordBatch.from_arrays([*[pa.nulls(1, f.type) for f in list(WORDS)[:4]], pa.array([stretch]),
                                              pa.array([packed(places)], pa.binary())], schema=WORDS)

        for batch in batches:
            for first, last in stretches(batch.column(1), stretch_bytes):
                held.append(batch.slice(first, last - first))
                size += pc.sum(pc.binary_length(held[-1].column(1))).as_py()
                if size >= stretch_bytes and k < (1 << SERIAL_BITS) - 1:
                    yield from done()
                    held, size, k = [], 0, k + 1
        if held:
            yield from done()
    return run


def joined_places(places: np.ndarray, local: np.ndarray, number: np.ndarray):
    """Merge join of a stretch with itself one word on: new places, and the numbers of both parts and count of each new phrase."""
    dense = np.full(int(places.max(initial=-1)) + 2, -1, np.int64)  # its last entry serves the -1
    dense[local] = np.arange(len(local))
    kept = dense[places]
    here = np.flatnonzero((kept[:-1] >= 0) & (kept[1:] >= 0))
    key, group, n = np.unique(kept[here] * max(1, len(local)) + kept[here + 1], return_inverse=True, return_counts=True)
    longer = np.full(len(places), -1, np.int32)
    longer[here] = group
    return longer, number[key // max(1, len(local))], number[key % max(1, len(local))], n


ROWS = pa.schema([("place", pa.int64()), ("g", pa.int64()), ("h", pa.int64()), ("n", pa.int64()),
                  ("stretch", pa.int64()), ("places", pa.binary())])


def _extended(relation: pa.Table, frequent: pa.Table) -> pa.Table:
    """The relation of phrases longer by a word, of one stretch."""
    if not relation.num_rows or not frequent.num_rows:
        return ROWS.empty_table()
    stretch = relation.column("stretch")[0].as_py()
    frequent = frequent.sort_by("number")  # rows in the order of both numbers take less room
    local = frequent.column("place").to_numpy() & ((1 << LOCAL_BITS) - 1)
    longer, g, h, n = joined_places(unpacked(relation.column("places")[0].as_py()), local,
                                    frequent.column("number").to_numpy())
    if not len(n):
        return ROWS.empty_table()
    phrases = [(stretch << LOCAL_BITS) + np.arange(len(n)), g, h, n]
    return pa.table([*[pa.chunked_array([pa.array(x, pa.int64()), pa.nulls(1, pa.int64())]) for x in phrases],
                     pa.chunked_array([pa.nulls(len(n), pa.int64()), pa.array([stretch], pa.int64())]),
                     pa.chunked_array([pa.nulls(len(n), pa.binary()), pa.array([packed(longer)], pa.binary())])], schema=ROWS)


def frequent_phrases(df: DataFrame, least: int = 100, longest: int = 5,
                     stretch_bytes: int = STRETCH_BYTES) -> tuple[list, DataFrame]:
    """Tables of the phrases of 1 to ``longest`` words found ``least`` times or more, and the words of each language.

    The table of length 1 has number, lang, word, n; the others number, g, h
    (the phrases without the last and without the first word) and n.  A
    phrase's number is the least place that holds it, so it is the same
    however often a task runs.  A relation is removed when the next one is
    written.
    """
    spark = df.sparkSession
    docs = df.select(F.coalesce(column(df, "lang", "string"), F.lit(UNDETERMINED)).alias("lang"),
                     F.coalesce(column(df, "text", "string"), F.lit("")).alias("text"))
    kind = "place bigint, lang string, word string, n bigint, stretch bigint, places binary"
    relation, at = written_at(docs.mapInArrow(_stretches(stretch_bytes), kind))
    total = written(relation.where("places is null").groupBy("lang").agg(F.sum("n").alias("words")))
    found, by = [], ["lang", "word"]
    for k in range(1, longest + 1):
        # one shuffle and one sort by phrase give the counts of the groups and, merged with them, the rows that stay
        group = Window.partitionBy(*by)
        counts = (relation.where("places is null").select("place", *by, "n")
                  .withColumn("total", F.sum("n").over(group)).withColumn("number", F.min("place").over(group)))
        own = F.col("place") == F.col("number")
        kept, kept_at = written_at(counts.where(F.col("total") >= least).select(
            "place", "number", *[F.when(own, F.col(c)).alias(c) for c in (*by, "total")]))
        found.append(written(kept.where(own).select("number", *by, F.col("total").alias("n"))))
        if k < longest:
            frequent = kept.select(F.shiftright("place", LOCAL_BITS).alias("stretch"), "place", "number")
            places = relation.where("places is not null").select("stretch", "places")
            longer, longer_at = written_at(places.groupBy("stretch").cogroup(frequent.groupBy("stretch")).applyInArrow(
                _extended, "place bigint, g bigint, h bigint, n bigint, stretch bigint, places binary"))
        removed(spark, kept_at)
        removed(spark, at)
        if k < longest:
            relation, at, by = longer, longer_at, ["g", "h"]
    return found, total


def _spelled(found: list) -> list:
    """number, lang, words, n, and counts of all shorter beginnings and endings of the phrases of each length."""
    empty = F.array().cast("array<bigint>")
    out = [found[0].select("number", "lang", F.array("word").alias("words"), "n", empty.alias("begins"), empty.alias("ends"))]
    for table in found[1:]:
        left = out[-1].select(F.col("number").alias("g"), "lang", F.col("words").alias("head"), F.col("n").alias("gn"), "begins")
        right = out[-1].select(F.col("number").alias("h"), F.col("words").alias("tail"), F.col("n").alias("hn"), "ends")
        out.append(written(table.join(left, "g").join(right, "h").select(
            "number", "lang", F.concat("head", F.slice("tail", -1, 1)).alias("words"), "n",
            F.concat("begins", F.array("gn")).alias("begins"), F.concat("ends", F.array("hn")).alias("ends"), "g", "h")))
    return out


def collocations(df: DataFrame, least: int = 100, longest: int = 5, top: int = 2000,
                 stretch_bytes: int = STRETCH_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to ``longest`` words of ``df`` (lang, text).

    ``a`` counts the phrase's occurrences (``least`` or more) in pieces
    between ``.,;:!?`` and line ends, ``n`` all words of the language.  Cut
    after its first words, a phrase scores floor(1000 * a * n / (l * r)) for
    the counts of both parts; its lowest score counts (ties: the earliest
    cut).  A phrase inside a longer one that occurs as often is dropped:
    if any longer one does, so does one that is longer by a word.  The first
    ``top`` by score, ``a`` and spelling (bytes) are returned.

    Null texts are empty, null languages ``und``; ids are not looked at, so
    repeated rows count as often as they stand there.  A text lies in one
    stretch, however long.  Languages without a frequent phrase, and an empty
    table, give no rows.
    """
    found, total = frequent_phrases(df, least, longest, stretch_bytes)
    spelled = _spelled(found)
    candidates = None
    for k, table in enumerate(spelled[1:], 2):
        if k < longest:
            longer = spelled[k].select(F.explode(F.array("g", "h")).alias("number"), "n").groupBy("number").agg(F.max("n").alias("most"))
            table = table.join(longer, "number", "left").where(F.col("most").isNull() | (F.col("most") < F.col("n")))
        table = table.select("lang", "words", F.col("n").alias("a"), "begins", F.reverse("ends").alias("ends"))
        candidates = table if candidates is None else candidates.unionAll(table)
    # exact: products of counts under 10**18 have 36 digits, and a score is at most 1000 * n
    product = F.expr("cast(a as decimal(18,0)) * cast(words_in as decimal(18,0)) * 1000")
    cut = F.explode(F.transform(F.arrays_zip("begins", "ends"), lambda x, k: F.struct(x.begins.alias("l"), x.ends.alias("r"), k.alias("k"))))
    cuts = (candidates.join(total.select("lang", F.col("words").alias("words_in")), "lang")
            .withColumn("phrase", F.array_join("words", " ")).withColumn("product", product)
            .select("lang", "phrase", "a", F.col("words_in").alias("n"), "product", cut.alias("c")))
    scored = cuts.select("lang", "phrase", "a", "n", F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("c.k").alias("k"),
                         F.expr("product div (cast(c.l as decimal(18,0)) * cast(c.r as decimal(18,0)))").alias("score"))
    best = (scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
            .select("lang", "phrase", "a", "n", "x.l", "x.r", "x.score"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
