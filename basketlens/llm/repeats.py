"""Removal of long byte strings that occur more than once, by longest previous factors.

In the suffix order of the whole corpus, the suffixes that agree in their
first ``length`` bytes are neighbours.  A position's previous smaller
position there is an earlier copy and its next smaller or greater position
another one: the longest previous factor of a position reaches ``length``
exactly when it is not the least position of its neighbours, and some copy
exists when it is not the only one.  So the order is needed to a depth of
``length`` only, and a hash of the first ``length`` bytes gives the same
neighbours as sorting by them.

Not every position is shuffled.  Each window of ``length`` bytes picks the
``anchor`` string inside it whose hash is least; a run of windows with one
anchor is a row.  Equal windows pick equal anchors, so:

1. rows whose anchor occurs once hold no repeat;
2. rows of one anchor whose whole stretch of text is equal are all repeats of
   each other, and one of them stands for the class;
3. where an anchor has several stretches, the windows of each class are
   hashed one by one and compared.

The same is done with words in place of bytes where a length in words is
given, on the same rows: bytes and words go through each step together, so
that a text is read and a table shuffled once for both.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import column, removed, written_at
from .kernels import Powers, chunked, joined, mix, sliding_min, word_spans


#: Windows and texts that a task hands on at a time.
ROWS, TEXTS = 200_000, 1000
#: What is told of a text, and the types.
OUT = {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string", "kept_text": "string",
       "n_passages": "bigint", "n_passage_words": "bigint", "text_less_passages": "string"}


def units(parts: list, powers: Powers, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums over the bytes or words of all parts, one unit between texts, and where each text begins."""
    buf, starts = joined(parts)
    prefix = powers.prefix(buf)
    if not words:
        return prefix, starts
    a, b = word_spans(buf)
    values = np.zeros(len(a) + len(parts), np.uint64)
    values[np.arange(len(a)) + np.searchsorted(starts, a, side="right") - 1] = powers.spans(prefix, a, b)
    return powers.sums(values), np.searchsorted(a, starts) + np.arange(len(starts))


def anchor_runs(parts: list, powers: Powers, length: int, anchor: int, words: bool = False):
    """Columns of the runs of windows with one anchor: text number, first and last start, anchor hash, stretch hash."""
    prefix, starts = units(parts, powers, words)
    if len(prefix) <= length:
        return [np.zeros(0, np.int64)] * 5
    grams = powers.windows(prefix, anchor)
    place = np.arange(len(grams), dtype=np.uint64)
    # least high half of the hash, then leftmost: the same choice wherever the window stands
    best = sliding_min((grams & np.uint64(0xFFFFFFFF00000000)) | place, length - anchor + 1)
    at = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = starts[1:] - 1  # without the line feed that ends a text
    inside = np.zeros(len(at) + 1, np.int64)
    long = ends - starts[:-1] >= length
    inside[starts[:-1][long]] += 1
    np.add.at(inside, np.minimum(ends[long] - length + 1, len(at)), -1)
    inside = np.cumsum(inside)[:-1] > 0
    label = np.where(inside, at, -1)
    edge = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
    last = np.concatenate([edge[1:], [len(label)]]) - 1
    keep = label[edge] >= 0
    first, last = edge[keep], last[keep]
    where = at[first]
    stretch = powers.spans(prefix, first, last + length)
    doc = np.searchsorted(starts, first, side="right") - 1
    stretch = mix(stretch + (where - first).astype(np.uint64))
    return doc, first - starts[doc], last - starts[doc], grams[where], stretch


def _runs(kinds: list):
    def run(frames):
        powers = Powers()
        for frame in frames:
            for first, last, parts in chunked(list(frame.text)):
                rows = frame.iloc[first:last]
                row_id, row_print = rows.row_id.to_numpy(), rows.row_print.to_numpy()
                for words, length, anchor in kinds:
                    doc, a, b, key, stretch = anchor_runs(parts, powers, length, anchor, words)
                    yield pd.DataFrame({"row_id": row_id[doc], "row_print": row_print[doc], "words": words,
                                        "key": key.view(np.int64), "stretch": stretch.view(np.int64),
                                        "a": a.astype(np.int32), "b": b.astype(np.int32)})
    return run


def _windows(kinds: list):
    def run(frames):
        powers = Powers()
        for frame in frames:
            held, size = [], 0
            for text, row_id, row_print, *x in zip(frame.text, frame.row_id, frame.row_print, frame.firsts, frame.lasts, frame.words):
                firsts, lasts, in_words = np.array(x[0], np.int64), np.array(x[1], np.int64), np.array(x[2], bool)
                for words, length, _ in kinds:
                    lens = (lasts - firsts + 1)[in_words == words]
                    if not len(lens):
                        continue
                    prefix = units([text.encode("utf-8", "surrogatepass")], powers, words)[0]
                    at = np.repeat(firsts[in_words == words] - np.cumsum(lens) + lens, lens) + np.arange(lens.sum())
                    held.append((row_id, row_print, words, at.astype(np.int32), powers.spans(prefix, at, at + length).view(np.int64)))
                    size += len(at)
                if size >= ROWS:
                    yield _listed(held)
                    held, size = [], 0
            if held:
                yield _listed(held)
    return run


def _listed(held: list) -> pd.DataFrame:
    *same, at, window = zip(*held)
    lens = [len(x) for x in at]
    return pd.DataFrame({**{name: np.repeat(x, lens) for name, x in zip(("row_id", "row_print", "words"), same)},
                         "at": np.concatenate(at), "window": np.concatenate(window)})


def _merged(firsts: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans in order, those that overlap or touch made one."""
    order = np.argsort(firsts)
    firsts, lasts = firsts[order], np.maximum.accumulate(lasts[order])
    gap = firsts[1:] > lasts[:-1]
    return firsts[np.append(True, gap)], lasts[np.append(gap, True)]


def _cut(raw: bytes, firsts: np.ndarray, lasts: np.ndarray) -> bytes:
    return b"".join(raw[a:b] for a, b in zip([0, *lasts.tolist()], [*firsts.tolist(), len(raw)]))


def _kept(with_text: bool, carry: list, apart: bool):
    none = np.zeros(0, np.int64)

    def told(text, firsts, lasts, in_words) -> tuple:
        raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        spelled = lambda left: left.decode("utf-8", "ignore") if with_text and isinstance(text, str) else None
        if firsts is None:
            return (len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), spelled(raw), 0, 0, spelled(raw))
        firsts, lasts, in_words = np.array(firsts, np.int64), np.array(lasts, np.int64), np.array(in_words, bool)
        a, b = firsts[~in_words], lasts[~in_words]
        runs = c = (none, none)
        if in_words.any():
            runs = _merged(firsts[in_words], lasts[in_words])
            begins, ends = word_spans(np.frombuffer(raw, np.uint8))
            c = (begins[runs[0]], ends[runs[1] - 1])
        d = _merged(np.append(a, c[0]), np.append(b, c[1]))
        spans = d if not apart else _merged(a, b) if len(a) else (none, none)
        left = _cut(raw, *spans)
        return (len(raw), int((spans[1] - spans[0]).sum()), len(spans[0]), hashlib.sha256(left).hexdigest(), spelled(left),
                len(runs[0]), int((runs[1] - runs[0]).sum()), spelled(_cut(raw, *d)) if apart else None)

    def run(frames):
        for batch in frames:
            for at in range(0, len(batch), TEXTS):
                frame = batch.iloc[at: at + TEXTS]
                out = [told(*x) for x in zip(frame.text, frame.firsts, frame.lasts, frame.words)]
                got = pd.DataFrame(out, columns=OUT)
                yield pd.concat([frame[["doc_id", *carry]].reset_index(drop=True), got], axis=1)
    return run


def _repeated(docs: DataFrame, kinds: list, keep_first: bool) -> DataFrame:
    """row_id, row_print and x, an array of the spans a, b, in bytes or words, that repeated strings cover.

    ``kinds`` holds (whether words, length, anchor).  A table is removed when
    nothing reads it any more.
    """
    spark = docs.sparkSession
    sizes = {words: length for words, length, _ in kinds}
    least = min(2 * length - 1 if words else length for words, length in sizes.items())
    size = F.when(F.col("words"), sizes.get(True)).otherwise(sizes.get(False))
    runs, runs_at = written_at(docs.where(F.octet_length("text") >= least).select("row_id", "row_print", "text").mapInPandas(
        _runs(kinds), "row_id bigint, row_print bigint, words boolean, key bigint, stretch bigint, a int, b int"))
    again, again_at = written_at(runs.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    shared, shared_at = written_at(runs.join(again.hint("shuffle_hash"), "key"))
    removed(spark, runs_at)
    removed(spark, again_at)
    classes, classes_at = written_at(shared.groupBy("key", "stretch").agg(
        F.count("*").alias("n"), F.min(F.struct("row_id", "row_print", "words", "a", "b")).alias("one")))
    many, many_at = written_at(classes.groupBy("key").agg(F.count("*").alias("stretches")).where("stretches > 1").select("key"))
    open_ = classes.join(many, "key", "left_semi").select("one.*").distinct()
    open_ = open_.groupBy("row_id", "row_print").agg(F.sort_array(F.collect_list(F.struct("a", "b", "words"))).alias("x"))
    texts = docs.select("row_id", "row_print", "text").join(open_, ["row_id", "row_print"])
    windows, windows_at = written_at(
        texts.dropDuplicates(["row_id", "row_print"])
        .select("row_id", "row_print", "text", F.col("x.a").alias("firsts"), F.col("x.b").alias("lasts"), F.col("x.words").alias("words"))
        .mapInPandas(_windows(kinds), "row_id bigint, row_print bigint, words boolean, at int, window bigint"))
    removed(spark, many_at)
    counted = [F.count("*").alias("n")]
    if keep_first:
        counted.append(F.min(F.struct("row_id", "row_print", "at")).alias("least"))
    copies, copies_at = written_at(windows.groupBy("window").agg(*counted).where("n > 1").drop("n"))
    found = windows.join(copies.hint("shuffle_hash"), "window")
    whole = shared.join(classes.where("n > 1"), ["key", "stretch"])
    if keep_first:
        found = found.where(F.struct("row_id", "row_print", "at") != F.col("least"))
        whole = whole.where(F.struct("row_id", "row_print", "words", "a", "b") != F.col("one"))
    spans = (found.select("row_id", "row_print", "words", F.col("at").alias("a"), (F.col("at") + size).alias("b"))
             .unionAll(whole.select("row_id", "row_print", "words", "a", (F.col("b") + size).alias("b"))))
    spans, _ = written_at(spans.groupBy("row_id", "row_print").agg(F.collect_list(F.struct("a", "b", "words")).alias("x")))
    for path in (shared_at, classes_at, windows_at, copies_at):
        removed(spark, path)
    return spans


def remove_repeats(df: DataFrame, length: int = 400, anchor: int = 240, keep_first: bool = True,
                   with_text: bool = False, carry: tuple = (), words: int = 0, apart: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``df`` (doc_id, text).

    Removes each byte covered by a string of ``length`` bytes, and with
    ``words`` also what is covered by a run of so many words (white space
    between them set aside), that also starts elsewhere: earlier elsewhere
    with ``keep_first`` (the first copy, by doc_id, text hash and position,
    stays), anywhere else without.  Matches never cross texts.  Null text is empty; null ids and repeated rows are
    texts like others (of rows that agree in id and text, all count as the
    same position with ``keep_first``, so they stay together).  With
    ``with_text`` the remaining text is returned too (bytes of a character
    cut in two are dropped from it; null stays null).  ``carry`` names further
    columns of ``df`` to return, of types that survive a cast to string and back.

    With ``apart`` the runs of words count in none of these columns but in
    n_passages (the maximal stretches of words that such runs cover),
    n_passage_words (their words) and, with ``with_text``,
    text_less_passages (what is left without the strings and the passages).
    """
    carried = [f"carried_{k}" for k in range(len(carry))]
    docs = df.select(column(df, "doc_id", "bigint").alias("doc_id"), column(df, "text", "string").alias("text"),
                     *[F.col(f"`{c}`").cast("string").alias(x) for c, x in zip(carry, carried)])
    docs = docs.select("*", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("row_id"), F.xxhash64("text").alias("row_print"))
    kinds = [(False, length, anchor)] + ([(True, words, max(1, words * 2 // 5))] if words else [])
    spans = _repeated(docs, kinds, keep_first)
    out = docs.join(spans, ["row_id", "row_print"], "left").select(
        F.col("doc_id").cast("string"), *carried, "text", F.col("x.a").alias("firsts"), F.col("x.b").alias("lasts"), F.col("x.words").alias("words"))
    kind = "doc_id string, " + "".join(f"{x} string, " for x in carried) + ", ".join(f"{c} {t}" for c, t in OUT.items())
    out = out.mapInPandas(_kept(with_text, carried, apart), kind).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    told = [c for c in OUT if (with_text or OUT[c] == "bigint" or c == "kept_sha256") and (apart or "passage" not in c)]
    return out.select("doc_id", *[F.col(x).cast(df.schema[c].dataType).alias(c) for c, x in zip(carry, carried)], *told)
