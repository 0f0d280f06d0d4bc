"""Katz backoff bigram scores, with counts exchanged between chunks of text and key ranges.

P(w | v) = d(r) r / c(v) for a pair seen r times in training, with Good-Turing
discounts d(r) for small r, and alpha(v) P(w) for an unseen pair; alpha(v)
is the discounted mass divided by the unigram mass of the words not seen
after v, so each context's probabilities sum to 1 exactly.  The unigram
level, where the recursion ends, is (c(w) + 1) / (N + V + 1), with one
further class for all unknown words.

A token of text is never shuffled.  Texts are cut into chunks of some
megabytes, stored once as word numbers in a table bucketed by chunk, next to
which everything a chunk asks for is brought.  A chunk sends the distinct
keys it holds with its own counts, cut by key range and packed; a range sums
them over all chunks and sends each chunk the totals in the chunk's order.
A key comes at most once from a chunk, so no key is hot.  That exchange runs
three times: for words, for pairs, and for the sums that alpha needs.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import documents, shared_folder, text_bytes, written
from .kernels import Powers, chunked, mix, words
from .language import remainder

END, START = np.uint64(0x456E64), np.uint64(0x5374617274)
CUTOFF = 5
PACKET = "range int, part bigint, keys binary, values binary"
ANSWER = "part bigint, kind string, range int, payload binary"


def packed(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as byte planes of their differences, whose high planes compress away."""
    return np.ascontiguousarray(np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(),
                     dtype=np.uint64)


def packets(part: int, keys: np.ndarray, values: np.ndarray, bits: int) -> pd.DataFrame:
    """The packets of a chunk, one per key range (the highest ``bits`` bits); ``values`` has one row per sorted key."""
    ranges = (keys >> np.uint64(64 - bits)).astype(np.int64)
    cut = np.append(np.flatnonzero(np.diff(ranges, prepend=-1)), len(keys))
    return pd.DataFrame([(int(ranges[a]), part, packed(keys[a:b]), values[a:b].tobytes())
                         for a, b in zip(cut[:-1], cut[1:])], columns=["range", "part", "keys", "values"])


def _chunks(size: int):
    def run(frames):
        powers = Powers()
        part = TaskContext.get().partitionId() << 20
        held = {"doc_id": [], "train": [], "text": []}

        def rows(final):
            nonlocal part, held
            for first, last, parts in chunked(held["text"], size):
                if last == len(held["text"]) and not final and sum(map(len, parts)) < size:
                    held = {k: v[first:] for k, v in held.items()}
                    return
                hashes, at = words(parts, powers)
                n = np.diff(at)
                ends = at[1:] + np.arange(len(n))
                tokens = np.insert(hashes, at[1:], END)
                vocabulary, number = np.unique(tokens, return_inverse=True)
                yield pd.DataFrame([(part, held["doc_id"][first:last], (n + 1).astype("<i8").tobytes(),
                                     np.array(held["train"][first:last], bool).tobytes(), vocabulary.tobytes(),
                                     number.astype("<u4").tobytes())],
                                   columns=["part", "doc_ids", "lengths", "train", "vocabulary", "tokens"])
                part += 1
            held = {k: [] for k in held}

        for frame in frames:
            for k in held:
                held[k].extend(frame[k])
            yield from rows(False)
        yield from rows(True)
    return run


class Chunk:
    """A stored chunk: word numbers, contexts, distinct pairs and which tokens are training."""

    def __init__(self, row, pairs: bool = True):
        self.part, self.doc_ids = int(row.part), row.doc_ids
        self.lengths = np.frombuffer(row.lengths, "<i8")
        self.vocabulary = np.frombuffer(row.vocabulary, np.uint64)
        self.tokens = np.frombuffer(row.tokens, "<u4").astype(np.int64)
        train = np.frombuffer(row.train, bool)
        self.train = np.repeat(train, self.lengths)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.train_docs = int(train.sum())
        if pairs:
            # START follows the vocabulary; it is a context and never a token
            self.context = np.concatenate([[0], self.tokens[:-1]])
            self.context[self.first] = len(self.vocabulary)
            hashes = np.append(self.vocabulary, START)
            keys = mix(hashes[self.context] * np.uint64(0x9E3779B97F4A7C15) + hashes[self.tokens])
            self.pairs, at, self.pair = np.unique(keys, return_index=True, return_inverse=True)
            self.pair_context, self.pair_word = self.context[at], self.tokens[at]


def _word_packets(bits: int):
    def run(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                c = Chunk(row, pairs=False)
                n = np.bincount(c.tokens[c.train], minlength=len(c.vocabulary))
                yield packets(c.part, c.vocabulary, n.astype("<i8"), bits)
    return run


def _pair_packets(bits: int):
    def run(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                c = Chunk(row)
                n = np.bincount(c.pair[c.train], minlength=len(c.pairs))
                yield packets(c.part, c.pairs, n.astype("<u4"), bits)
    return run


def _gathered(frame: pd.DataFrame, dtype: str, width: int = 1):
    frame = frame.sort_values("part", kind="stable")
    keys = [unpacked(k) for k in frame["keys"]]
    values = np.concatenate([np.frombuffer(v, dtype) for v in frame["values"]]).reshape(-1, width)
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    return frame, np.cumsum([len(k) for k in keys])[:-1], distinct, at, values


def _answers(kind: str, frame: pd.DataFrame, cut: np.ndarray, answer: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"part": frame.part.to_numpy(), "kind": kind, "range": frame["range"].to_numpy(),
                         "payload": [x.tobytes() for x in np.split(answer, cut)]})


def _totals(kind: str, dtype: str):
    """Answers a range's packets with totals; a row of part -1 holds the statistics of its keys."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame, cut, distinct, at, values = _gathered(frame, dtype)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, at, values[:, 0].astype(np.int64))
        # the first chunk that trained on a key owns it, so that sums over distinct keys take it once
        owner = np.zeros(len(at), bool)
        trained = np.flatnonzero(values[:, 0])
        owner[trained[np.unique(at[trained], return_index=True)[1]]] = True
        out = _answers(kind, frame, cut, (total[at] * 2 + owner).astype("<u8"))
        seen = total[total > 0]
        stats = np.append(np.bincount(np.minimum(seen, CUTOFF + 2), minlength=CUTOFF + 3), [len(seen), seen.sum()])
        return pd.concat([out, pd.DataFrame([(-1, kind, int(frame["range"].iloc[0]), stats.astype("<i8").tobytes())],
                                            columns=out.columns)])
    return run


def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """Katz's discount by count 0 .. CUTOFF + 1 (the last for all above); 1 where Good-Turing gives no value in (0, 1]."""
    n = counts_of_counts.astype(float)
    d = np.ones(CUTOFF + 2)
    if n[1] > 0:
        top = (CUTOFF + 1) * n[CUTOFF + 1] / n[1]
        for r in range(1, CUTOFF + 1):
            if n[r] > 0 and top < 1:
                x = ((r + 1) * n[r + 1] / (r * n[r]) - top) / (1 - top)
                d[r] = x if 0 < x <= 1 else 1.0
    return d


def _payload(answers: pd.DataFrame, kind: str, dtype: str) -> np.ndarray:
    some = answers[answers.kind == kind].sort_values("range")
    return np.concatenate([np.frombuffer(x, dtype) for x in some.payload]) if len(some) else np.zeros(0, dtype)


def _known(c: Chunk, answers: pd.DataFrame, model: dict):
    """Word counts (START last), unigram probabilities, pair counts, owned pairs and discounted pair counts."""
    count = np.append((_payload(answers, "word", "<u8") >> np.uint64(1)).astype(np.int64), model["docs"])
    unigram = (count[:-1] + 1) / (model["N"] + model["V"] + 1)
    got = _payload(answers, "pair", "<u8")
    seen = (got >> np.uint64(1)).astype(np.int64)
    discounted = seen * np.asarray(model["discounts"])[np.minimum(seen, CUTOFF + 1)]
    return count, unigram, seen, (got & np.uint64(1)).astype(bool), discounted


def _mass_packets(model: dict, bits: int):
    """For each context: discounted count and unigram mass of its distinct followers, and its count."""
    def run(left: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in left.itertuples(index=False):
            c = Chunk(row)
            count, unigram, _, owned, discounted = _known(c, answers, model)
            n = len(count)
            values = np.zeros((n, 3))
            values[:, 0] = np.bincount(c.pair_context[owned], discounted[owned], n)
            values[:, 1] = np.bincount(c.pair_context[owned], unigram[c.pair_word[owned]], n)
            values[:, 2] = count
            keys = np.append(c.vocabulary, START)
            order = np.argsort(keys)
            out.append(packets(c.part, keys[order], values[order], bits))
        return pd.concat(out) if out else pd.DataFrame(columns=["range", "part", "keys", "values"])
    return run


def _alphas(frame: pd.DataFrame) -> pd.DataFrame:
    """Backoff weight of each context; negative where the context's count is taken one higher.

    That is the case when no follower of a context is discounted: without
    it nothing would be left for unseen words.
    """
    frame, cut, distinct, at, values = _gathered(frame, "<f8", 3)
    seen, mass, count = (np.zeros(len(distinct)) for _ in range(3))
    np.add.at(seen, at, values[:, 0])
    np.add.at(mass, at, values[:, 1])
    np.maximum.at(count, at, values[:, 2])
    higher = seen > count * (1 - 1e-12)
    alpha = (1 - seen / np.maximum(1, count + higher)) / (1 - mass)
    return _answers("alpha", frame, cut, np.where(higher & (count > 0), -alpha, alpha)[at])


def _scores(model: dict):
    def run(left: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in left.itertuples(index=False):
            c = Chunk(row)
            count, unigram, seen, _, discounted = _known(c, answers, model)
            keys = np.append(c.vocabulary, START)
            alpha = np.empty(len(keys))
            alpha[np.argsort(keys)] = _payload(answers, "alpha", "<f8")
            context = count + (alpha < 0)  # a context that training never saw leaves all to the unigrams: alpha is 1
            v, w = c.pair_context, c.pair_word
            p = np.where(seen > 0, discounted / np.maximum(1, context[v]), np.abs(alpha[v]) * unigram[w])
            add = lambda x: np.add.reduceat(x, c.first)
            out.append(pd.DataFrame({
                "doc_id": c.doc_ids, "n_tokens": c.lengths, "n_known": add((count[c.tokens] > 0).astype(np.int64)),
                "base_score": add(np.log10(unigram)[c.tokens]), "score": add(np.log10(p)[c.pair])}))
        return pd.concat(out) if out else pd.DataFrame(columns=["doc_id", "n_tokens", "n_known", "base_score", "score"])
    return run


def _bucketed(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, bucketed by chunk: joins on ``part`` need no shuffle of it."""
    spark: SparkSession = df.sparkSession
    name = f"chunks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.bucketBy(buckets, "part").option("path", shared_folder(spark)).option("compression", "zstd")
       .format("parquet").saveAsTable(name))
    return spark.table(name)


def _statistics(answers: DataFrame) -> np.ndarray:
    """Counts of counts 0 .. CUTOFF + 2, distinct keys and total, summed over the ranges."""
    def summed(frames):
        yield pd.DataFrame({"payload": [sum((np.frombuffer(x, "<i8") for f in frames for x in f.payload),
                                            np.zeros(CUTOFF + 5, np.int64)).tobytes()]})

    rows = answers.where("part = -1").select("payload").mapInPandas(summed, "payload binary").collect()
    return sum((np.frombuffer(r.payload, "<i8") for r in rows), np.zeros(CUTOFF + 5, np.int64))


def katz_scores(df: DataFrame, train, chunk_bytes: int = 8 << 20, range_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for every row of ``df`` (doc_id, text).

    ``train`` is a column expression over doc_id and text; rows where it is
    true are learned from, null counts as false.  Tokens are the lower-cased
    (A-Z) runs without ASCII white space, and one end.  Scores are log10
    probabilities of whole texts.  There is a key range for about
    ``range_bytes`` of text (256 at least), so a range stays as small in a
    large corpus as in a small one.  Null text is empty (its one token is the
    end); null ids and repeated rows are texts like others.  Without any
    training row every token is unknown and has probability 1.
    """
    docs = documents(df).select(F.col("doc_id").cast("string"), F.coalesce(train, F.lit(False)).alias("train"), "text")
    chunks = _bucketed(docs.mapInPandas(
        _chunks(chunk_bytes), "part bigint, doc_ids array<string>, lengths binary, train binary, "
                              "vocabulary binary, tokens binary"))
    bits = max(8, math.ceil(math.log2(max(1, text_bytes(docs) / range_bytes))))
    word = written(chunks.mapInPandas(_word_packets(bits), PACKET).groupBy("range")
                   .applyInPandas(_totals("word", "<i8"), ANSWER))
    pair = written(chunks.mapInPandas(_pair_packets(bits), PACKET).groupBy("range")
                   .applyInPandas(_totals("pair", "<u4"), ANSWER))
    words_, pairs_ = _statistics(word), _statistics(pair)
    model = {"N": int(words_[-1]), "V": int(words_[-2]), "docs": int(docs.where("train").count()),
             "discounts": discounts(pairs_[: CUTOFF + 3]).tolist()}
    known = word.unionAll(pair).where("part >= 0")
    alpha = written(chunks.groupBy("part").cogroup(known.groupBy("part"))
                    .applyInPandas(_mass_packets(model, bits), PACKET).groupBy("range").applyInPandas(_alphas, ANSWER))
    out = chunks.groupBy("part").cogroup(known.unionAll(alpha).groupBy("part")).applyInPandas(
        _scores(model), "doc_id string, n_tokens bigint, n_known bigint, base_score double, score double")
    return out.select(F.col("doc_id").cast("bigint").alias("doc_id"), "n_tokens", "n_known",
                      F.lit(model["N"]).cast("bigint").alias("train_tokens"), "base_score", "score")


def held_out(doc_id: str = "doc_id"):
    """True for ids whose crc32 modulo 7 is 2; false for null ids."""
    return F.coalesce(remainder(doc_id, 7) == 2, F.lit(False))
