"""Lexical retrieval packing.

Documents are tokenised and dealt by a hash to shards of about
``shard_bytes`` of text.  A shard builds a BM25 inverted index of its
documents (document frequencies come from the whole corpus).  Windows are
filled one by one: the longest unused document is the seed, all its tokens
query the index, and its unused neighbours fill the window in order of score; the last one is cut where the window ends and its rest goes
on as an unused piece.  Documents longer than a window first give whole
windows of their own.  So all windows but a shard's last are full.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import documents, written
from .tokens import with_ids as encoded

END = 1
ROW_BYTES = 64
COMMON = 8
QUERIES = 16


def _document_frequencies(vocabulary: int):
    def run(frames):
        seen = np.zeros(vocabulary, np.int64)
        rows = 0
        for frame in frames:
            for ids in frame.ids:
                present = np.zeros(vocabulary, bool)
                present[np.frombuffer(ids, "<u2")] = True
                seen[np.flatnonzero(present)] += 1
                rows += 1
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"token": np.append(at, -1).astype(np.int32), "n": np.append(seen[at], rows)})
    return run


class Index:
    """BM25 postings of a shard's documents, by token.

    Tokens that one document in ``COMMON`` or more has are also kept as rows
    of a matrix, and queries meet those by a matrix product, some at a time;
    all other tokens add their postings.
    """

    def __init__(self, docs: list, idf: np.ndarray, k1: float = 1.2, b: float = 0.75):
        mean = max(1.0, sum(map(len, docs)) / max(1, len(docs)))
        tokens, owners, weights = [], [], []
        for i, ids in enumerate(docs):
            t, n = np.unique(ids, return_counts=True)
            tokens.append(t)
            owners.append(np.full(len(t), i, np.int32))
            weights.append((n * (k1 + 1) / (n + k1 * (1 - b + b * len(ids) / mean))).astype(np.float32))
        token = np.concatenate(tokens)
        order = np.argsort(token, kind="stable")
        token = token[order].astype(np.int64)
        self.tokens, self.docs = tokens, len(docs)
        self.first = np.searchsorted(token, np.arange(len(idf) + 1))
        self.owner = np.concatenate(owners)[order]
        self.gain = np.concatenate(weights)[order] * idf[token]
        self.size = np.diff(self.first)
        common = np.flatnonzero(self.size > max(1, len(docs) // COMMON))
        self.row = np.full(len(idf), -1, np.int64)
        self.row[common] = np.arange(len(common))
        self.matrix = np.zeros((len(common), len(docs)), np.float32)
        mine = np.flatnonzero(self.row[token] >= 0)
        self.matrix[self.row[token[mine]], self.owner[mine]] = self.gain[mine]

    def scores(self, queries: list) -> np.ndarray:
        """BM25 scores of every document for each of the queries (document numbers), over all their tokens."""
        asked = np.zeros((len(queries), len(self.matrix)), np.float32)
        rare = []
        for k, i in enumerate(queries):
            t = self.tokens[i].astype(np.int64)
            row = self.row[t]
            asked[k, row[row >= 0]] = 1
            rare.append(t[(row < 0) & (self.size[t] > 1)])  # a token of its own meets no other document
        out = asked @ self.matrix
        for k, t in enumerate(rare):
            n = self.size[t]
            at = np.repeat(self.first[t] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            out[k] += np.bincount(self.owner[at], self.gain[at], self.docs)
        return out


def in_order(score: np.ndarray, unused: np.ndarray):
    """Unused documents with a score, best first (ties: by number); sorted some at a time, as a window rarely needs all."""
    found = np.flatnonzero((score > 0) & unused)
    some = 64
    while len(found):
        if len(found) > some:
            least = np.partition(score[found], len(found) - some)[len(found) - some]
            best = found[score[found] >= least]
            found = found[score[found] < least]
        else:
            best, found = found, found[:0]
        yield from best[np.lexsort((best, -score[best]))]
        some *= 8


def fill_windows(docs: list, idf: np.ndarray, window: int):
    """Yield windows as lists of (document, start, length); every token lies in exactly one piece."""
    begin = np.zeros(len(docs), np.int64)
    left = np.array([len(d) for d in docs], np.int64)
    for i in np.flatnonzero(left >= window):
        while left[i] >= window:
            yield [(i, int(begin[i]), window)]
            begin[i] += window
            left[i] -= window
    if not (left > 0).any():
        return
    index = Index(docs, idf)
    by_length = np.lexsort((np.arange(len(docs)), -left))
    at, known = 0, {}

    def longest():
        nonlocal at
        while at < len(by_length) and left[by_length[at]] == 0:
            at += 1
        return by_length[at] if at < len(by_length) else None

    def score(i):
        if i not in known:  # those that come next as seeds are scored along
            known.clear()
            after = by_length[at: at + 4 * QUERIES]
            some = after[left[after] > 0]
            some = [i, *some[some != i][:QUERIES - 1].tolist()]
            known.update(zip(some, index.scores(some)))
        return known[i]

    while (seed := longest()) is not None:
        room, pieces = window, []
        scored = score(int(seed)) if left[seed] < window else None

        def take(i):
            nonlocal room
            n = int(min(left[i], room))
            pieces.append((int(i), int(begin[i]), n))
            begin[i] += n
            left[i] -= n
            room -= n

        take(seed)
        for i in in_order(scored, left > 0) if room else ():
            if left[i] and room:
                take(i)
            if not room:
                break
        while room and (i := longest()) is not None:  # no neighbour is left: the longest unused follow
            take(i)
        yield pieces


def _packed(idf_bytes: bytes, window: int, with_ids: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        idf = np.frombuffer(idf_bytes, np.float32)
        frame = frame.sort_values(["doc_id", "ids"], kind="stable", na_position="first")
        docs = [np.frombuffer(x, "<u2") for x in frame.ids]
        ids, shard = frame.doc_id.array, int(frame.shard.iloc[0])
        out = []
        for k, pieces in enumerate(fill_windows(docs, idf, window)):
            offset = 0
            for i, start, n in pieces:
                piece = docs[i][start: start + n].astype("<u4").tobytes()
                out.append((ids[i], start, n, zlib.crc32(piece), len(docs[i]), (shard << 32) + k, offset,
                            piece if with_ids else None))
                offset += n
        return pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                          "offset", "ids"])
    return run


def retrieval_packing(df: DataFrame, tokenizer_path: str, window: int = 2048, shard_bytes: int = 16 << 20,
                      vocabulary: int = 49_408, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents of ``df`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's tokens are its text's ids and then id 1; null or empty text
    gives that one.  Repeated rows and null ids are documents like others.
    ``shard_bytes`` bounds the text of a shard's index, each document counting
    ``ROW_BYTES`` more (a longer document stands in a shard with others all
    the same); a number stored with each row deals out rows that are alike.
    ``with_ids`` adds each piece's ids as little-endian 32-bit bytes.  An
    empty table gives no piece.
    """
    docs = documents(df)
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES)).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    tokens = written(docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(
        encoded(tokenizer_path, END), "doc_id string, ids binary").withColumn("row", F.monotonically_increasing_id()))
    got = (tokens.select("ids").mapInPandas(_document_frequencies(vocabulary), "token int, n bigint")
           .groupBy("token").agg(F.sum("n").alias("n")).toPandas().set_index("token").n)
    total = got.pop(-1) if len(got) else 0
    seen = np.zeros(vocabulary)
    seen[got.index.to_numpy(dtype=int)] = got.to_numpy()
    idf = np.log1p((total - seen + 0.5) / (seen + 0.5)).astype(np.float32)
    shard = F.pmod(F.xxhash64("doc_id", "ids", "row"), F.lit(shards)).cast("int")
    kind = ("doc_id string, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
            "offset bigint, ids binary")
    out = tokens.withColumn("shard", shard).drop("row").groupBy("shard").applyInPandas(
        _packed(idf.tobytes(), window, with_ids), kind).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return out if with_ids else out.drop("ids")
