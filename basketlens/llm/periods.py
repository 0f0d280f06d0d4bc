"""Periodic runs of words: stretches that repeat themselves, found in the suffix order of each text.

A run of period p that starts at s makes the suffixes at s and s + p agree
in p words or more, and no position between them starts the same words.  So
it is enough to look at suffix classes as they grow together:

1. suffixes are ordered by doubling the compared length, which leaves a rank
   for each power of two, and those ranks give the common prefix (LCP) of
   neighbours in that order;
2. neighbours are united in descending order of their LCP (Kruskal), by a
   union-find whose classes keep their positions ordered, the smaller class
   being put into the larger one;
3. positions i < j that become adjacent in a class at LCP L agree in exactly
   L words; if j - i <= L they seed the stretch from i to j + L, which is a
   run where no word before it goes on with the period.

Texts stay whole in one task each and many of them share the array work;
documents never meet, so nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import documents
from .kernels import CHUNK_BYTES


def split_words(doc_id: str | None, raw: bytes) -> list:
    """The words of a text."""
    return raw.split()


def looped_words(doc_id: str | None, raw: bytes) -> list:
    """The words of a text; in one of ten documents, by the checksum of the id, the text from some word on is a loop."""
    words = raw.split()
    h = zlib.crc32(doc_id.encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    loop = words[a: a + p]
    return words[:a] + (loop * (-(-(n - a) // p)))[: n - a]


def suffix_ranks(first: np.ndarray, least: int) -> tuple[list, np.ndarray]:
    """Ranks of all positions by their first 1, 2, 4, ... values, and the positions that share their first ``least`` values.

    Those come in suffix order.  Every rank array has one more entry, -1,
    after the last position.  A position that is alone in its class is not
    looked at again.
    """
    n = len(first)
    order = np.argsort(first, kind="stable")
    edge = np.concatenate([[True], first[order][1:] != first[order][:-1]])
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = np.flatnonzero(edge)[np.cumsum(edge) - 1]  # a class is numbered by its first place
    levels, shared, h = [rank], None, 1
    alone = edge & np.append(edge[1:], True)
    open_ = order[~alone]
    while len(open_):
        if 2 * h > least and shared is None:  # h <= least < 2h: the first h values, and the h that end at least
            key = _pairs(levels[-1], open_, least - h)
            at = np.argsort(key, kind="stable")
            edge = np.concatenate([[True], key[at][1:] != key[at][:-1]])
            shared = open_[at[~(edge & np.append(edge[1:], True))]]
        key = _pairs(levels[-1], open_, h)
        at = np.argsort(key, kind="stable")
        open_, key = open_[at], key[at]
        old = levels[-1][open_]
        new_class = np.concatenate([[True], old[1:] != old[:-1]])
        edge = np.concatenate([[True], key[1:] != key[:-1]])
        place = np.arange(len(open_))
        begin = place[new_class][np.cumsum(new_class) - 1]
        rank = levels[-1].copy()
        rank[open_] = old + place[edge][np.cumsum(edge) - 1] - begin
        levels.append(rank)
        h *= 2
        open_ = open_[~(edge & np.append(edge[1:], True))]
    if shared is None:
        return levels, np.zeros(0, np.int64)
    return levels, shared[np.argsort(levels[-1][shared], kind="stable")]


def _pairs(rank: np.ndarray, at: np.ndarray, ahead: int) -> np.ndarray:
    return rank[at] * len(rank) + rank[np.minimum(at + ahead, len(rank) - 1)] + 1


def common_prefixes(levels: list, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many values the suffixes at ``a`` and ``b`` agree."""
    got, end = np.zeros(len(a), np.int64), len(levels[0]) - 1
    for k in range(len(levels) - 1, -1, -1):
        got += (levels[k][np.minimum(a + got, end)] == levels[k][np.minimum(b + got, end)]).astype(np.int64) << k
    return got


def seeds(order: np.ndarray, lcp: np.ndarray, least: int) -> list:
    """(i, j, L) of positions that become adjacent at distance up to L as classes are united by descending LCP."""
    edges = np.flatnonzero(lcp >= least)
    edges = edges[np.argsort(-lcp[edges], kind="stable")].tolist()
    position, common = order.tolist(), lcp.tolist()
    parent = list(range(len(position)))
    members = {}
    found = []
    for e in edges:
        a, b, level = e, e + 1, common[e]
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        large, small = members.get(a) or [position[a]], members.pop(b, None) or [position[b]]
        if len(large) < len(small):
            large, small = small, large
        parent[b] = a
        members[a] = large
        put = -1
        for x in small:
            at = bisect_left(large, x)
            # two of the smaller class were together before: nothing new
            if at and (before := large[at - 1]) != put and x - before <= level:
                found.append((before, x, level))
            if at < len(large) and large[at] - x <= level:
                found.append((x, large[at], level))
            large.insert(at, x)
            put = x
    return found


def runs_of(codes: np.ndarray, owner: np.ndarray, least: int) -> np.ndarray:
    """Rows (start, length, period) of all runs of ``least`` values or more, over texts laid end to end; by start, then period.

    ``owner`` numbers each value's text.  Both starts of a run agree in at
    least ``least`` / 2 values: the length is p + L with L >= p.
    """
    if not len(codes):
        return np.zeros((0, 3), np.int64)
    need = -(-least // 2)
    levels, order = suffix_ranks(owner.astype(np.int64) * (int(codes.max()) + 1) + codes, need)
    if len(order) < 2:
        return np.zeros((0, 3), np.int64)
    got = np.array(seeds(order, common_prefixes(levels, order[:-1], order[1:]), need), np.int64).reshape(-1, 3)
    i, j, common = got.T
    one = levels[0]
    keep = (one[i - 1] != one[j - 1]) & (j - i + common >= least)  # index -1 is the entry after the last position
    i, length, period = i[keep], (j - i + common)[keep], (j - i)[keep]
    at = np.lexsort((period, length, i))
    i, length, period = i[at], length[at], period[at]
    # a multiple of the period may have been seeded for the same stretch
    first = np.concatenate([[True], (i[1:] != i[:-1]) | (length[1:] != length[:-1])])[: len(i)]
    rows = np.stack([i[first], length[first], period[first]], axis=1)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _digests(words: list, runs: np.ndarray) -> tuple:
    """A text's result columns; ``runs`` count words from the start of the text."""
    if not len(runs):
        return (0, None, None, None, None, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest())
    start, length, period = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist()
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs.tolist())
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    kept = [words[k] for k in np.flatnonzero(np.cumsum(depth)[:-1] == 0).tolist()]
    return (len(runs), start, length, period, 1000 * length // period, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest())


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def _stretches(texts: list, doc_ids: list, words_of, limit: int):
    """Lists of texts' words, of about ``limit`` bytes together."""
    held, size = [], 0
    for text, doc_id in zip(texts, doc_ids):
        raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        held.append(words_of(doc_id if isinstance(doc_id, str) else None, raw))
        size += len(raw)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _found(words_of, least: int, with_runs: bool):
    def run(frames):
        for frame in frames:
            out = []
            for texts in _stretches(list(frame.text), list(frame.doc_id), words_of, CHUNK_BYTES):
                sizes = np.array([len(w) for w in texts])
                flat = np.empty(sizes.sum(), object)
                flat[:] = [w for words in texts for w in words]
                owner = np.repeat(np.arange(len(texts)), sizes)
                runs = runs_of(pd.factorize(flat)[0], owner, least)
                firsts = np.cumsum(sizes) - sizes
                cuts = np.searchsorted(runs[:, 0], np.append(firsts, sizes.sum()))
                for k, words in enumerate(texts):
                    mine = runs[cuts[k]: cuts[k + 1]] - np.array([firsts[k], 0, 0])
                    out.append((*_digests(words, mine), mine.tolist() if with_runs else None))
            got = pd.DataFrame(out, columns=[*COLUMNS, "runs"], dtype=object)
            got.insert(0, "doc_id", frame.doc_id.to_numpy())
            yield got
    return run


def periodic_runs(df: DataFrame, least: int = 12, words_of: Callable = split_words, with_runs: bool = False) -> DataFrame:
    """doc_id and the periodic runs of every row of ``df`` (doc_id, text).

    A run is a stretch of words with smallest period p and at least
    max(``least``, 2p) words that cannot be made longer on either side.
    Returns ``n_runs``; ``start``, ``length``, ``period`` and ``exponent_milli``
    of the longest one (ties: the first start, then the least period; null
    without a run); ``runs_sha256`` of all runs in order; and
    ``collapsed_sha256`` of the text without what follows each run's first
    period.  ``with_runs`` adds all runs as ``runs`` (start, length, period).
    ``words_of(doc_id, raw)`` parts a text into words.  Null and empty texts
    have no words; null ids and repeated rows are texts like others; a very
    long text is worked on alone.  An empty table gives an empty result.
    """
    kind = ("doc_id string, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
            "runs_sha256 string, collapsed_sha256 string, runs array<array<bigint>>")
    out = (documents(df).select(F.col("doc_id").cast("string"), "text")
           .mapInPandas(_found(words_of, least, with_runs), kind).withColumn("doc_id", F.col("doc_id").cast("bigint")))
    return out if with_runs else out.drop("runs")
