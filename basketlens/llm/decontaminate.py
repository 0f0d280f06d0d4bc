"""Benchmark passages in documents, by a count of shared character pieces and exact edit distance.

An item is cut into pieces of 4 characters and these into segments of up to
15.  The segments' limits are shares of the item's limit of edits: one less
in sum, for each segment but one, so that where the item lies within its
limit some segment lies within its own.  An edit touches one piece at most,
so within ``k`` edits all but ``k`` pieces of a segment stand unchanged, and
no two of them are shifted against each other by more than ``k`` characters.
The meetings of pieces and text are sorted by segment and shift; where too
few lie within ``k`` shifts there is no match.  Of the others, the cheapest
chain is taken: between two pieces that stand there are as many edits at
least as pieces left out or as characters they are shifted.  Where that is
within the limit the segment's edit distance is taken, and then the whole
item's.  Nothing is sampled: whatever lies within the limit is found.

Pieces are looked up by a hash, and every meeting is counted, so collisions
and repeated pieces can only add places, never lose one.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import column, documents

PIECE = 4  # at an edit share of 0.2 the longest pieces of which some are always left
SEGMENT = 15  # pieces of a segment: with the characters left over its distance fits a machine word
INDEX = 4  # bits of a piece's number in its segment
NEAR = 3  # bits of the shifts that are compared as one place
CHAIN = 32  # meetings of a place up to which chains are taken
STRETCH = 1 << 16  # characters of text met at a time
MEETINGS = 1 << 20  # meetings of pieces sorted at a time
PLACES = 2048  # segments compared at a time
FACTORS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)


def best_end(item: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``item`` to any substring of ``text``, and the first end of one (bit-parallel)."""
    m, masks = len(item), defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best, end = full, 0, m, m, 0
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        d0 = (((eq & plus) + plus) ^ plus) | eq | minus
        hp, hn = minus | (full & ~(d0 | plus)), plus & d0
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = (hp << 1) & full, (hn << 1) & full
        plus, minus = hn | (full & ~(d0 | hp)), hp & d0
        if score < best:
            best, end = score, at
    return best, end


def best_distance(item: str, text: str) -> int:
    """Least edit distance of ``item`` to any substring of ``text``."""
    return best_end(item, text)[0]


def best_start(item: str, text: str, end: int) -> int:
    """Start of the shortest substring at the least distance that ends at ``end``, the first end of one."""
    return end - best_end(item[::-1], text[:end][::-1])[1]


def piece_hashes(codes: np.ndarray, bits: int) -> np.ndarray:
    """Hash of the PIECE characters at each place."""
    n = max(0, len(codes) - PIECE + 1)
    out = np.zeros(n, np.uint32)
    for k, factor in enumerate(FACTORS):
        out ^= codes[k: k + n] * np.uint32(factor)
    return (out * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)


def character_codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def byte_codes(codes: np.ndarray) -> np.ndarray:
    """Characters as bytes; where two fall together a distance can only be less."""
    return (codes ^ (codes >> np.uint32(8)) ^ (codes >> np.uint32(16))).astype(np.uint8)


def shares(whole: int, n: int) -> list[int]:
    """``whole`` in ``n`` parts as equal as can be."""
    return [whole * (j + 1) // n - whole * j // n for j in range(n)]


def segments_of(text: str, limit: int) -> list[tuple[int, str, int, int]]:
    """(place, text, limit, pieces that must be left) of the segments of an item.

    The limits and one each add up to one more than the item's: with more
    edits in every segment, there are more than ``limit`` in the item.
    """
    pieces = len(text) // PIECE
    n = max(1, -(-pieces // SEGMENT))
    out, at = [], 0
    for own, need in zip(shares(pieces, n), shares(pieces - (limit + 1 - n), n)):
        end = at + own * PIECE if len(out) < n - 1 else len(text)
        out.append((at, text[at:end], own - need, need))
        at = end
    return out


def chain_costs(piece: np.ndarray, shift: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    """Least edits by the cheapest chain of some of the meetings in each column, in order of their piece.

    ``pieces`` is the number of pieces of each column's segment.  A chain
    takes a piece once; every piece it leaves out has an edit, and so has every
    character by which two that follow each other are shifted.
    """
    cost = piece.copy()  # none of those before it stands
    for j in range(1, len(piece)):
        between = piece[j] - piece[:j] - 1
        step = np.maximum(np.abs(shift[j] - shift[:j]), between) + cost[:j]
        step[between < 0] = np.iinfo(step.dtype).max
        np.minimum(cost[j], step.min(axis=0), out=cost[j])
    return (cost - piece).min(axis=0) + pieces - 1


class Pieces:
    """Pieces of the segments, met in ranges of shifts, and the segments' distances (bit-parallel, many at a time)."""

    def __init__(self, segments: list[tuple[int, int, str, int, int]]):
        """Of (item, place, text, limit, pieces that must be left); one below no edits is not needed to find its item."""
        self.segments = sorted((s for s in segments if s[3] >= 0), key=lambda s: (s[4], s[3]))
        self.item, self.offset, texts, self.limit, self.need = map(list, zip(*self.segments))
        self.groups = [k for k in range(len(texts)) if k == 0 or (self.need[k], self.limit[k]) != (self.need[k - 1], self.limit[k - 1])]
        self.offset, self.limit = np.array(self.offset, np.int64), np.array(self.limit, np.int64)
        self.longest = int(max(a + len(t) for a, t in zip(self.offset, texts)))
        self.widest = int(self.limit.max())
        self.span = max(map(len, texts)) + self.widest  # characters of text that a segment within its limit can cover
        self.steps = self.span + self.widest + (1 << NEAR) - 1
        at = [np.arange(len(t) // PIECE) * PIECE for t in texts]
        self.bits = min(22, max(12, int(sum(map(len, at))).bit_length() + 3))
        key = np.concatenate([piece_hashes(character_codes(t), self.bits)[a] for t, a in zip(texts, at)])
        grams, self.gram = np.unique(key, return_inverse=True)
        self.grams = len(grams)
        self.rank = np.full(1 << self.bits, -1, np.int32)
        self.rank[grams] = np.arange(len(grams))
        self.owner = np.repeat(np.arange(len(texts)), list(map(len, at)))
        self.index = np.concatenate(at) // PIECE
        self.at = np.concatenate(at) + self.offset[self.owner]
        self.pieces = np.array([len(a) for a in at], np.int16)
        self.masks = np.zeros((len(texts), 256), np.uint64)
        for k, t in enumerate(texts):
            for i, c in enumerate(byte_codes(character_codes(t)).tolist()):
                self.masks[k, c] |= np.uint64(1 << i)
        self.masks = self.masks.ravel()
        self.top = np.array([len(t) - 1 for t in texts], np.uint64)

    def met(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment, shift) of the places from which a range of ``limit`` shifts may hold the segment; near shifts are one."""
        rank = self.rank[piece_hashes(codes, self.bits)]
        place = np.flatnonzero(rank >= 0)
        bits = len(codes).bit_length()
        place |= rank[place].astype(np.int64) << bits
        if self.grams << bits < 1 << 32:
            place = place.astype(np.uint32)
        place.sort()  # by piece, then in order of the text
        first = np.searchsorted(place, (np.arange(self.grams + 1) << bits).astype(place.dtype))
        n = np.diff(first)[self.gram]
        total = np.cumsum(n)
        if len(total) and total[-1] > MEETINGS and len(codes) > 4 * self.span:
            half = len(codes) // 2
            parts = [self.met(codes[:half + self.span]), self.met(codes[half:])]
            return np.concatenate([parts[0][0], parts[1][0]]), np.concatenate([parts[0][1], parts[1][1] + half])
        # a segment's shifts begin at -longest, and no range reaches those of the next
        stride = (len(codes) + self.longest + self.widest >> NEAR) + 2 << NEAR
        kind = np.uint32 if stride * len(self.limit) << INDEX < 1 << 32 else np.int64
        base = ((self.owner * stride + self.longest - self.at << INDEX) + self.index).astype(kind)
        cell = np.repeat((first[self.gram] - total + n).astype(np.int32), n)
        cell += np.arange(len(cell), dtype=np.int32)
        cell = ((place & place.dtype.type((1 << bits) - 1)).astype(kind) << kind(INDEX))[cell]
        cell += np.repeat(base, n)
        cell.sort()
        bounds = (np.array([*self.groups, len(self.limit)]) * stride << INDEX).astype(kind)
        found = self.chained(cell, np.append(np.searchsorted(cell, bounds[:-1]), len(cell)), stride)
        # a segment that may lose all its pieces can be anywhere
        found = np.concatenate([found, *[np.arange(k * stride, k * stride + self.longest + len(codes), 1 << NEAR) >> NEAR
                                         for k, need in enumerate(self.need) if need < 1]]) << NEAR
        owner = found // stride
        return owner, found - owner * stride - self.longest

    def chained(self, cell: np.ndarray, ends: np.ndarray, stride: int) -> np.ndarray:
        """Places, counted in near shifts, where sorted meetings are enough and a chain of them is within the limit."""
        begins, lasts = [], []
        for k, a, b in zip(self.groups, ends, ends[1:]):
            need, limit = self.need[k], int(self.limit[k])
            if 0 < need <= b - a:
                # from the first of the meetings in a range on, so many follow within it
                some = np.flatnonzero(cell[a + need - 1: b] - cell[a: b - need + 1] < limit + 1 << INDEX) + a
                at = cell[some] >> cell.dtype.type(INDEX + NEAR)
                some, at = (x[np.concatenate([[True], at[1:] != at[:-1]])[: len(at)]] for x in (some, at))
                begins.append(some)
                reach = (at.astype(np.int64) + 1 << NEAR) + limit << INDEX
                lasts.append(np.searchsorted(cell[a:b], np.minimum(reach, np.iinfo(cell.dtype).max).astype(cell.dtype)) + a)
        if not begins:
            return np.zeros(0, np.int64)
        begin = np.concatenate(begins)
        n = np.concatenate(lasts) - begin
        place = cell[begin].astype(np.int64) >> INDEX + NEAR
        owner = (place << NEAR) // stride
        good = n > CHAIN
        for w in np.unique(n[~good]).tolist():
            mine = np.flatnonzero(n == w)
            at = cell[begin[mine] + np.arange(w)[:, None]].astype(np.int64)
            shift = (at >> INDEX) - (place[mine] << NEAR)
            # in order of the pieces, shifts beside them
            at = np.sort(((at & (1 << INDEX) - 1) << 8 | shift).astype(np.int16), axis=0)
            good[mine] = chain_costs(at >> 8, at & 255, self.pieces[owner[mine]]) <= self.limit[owner[mine]]
        return place[good]

    def near(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment, begin of ``steps`` characters) of all places where a segment may be within its limit."""
        owner, shift = self.met(codes)
        begin = shift + self.offset[owner] - self.limit[owner]
        lead = self.longest + self.widest
        text = np.concatenate([np.zeros(lead, np.uint8), byte_codes(codes), np.zeros(self.steps + lead, np.uint8)])
        good = np.zeros(len(owner), bool)
        for lo in range(0, len(owner), PLACES):
            mine = owner[lo: lo + PLACES]
            row, at, top = mine * 256, begin[lo: lo + PLACES] + lead, self.top[mine]
            plus, minus = np.full(len(mine), ~np.uint64(0)), np.zeros(len(mine), np.uint64)
            score = top.astype(np.int64) + 1
            best, one = score.copy(), np.uint64(1)
            for k in range(self.steps):
                eq = self.masks[row + text[at + k]]
                d0 = (((eq & plus) + plus) ^ plus) | eq | minus
                hp, hn = minus | ~(d0 | plus), plus & d0
                score += ((hp >> top) & one).view(np.int64) - ((hn >> top) & one).view(np.int64)
                hp, hn = hp << one, hn << one
                plus, minus = hn | ~(d0 | hp), hp & d0
                np.minimum(best, score, out=best)
            good[lo: lo + PLACES] = best <= self.limit[mine]
        return owner[good], begin[good]


class Items:
    """A block of benchmark items and their segments."""

    def __init__(self, items: list, edit_share: float):
        self.ids = [i for i, _ in items]
        self.texts = [" ".join(t.lower().split()) for _, t in items]
        self.n_words = [t.count(" ") + 1 for t in self.texts]
        self.limit = [int(edit_share * len(t)) for t in self.texts]
        self.reach = max(len(t) + n for t, n in zip(self.texts, self.limit))
        self.pieces = Pieces([(k, *s) for k, t in enumerate(self.texts) for s in segments_of(t, self.limit[k])])

    def ranges(self, texts: list[str]):
        """(text number, item, begin, end) of the stretches that may hold an item; no two of one item in a part overlap."""
        held, starts, size = [], [], 0
        for i, text in enumerate(texts):
            # a match is at most ``reach`` long, so it lies whole in one part of a long text
            for at in range(0, max(1, len(text) - self.reach), STRETCH):
                part = text[at: at + STRETCH + self.reach]
                held.append(part)
                starts.append((i, at, size))
                size += len(part) + 1
                if size >= STRETCH:
                    yield from self._ranges(held, starts)
                    held, starts, size = [], [], 0
        if held:
            yield from self._ranges(held, starts)

    def _ranges(self, held: list[str], starts: list):
        codes = character_codes("\n".join(held))
        begins = np.array([s for _, _, s in starts])
        found = []
        for owner, begin in zip(*map(np.ndarray.tolist, self.pieces.near(codes))):
            k, at, text, *_ = self.pieces.segments[owner]
            found.append((k, begin - at - self.limit[k],
                          begin + self.pieces.steps + len(self.texts[k]) - at - len(text) + self.limit[k]))
        joined: list[list] = []
        for k, a, b in sorted(found):
            if joined and joined[-1][0] == k and a <= joined[-1][2]:
                joined[-1][2] = max(joined[-1][2], b)
            else:
                joined.append([k, a, b])
        for k, a, b in joined:
            for j in range(max(0, int(np.searchsorted(begins, a, side="right")) - 1), len(held)):
                i, at, begin = starts[j]
                if begin >= b:
                    break
                lo, hi = max(0, a - begin), min(len(held[j]), b - begin)
                if hi - lo >= len(self.texts[k]) - self.limit[k]:
                    yield i, k, at + lo, at + hi

    def matches(self, texts: list[str]):
        """(text number, item, distance, start) of the best place in each stretch that holds an item."""
        for i, k, a, b in self.ranges(texts):
            part = texts[i][a:b]
            distance, end = best_end(self.texts[k], part)
            if distance <= self.limit[k]:
                yield i, k, distance, a + best_start(self.texts[k], part, end)


def _matches(items: list, edit_share: float):
    def run(frames):
        block = Items(items, edit_share)
        for frame in frames:
            texts = [" ".join(t.lower().split()) if isinstance(t, str) else "" for t in frame.text]
            ids = list(frame.doc_id)
            out = [(ids[i], block.ids[k], distance, texts[i].count(" ", 0, start), block.n_words[k])
                   for i, k, distance, start in block.matches(texts)]
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "distance", "first_word", "item_words"])
    return run


def benchmark_matches(df: DataFrame, benchmark: DataFrame, edit_share: float = 0.2, min_words: int = 5,
                      block_bytes: int = 64 << 10) -> DataFrame:
    """doc_id, item_id, distance, first_word, item_words of every benchmark item found in a document.

    Texts are compared lower-cased with white space as single spaces; an item
    is found where its edit distance to some substring is at most
    ``edit_share`` of its length.  One row per document row and item: the
    place of the least distance (then the first).  Items with null text or
    fewer than ``min_words`` words, and null texts, match nothing; null ids
    are kept as they are.  Items go to the tasks in blocks of about
    ``block_bytes``; each block is one pass over the documents, so nothing
    that is sent grows with either table.
    """
    docs = documents(df).select(F.col("doc_id").cast("string"), "text")
    items = benchmark.select(column(benchmark, "item_id", "bigint").alias("item_id"),
                             column(benchmark, "text", "string").alias("text")).where("text is not null").distinct()
    size = int(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    blocks = max(1, -(-size // block_bytes))
    kind = "doc_id string, item_id bigint, distance int, first_word int, item_words int"
    out = None
    for k in range(blocks):
        some = sorted(((r.item_id, r.text) for r in
                       items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
                       if len(r.text.split()) >= min_words), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        if some:
            got = docs.mapInPandas(_matches(some, edit_share), kind)
            out = got if out is None else out.unionAll(got)
    if out is None:
        out = df.sparkSession.createDataFrame([], kind)
    return (out.groupBy("doc_id", "item_id").agg(F.min(F.struct("distance", "first_word", "item_words")).alias("x"))
            .select(F.col("doc_id").cast("bigint").alias("doc_id"), "item_id", "x.*"))
