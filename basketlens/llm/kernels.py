"""Array kernels that tasks run over a few megabytes of text at a time.

Texts of a chunk are laid end to end with a line feed between them, so that
words and windows of all of them are found by whole-array operations.
"""

from __future__ import annotations

import numpy as np

CHUNK_BYTES = 2 << 20
PART_BYTES = 512 << 10  # of text in ``chunked``: arrays of some 80 bytes for each byte stand beside it
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values() -> np.ndarray:
    """One random odd 64-bit value for each byte value."""
    return mix(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER) | np.uint64(1)


class Powers:
    """Powers of the multiplier and of its inverse, grown as longer chunks come."""

    def __init__(self):
        self.inverse = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
        self.values = byte_values()
        self.up = self.down = np.ones(0, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            for name, base in (("up", MULTIPLIER), ("down", self.inverse)):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def prefix(self, buf: np.ndarray) -> np.ndarray:
        """prefix[i] sums value(byte) * multiplier**position over the first i bytes."""
        return self.sums(self.values[buf])

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The same of any values."""
        self.upto(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each byte range; equal ranges of equal length have equal hashes."""
        return mix((prefix[ends] - prefix[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def windows(self, prefix: np.ndarray, size: int) -> np.ndarray:
        """Hash of every window of ``size`` bytes, by its start."""
        n = len(prefix) - size
        return mix((prefix[size:] - prefix[:n]) * self.down[:n] + np.uint64(size))


def chunked(texts: list, limit: int = PART_BYTES):
    """Yield (first, last, encoded texts) for runs of texts of about ``limit`` bytes; None counts as empty."""
    at, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b"")
        size += len(held[-1]) + 1
        if size >= limit:
            yield at, i + 1, held
            at, held, size = i + 1, [], 0
    if held:
        yield at, len(texts), held


def joined(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all parts, each followed by a line feed, and the offset of each part (one more at the end)."""
    buf = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    return buf, starts


def ascii_lower(buf: np.ndarray) -> np.ndarray:
    return np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without space, tab, line feed, vertical tab, form feed, return."""
    inside = ~((buf == 32) | ((buf >= 9) & (buf <= 13)))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return edge[0::2], edge[1::2]


def words(parts: list, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased (A-Z) words of all parts in order, and where each part's words begin."""
    buf, starts = joined(parts)
    buf = ascii_lower(buf)
    a, b = word_spans(buf)
    return powers.spans(powers.prefix(buf), a, b), np.searchsorted(a, starts)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` elements (two running minima over blocks)."""
    n = len(x)
    if n < width:
        return x[:0]
    pad = -n % width
    blocks = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1: n])
