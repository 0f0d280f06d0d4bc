"""Token ids of whole texts, each distinct run of characters encoded once.

The vocabulary's rules never join characters across white space, nor a
letter or digit with a sign that follows it, so a text can be parted at both
and its runs encoded apart.  Arrow parts the texts of a chunk and numbers
their distinct runs; only those meet the tokenizer, and a bounded number of
them is remembered for the chunks that follow in the same Python worker.
"""

from __future__ import annotations

import os
import sys
import types
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20
SIGNS = r"([a-z0-9])([.,;:!?()#*$%&|<>])"


def byte_letters() -> dict:
    """Latin-1 code points to the characters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: 256 + k for k, b in enumerate(rest)}


class Encoder:
    """Ids of runs under a tokenizer file of the ``tokenizers`` library.

    Runs are remembered in two generations of ``limit`` each; one that is met
    again moves to the younger, the older is forgotten when that is full.
    """

    def __init__(self, path: str, limit: int = 150_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.letters = byte_letters()
        self.limit = limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.direct = self._model_alone_serves()

    def _model_alone_serves(self) -> bool:
        """Whether the model by itself gives what the whole tokenizer does for lower-case words."""
        words = ["a", "the", "window", "unbelievableness", "qzxvkj", "é", "garçon", "größe", "ñandúes", "œuvre"]
        whole = [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        return whole == [[t.id for t in self.tokenizer.model.tokenize(self._bytes_as_letters(w))] for w in words]

    def _bytes_as_letters(self, word: str) -> str:
        return word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)

    def _one_word(self, run: str) -> bool:
        """Lower-case Latin letters in composed form: no rule but the merges applies."""
        return run.isalpha() and (run.isascii() or (max(run) < "ɐ" and run == run.lower()
                                                    and unicodedata.is_normalized("NFC", run)))

    def ids(self, runs: list) -> list:
        """Ids of each run as bytes."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old, tokenize = self.young, self.old, self.tokenizer.model.tokenize
        words, rest, flat, sizes = [], [], [], []
        for run in runs:
            if run in young:
                continue
            if run in old:
                young[run] = old[run]
            elif self.direct and self._one_word(run):
                got = tokenize(self._bytes_as_letters(run))
                flat += [t.id for t in got]
                sizes.append(len(got))
                words.append(run)
            else:
                rest.append(run)
        for at in range(0, len(rest), 10_000):
            for got in self.tokenizer.encode_batch_fast(rest[at: at + 10_000], add_special_tokens=False):
                flat += got.ids
                sizes.append(len(got.ids))
        data, at, width = np.array(flat, self.kind).tobytes(), 0, np.dtype(self.kind).itemsize
        for run, size in zip(words + rest, sizes):
            young[run] = data[at: at + width * size]
            at += width * size
        return [young[r] for r in runs]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: none) in one array, and where each text's begin (one more at the end)."""
        spaced = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts, "")), SIGNS, r"\1 \2")
        runs = pc.ascii_split_whitespace(spaced)
        coded = runs.flatten().dictionary_encode()
        codes = np.asarray(coded.indices)
        parts = self.ids(strings(coded.dictionary))
        width = np.dtype(self.kind).itemsize
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // width
        firsts = np.cumsum(sizes) - sizes
        per_run = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(per_run)])
        flat = np.frombuffer(b"".join(parts), self.kind)
        at = np.repeat(firsts[codes] - ends[:-1], per_run)
        at += np.arange(ends[-1])
        bounds = np.asarray(runs.offsets) - runs.offsets[0].as_py()
        return flat[at], ends[bounds]


def strings(runs: pa.Array) -> list:
    """A string array without line feeds as a list (one conversion of the whole, not one an element)."""
    if not len(runs):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(runs)], pa.int32()), runs)
    return pc.binary_join(whole, "\n")[0].as_py().split("\n")


def shared_encoder(path: str) -> Encoder:
    """One encoder for all tasks of this Python worker."""
    held = sys.modules.setdefault("_corpus_encoders", types.ModuleType("_corpus_encoders")).__dict__
    return held.get(path) or held.setdefault(path, Encoder(path))


def stretches(values: pa.Array, limit: int = CHUNK_BYTES):
    """(first, last) of stretches of about ``limit`` bytes of strings or binaries."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(values), 0)).astype(np.int64) + 1)
    at = 0
    while at < len(ends):
        base = ends[at - 1] if at else 0
        last = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield at, last
        at = last


def with_ids(path: str, end: int, columns: tuple = ("doc_id",)):
    """A function for ``mapInArrow``: ``columns`` and ``ids``, the text's ids and then ``end``, little-endian at the vocabulary's width."""
    def run(batches):
        encoder = shared_encoder(path)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for first, last in stretches(texts):
                flat, bounds = encoder.encode(texts.slice(first, last - first))
                n = len(bounds) - 1
                out = np.insert(flat, bounds[1:], end) if n else flat
                offsets = (bounds + np.arange(n + 1)) * out.itemsize
                ids = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.astype(np.int32)),
                                                             pa.py_buffer(np.ascontiguousarray(out))])
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(c)) for c in columns], ids],
                                                 names=[*columns, "ids"])
    return run
