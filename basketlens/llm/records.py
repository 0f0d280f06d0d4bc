"""Token sequences as length-delimited binary records with an offset index.

A data file is a run of records, framed as in the public TFRecord layout:

    length of the payload (8 bytes) | masked CRC-32C of those 8 bytes (4)
    payload                         | masked CRC-32C of the payload (4)

Everything is little-endian.  A payload is the document id (8 bytes, signed),
1 if that id is null (1 byte), the bytes an id takes (1 byte), two zero bytes,
and then the ids.  Beside each data file lies an index of 8-byte record
offsets, one more at its end; a record's token count follows from its length.
``manifest.json`` names the files in order, with their counts.

``RecordFiles`` is a Spark data source over this layout (``format("token_records")``).
A task writes under a name of its own attempt and renames it when it is
whole, and only the driver's commit makes the files part of the set, so a lost
executor or a task run twice leaves no half file in it.  Reads are split by
records through the index; with a ``seed`` the splits read a pseudo-random
permutation of all records.
"""

from __future__ import annotations

import bisect
import json
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from .common import documents, shared_folder
from .kernels import mix
from .tokens import stretches, with_ids

END = 2
HEAD, FRAME = 12, 16
# Fixed values of the record layout: the reversed CRC-32C polynomial and the mask's addend.
CASTAGNOLI, MASK_DELTA = 0x82F63B78, 0xA282EAD8
BLOCK = 64
#: Bytes that are framed or parsed at a time.
STRETCH_BYTES = 1 << 20


class Crc32c:
    """CRC-32C of many byte ranges at a time.

    The checksum is linear over GF(2): a block's is the XOR of one table entry
    per byte, and the whole one's the XOR of the blocks' carried over the
    bytes behind them, by tables for each power of two of blocks.
    """

    def __init__(self):
        table = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            table = np.where(table & 1, (table >> 1) ^ np.uint32(CASTAGNOLI), table >> 1).astype(np.uint32)
        by_distance = [table]  # entry d: a byte with d more bytes behind it
        for _ in range(BLOCK - 1):
            last = by_distance[-1]
            by_distance.append(table[last & 255] ^ (last >> 8))
        self.bytes = np.stack(by_distance[::-1])
        # four tables, by byte of the state, that carry a state over 2**k blocks
        self.carry = [np.stack(by_distance[BLOCK - 4:][::-1])]

    def _moved(self, state: np.ndarray, power: int) -> np.ndarray:
        while len(self.carry) <= power:
            last = self.carry[-1]
            self.carry.append(np.stack([self._through(last, row) for row in last]))
        return self._through(self.carry[power], state)

    @staticmethod
    def _through(tables: np.ndarray, state: np.ndarray) -> np.ndarray:
        return (tables[0][state & 255] ^ tables[1][(state >> 8) & 255]
                ^ tables[2][(state >> 16) & 255] ^ tables[3][state >> 24])

    def of(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Checksums of ``data[start: start + size]`` for ranges of 4 bytes or more."""
        if not len(starts):
            return np.zeros(0, np.uint32)
        blocks = -(-sizes // BLOCK)
        ends = np.cumsum(blocks)
        padded = np.zeros(int(ends[-1]) * BLOCK, np.uint8)  # zeros in front of a range change nothing
        begin = ends * BLOCK - sizes
        at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        source = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        padded[at] = data[source]
        for k in range(4):  # the initial state of all ones
            padded[begin + k] ^= 255
        padded = padded.reshape(-1, BLOCK)
        state = np.zeros(len(padded), np.uint32)
        for k in range(BLOCK):
            state ^= self.bytes[k][padded[:, k]]
        behind = np.repeat(ends, blocks) - 1 - np.arange(len(padded))
        for power in range(int(behind.max()).bit_length()):
            some = np.flatnonzero((behind >> power) & 1)
            state[some] = self._moved(state[some], power)
        return np.bitwise_xor.reduceat(state, ends - blocks) ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    """The stored form of a checksum: rotated right by 15 bits, plus a constant."""
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)


def framed(doc_ids: list, ids: list, width: int, crc: Crc32c) -> tuple[bytes, np.ndarray]:
    """Records of the sequences (raw little-endian bytes) and the size of each."""
    payloads = [(0 if i is None else i).to_bytes(8, "little", signed=True) + bytes((i is None, width, 0, 0)) + x
                for i, x in zip(doc_ids, ids)]
    sizes = np.fromiter(map(len, payloads), np.int64, len(payloads))
    lengths = sizes.astype("<u8").view(np.uint8)
    of_length = masked(crc.of(lengths, np.arange(len(sizes)) * 8, np.full(len(sizes), 8))).astype("<u4").tobytes()
    whole = np.frombuffer(b"".join(payloads), np.uint8)
    of_payload = masked(crc.of(whole, np.cumsum(sizes) - sizes, sizes)).astype("<u4").tobytes()
    raw = lengths.tobytes()
    parts = []
    for k, payload in enumerate(payloads):
        parts += raw[8 * k: 8 * k + 8], of_length[4 * k: 4 * k + 4], payload, of_payload[4 * k: 4 * k + 4]
    return b"".join(parts), sizes + FRAME


def parsed(data: bytes, offsets: np.ndarray, crc: Crc32c) -> tuple[list, list, int]:
    """Document ids and raw ids of the records at ``offsets`` (one more at the end) of ``data``; all checksums are verified."""
    buf = np.frombuffer(data, np.uint8)
    starts, sizes = offsets[:-1], np.diff(offsets) - FRAME
    if len(starts) and (sizes < HEAD).any():
        raise ValueError("the index does not match the records")

    def word(at, kind):
        width = np.dtype(kind).itemsize
        return buf[at[:, None] + np.arange(width)].copy().view(kind).ravel()

    if (word(starts, "<u8") != sizes).any():
        raise ValueError("a record's length does not match the index")
    if (word(starts + 8, "<u4") != masked(crc.of(buf, starts, np.full(len(starts), 8)))).any():
        raise ValueError("a length's checksum is wrong")
    if (word(starts + 12 + sizes, "<u4") != masked(crc.of(buf, starts + 12, sizes))).any():
        raise ValueError("a payload's checksum is wrong")
    doc_ids = [None if null else i for i, null in zip(word(starts + 12, "<i8").tolist(), buf[starts + 20].tolist())]
    ids = [data[a + 12 + HEAD: a + 12 + n] for a, n in zip(starts.tolist(), sizes.tolist())]
    return doc_ids, ids, int(buf[starts[0] + 21]) if len(starts) else 0


def file_system(path: str):
    """Arrow file system and path of a Spark path (file:, hdfs:, s3: and others that Arrow knows)."""
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


@dataclass
class Written(WriterCommitMessage):
    """What a task has written."""
    part: int
    name: str
    records: int
    tokens: int
    size: int


class RecordWriter(DataSourceArrowWriter):
    """Writes (doc_id, ids) batches of a partition as one data file and its index."""

    def __init__(self, path: str, width: int):
        self.path, self.width = path, width

    def write(self, iterator):
        part = TaskContext.get().partitionId()
        fs, base = file_system(self.path)
        fs.create_dir(base, recursive=True)
        name, crc, sizes, tokens = f"part-{part:06d}-{uuid.uuid4().hex}", Crc32c(), [np.zeros(1, np.int64)], 0
        with fs.open_output_stream(f"{base}/.{name}.tmp") as out:
            for batch in iterator:
                for at, last in stretches(batch.column(1), STRETCH_BYTES):
                    some = batch.slice(at, last - at)
                    data, n = framed(some.column(0).to_pylist(), some.column(1).to_pylist(), self.width, crc)
                    out.write(data)
                    sizes.append(n)
                    tokens += int((n - FRAME - HEAD).sum()) // self.width
        offsets = np.cumsum(np.concatenate(sizes))
        with fs.open_output_stream(f"{base}/{name}.index") as out:
            out.write(offsets.astype("<u8").tobytes())
        fs.move(f"{base}/.{name}.tmp", f"{base}/{name}.records")
        return Written(part, name, len(offsets) - 1, tokens, int(offsets[-1]))

    def commit(self, messages):
        fs, base = file_system(self.path)
        files = [{"name": m.name, "records": m.records, "tokens": m.tokens, "bytes": m.size}
                 for m in sorted((m for m in messages if m), key=lambda m: m.part) if m.records]
        fs.create_dir(base, recursive=True)
        with fs.open_output_stream(f"{base}/manifest.json") as out:
            out.write(json.dumps({"width": self.width, "files": files}).encode())

    def abort(self, messages):
        fs, base = file_system(self.path)
        for m in messages:
            for name in (f"{m.name}.records", f"{m.name}.index") if m else ():
                if fs.get_file_info(f"{base}/{name}").type != pyarrow.fs.FileType.NotFound:
                    fs.delete_file(f"{base}/{name}")


class Permutation:
    """A seeded permutation of 0..n-1 without a table: a Feistel network, walked on until it lands inside."""

    def __init__(self, n: int, seed: int):
        self.n, self.half = n, max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.keys = mix(np.arange(1, 5, dtype=np.uint64) + np.uint64(seed % (1 << 32)) * np.uint64(8))

    def __call__(self, slots: np.ndarray) -> np.ndarray:
        out = slots.astype(np.uint64)
        todo = np.arange(len(out))
        low = np.uint64((1 << self.half) - 1)
        while len(todo):
            left, right = out[todo] >> np.uint64(self.half), out[todo] & low
            for key in self.keys:
                left, right = right, left ^ (mix(right + key) & low)
            out[todo] = (left << np.uint64(self.half)) | right
            todo = todo[out[todo] >= self.n]
        return out.astype(np.int64)


@dataclass
class Records(InputPartition):
    """Records first..last of the whole set, in file order or of its permutation."""
    first: int
    last: int


class RecordReader(DataSourceReader):
    """Reads records through the index, in file order or in the order of a permutation."""

    def __init__(self, path: str, options: dict):
        self.path, self.with_ids = path, options.get("ids", "true").lower() == "true"
        self.seed = int(options["seed"]) if "seed" in options else None
        self.split = int(options.get("split_bytes", 32 << 20))
        fs, base = file_system(path)
        with fs.open_input_stream(f"{base}/manifest.json") as f:
            manifest = json.loads(f.read())
        self.width, self.files = manifest["width"], manifest["files"]
        self.ends = np.cumsum([0] + [f["records"] for f in self.files]).tolist()
        self.tokens = np.cumsum([0] + [f["tokens"] for f in self.files]).tolist()

    def partitions(self):
        n, size = self.ends[-1], sum(f["bytes"] for f in self.files)
        if self.seed is None:  # whole files cut evenly, so that a split reads one file
            cuts = sorted({self.ends[k] + f["records"] * i // parts for k, f in enumerate(self.files)
                           for parts in [max(1, -(-f["bytes"] // self.split))] for i in range(parts)} | {n})
        else:
            parts = max(1, -(-size // self.split))
            cuts = sorted({n * i // parts for i in range(parts)} | {n})
        return [Records(a, b) for a, b in zip(cuts, cuts[1:])] or [Records(0, 0)]

    def _index(self, fs, base: str, k: int) -> np.ndarray:
        with fs.open_input_stream(f"{base}/{self.files[k]['name']}.index") as f:
            return np.frombuffer(f.read(), "<u8").astype(np.int64)

    def _batch(self, doc_ids, ids, starts, records) -> pa.RecordBatch:
        wide = [np.frombuffer(x, f"<u{self.width}").astype("<u4").tobytes() for x in ids]
        columns = [pa.array(doc_ids, pa.int64()), pa.array(records, pa.int64()), pa.array(starts, pa.int64()),
                   pa.array([len(x) // 4 for x in wide], pa.int64()), pa.array([zlib.crc32(x) for x in wide], pa.int64())]
        names = ["doc_id", "record", "start", "n_tokens", "ids_crc32"]
        if self.with_ids:
            columns, names = [*columns, pa.array(wide, pa.binary())], [*names, "ids"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def read(self, partition):
        fs, base = file_system(self.path)
        crc = Crc32c()
        for some in self._in_order(fs, base, partition) if self.seed is None else self._shuffled(fs, base, partition):
            records, starts, data, offsets = some
            doc_ids, ids, _ = parsed(data, offsets, crc)
            yield self._batch(doc_ids, ids, starts, records)

    def _in_order(self, fs, base, partition):
        """Stretches of records read at one go."""
        at = partition.first
        while at < partition.last:
            k = bisect.bisect_right(self.ends, at) - 1
            index, begin = self._index(fs, base, k), self.ends[k]
            before = self._tokens_before(index, k)
            stop = min(partition.last, self.ends[k + 1])
            with fs.open_input_file(f"{base}/{self.files[k]['name']}.records") as f:
                while at < stop:
                    i = at - begin
                    j = min(stop - begin, max(i + 1, int(np.searchsorted(index, index[i] + STRETCH_BYTES))))
                    data = f.read_at(int(index[j] - index[i]), int(index[i]))
                    yield np.arange(at, begin + j), before[i:j], data, index[i: j + 1] - index[i]
                    at = begin + j

    def _tokens_before(self, index, k):
        return self.tokens[k] + (index - (FRAME + HEAD) * np.arange(len(index))) // self.width

    def _shuffled(self, fs, base, partition):
        """Single records, some at a time; the records of one file are read together."""
        order = Permutation(self.ends[-1], self.seed)
        for at in range(partition.first, partition.last, 512):
            records = order(np.arange(at, min(at + 512, partition.last)))
            owner = np.searchsorted(self.ends, records, side="right") - 1
            data, starts = [b""] * len(records), np.zeros(len(records), np.int64)
            for k in np.unique(owner).tolist():
                index = self._index(fs, base, k)
                before = self._tokens_before(index, k)
                with fs.open_input_file(f"{base}/{self.files[k]['name']}.records") as f:
                    for r in np.flatnonzero(owner == k).tolist():
                        i = int(records[r]) - self.ends[k]
                        data[r], starts[r] = f.read_at(int(index[i + 1] - index[i]), int(index[i])), before[i]
            yield records, starts, b"".join(data), np.cumsum([0] + [len(x) for x in data])


class RecordFiles(DataSource):
    """``format("token_records")``: option ``path``; on read ``seed``, ``ids`` (true) and ``split_bytes``; on write ``width`` (bytes an id, 2)."""

    @classmethod
    def name(cls):
        return "token_records"

    def schema(self):
        return ("doc_id bigint, record bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
                + (", ids binary" if self.options.get("ids", "true").lower() == "true" else ""))

    def reader(self, schema):
        return RecordReader(self.options["path"], self.options)

    def writer(self, schema, overwrite):
        return RecordWriter(self.options["path"], int(self.options.get("width", 2)))


def write_records(df: DataFrame, tokenizer_path: str, path: str, end: int = END, width: int = 2,
                  file_bytes: int = 32 << 20) -> None:
    """Encode every text of ``df`` (doc_id, text), append ``end``, and write the records below ``path`` in ascending doc_id order.

    Null ids come first; rows of one id follow each other by a hash of their
    text.  They and repeated rows are dealt to files by that hash and a row
    number, so one id with any number of rows is still cut into files of about
    ``file_bytes`` of text.  Null text is empty: its record holds ``end``
    alone.  An empty table gives a manifest without files.
    """
    df.sparkSession.dataSource.register(RecordFiles)
    docs = documents(df)
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 8)).first()[0] or 0
    files = max(1, -(-size // file_bytes))
    order = [F.col("doc_id").asc_nulls_first(), "tie", "row"]
    dealt = (docs.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
             .repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "text"))
    (dealt.mapInArrow(with_ids(tokenizer_path, end), "doc_id bigint, ids binary")
     .write.format("token_records").option("width", width).mode("append").save(path))


def read_records(spark: SparkSession, path: str, seed: int | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, record, start, n_tokens, ids_crc32 and ids (little-endian unsigned 32-bit) of each record below ``path``.

    ``start`` counts the ids of all records before it.  With ``seed`` the rows
    come in a pseudo-random order, each read by its offset.  A record whose
    length or checksum is wrong is an error.
    """
    spark.dataSource.register(RecordFiles)
    reader = spark.read.format("token_records").option("ids", str(with_ids).lower())
    return (reader if seed is None else reader.option("seed", seed)).load(path)


def round_trip(df: DataFrame, tokenizer_path: str, path: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row of ``df``, read back from the written files."""
    path = path or shared_folder(df.sparkSession)
    write_records(df, tokenizer_path, path)
    return read_records(df.sparkSession, path, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")
