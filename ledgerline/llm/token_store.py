"""Token ids of a corpus in shards, each a wavelet matrix in one compressed file.

A shard holds the ids of a range of documents, in ascending doc_id order, as a
wavelet matrix: one bit-plane per bit of the largest id, the most significant
first; each plane lists its bits in the order that the planes above it leave
(zeros before ones, stably).  With counts of ones before each block of 512 bits
the planes answer, without unpacking the shard,

* ``access(i)``      the id at a position,
* ``rank(id, i)``    how often an id occurs before a position (counting), and
* ``select(id, k)``  the position of its k-th occurrence (lookup).

File layout, little-endian: ``b"WVM1"``, header length (u32), a JSON header
(``n``, ``bits``, ``docs``, plane and block counts' sizes), doc_ids (i64, with
a validity byte each), token bounds (u64, docs + 1), then for each plane its
zeros (u64), its bits and its block counts (u32), each compressed by zstd.

Spark deals the documents to shards by ranges of doc_id; a task writes each
of its shards to the shared folder under its range's number.  ``start`` comes
from a running sum over one row per shard.

Defined results: null or empty text: the end token alone; null doc_id: first;
repeated rows: stored each, ties in the order of their texts; an empty table:
no shard.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm import files
from ledgerline.llm.common import ready, stored
from ledgerline.llm.tokens import default_vocabulary, tokenizer
from ledgerline.llm.words import texts
from ledgerline.session import scratch_path

MAGIC = b"WVM1"
END = 1
BLOCK = 512
#: Tokens after which a task closes a shard and opens the next.
SHARD_TOKENS = 1 << 24


class WaveletMatrix:
    """Bit-planes of a sequence of ids with rank and select."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], counts: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.counts = n, planes, zeros, counts
        self.bits = len(planes)

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        n = len(ids)
        bits = max(1, int(ids.max()).bit_length()) if n else 1
        kind = np.uint16 if bits <= 16 else np.uint32
        now = ids.astype(kind)
        planes, zeros, counts = [], [], []
        for bit in range(bits - 1, -1, -1):
            ones = (now & kind(1 << bit)) != 0
            plane = np.packbits(ones, bitorder="little")
            planes.append(plane)
            counts.append(cls._counted(plane))
            low = now[~ones]
            zeros.append(len(low))
            now = np.concatenate((low, now[ones]))
        return cls(n, planes, zeros, counts)

    @staticmethod
    def _counted(plane: np.ndarray) -> np.ndarray:
        """Ones before each block."""
        step = BLOCK // 8
        padded = np.zeros(-(-len(plane) // step) * step, np.uint8)
        padded[: len(plane)] = plane
        per = np.bitwise_count(padded.view(np.uint64)).reshape(-1, step // 8).sum(axis=1)
        return np.concatenate(([0], np.cumsum(per))).astype(np.uint32)

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block, rest = divmod(i, BLOCK)
        plane = self.planes[level][block * BLOCK // 8 : block * BLOCK // 8 + -(-rest // 8)]
        more = int(np.bitwise_count(plane).sum())
        if rest % 8:
            more -= int(plane[-1] >> (rest % 8)).bit_count()
        return int(self.counts[level][block]) + more

    def access(self, i: int) -> int:
        value = 0
        for level in range(self.bits):
            one = int(self.planes[level][i >> 3]) >> (i & 7) & 1
            before = self._ones(level, i)
            i = self.zeros[level] + before if one else i - before
            value = value << 1 | one
        return value

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` among the first ``i`` ids."""
        if token >> self.bits:
            return 0
        lo = 0
        for level in range(self.bits):
            ones_lo, ones_hi = self._ones(level, lo), self._ones(level, i)
            if token >> (self.bits - 1 - level) & 1:
                lo, i = self.zeros[level] + ones_lo, self.zeros[level] + ones_hi
            else:
                lo, i = lo - ones_lo, i - ones_hi
        return i - lo

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of ``token``."""
        if k < 0 or k >= self.rank(token, self.n):
            raise IndexError(k)
        lo = 0
        for level in range(self.bits):
            ones = self._ones(level, lo)
            lo = self.zeros[level] + ones if token >> (self.bits - 1 - level) & 1 else lo - ones
        at = lo + k
        for level in range(self.bits - 1, -1, -1):
            one = token >> (self.bits - 1 - level) & 1
            at = self._place(level, one, at - self.zeros[level] if one else at)
        return at

    def _place(self, level: int, one: int, k: int) -> int:
        """Position of the k-th one (or zero) of a plane."""
        ones = self.counts[level].astype(np.int64)
        before = ones if one else np.minimum(np.arange(len(ones)) * BLOCK, self.n) - ones
        block = int(np.searchsorted(before, k, "right")) - 1
        bits = np.unpackbits(self.planes[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == one)[k - int(before[block])])

    def ids(self) -> np.ndarray:
        """All ids, from the lowest plane up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        now = np.zeros(self.n, kind)
        for level in range(self.bits - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            above = np.empty(self.n, kind)
            above[~ones] = now[: self.zeros[level]]
            above[ones] = now[self.zeros[level] :] | kind(1 << (self.bits - 1 - level))
            now = above
        return now


def write_shard(path: str, doc_ids: list, bounds: np.ndarray, ids: np.ndarray) -> None:
    matrix = WaveletMatrix.of(ids)
    parts = [
        np.array([d if d is not None else 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
        bounds.astype("<u8").tobytes(),
    ]
    for plane, zeros, counts in zip(matrix.planes, matrix.zeros, matrix.counts, strict=True):
        parts += [struct.pack("<Q", zeros), plane.tobytes(), counts.astype("<u4").tobytes()]
    # The planes are close to random bits: the fastest level gets what there is to get.
    packer = zstandard.ZstdCompressor(level=1)
    packed = [packer.compress(x) for x in parts]
    header = json.dumps({"n": matrix.n, "bits": matrix.bits, "docs": len(doc_ids), "sizes": [len(x) for x in packed]}).encode()
    with files.written(path) as out:
        out.write(MAGIC + struct.pack("<I", len(header)) + header)
        for x in packed:
            out.write(x)


def read_shard(path: str) -> tuple[list, np.ndarray, WaveletMatrix]:
    """(doc_ids, bounds, matrix) of a shard's file."""
    raw = memoryview(files.read(path))
    if bytes(raw[:4]) != MAGIC:
        raise ValueError(f"{path} is no shard")
    at = 8 + struct.unpack("<I", raw[4:8])[0]
    header = json.loads(bytes(raw[8:at]))
    parts, unpacker = [], zstandard.ZstdDecompressor()
    for size in header["sizes"]:
        parts.append(unpacker.decompress(raw[at : at + size]))
        at += size
    known = np.frombuffer(parts[1], np.uint8)
    doc_ids = [d if k else None for d, k in zip(np.frombuffer(parts[0], "<i8").tolist(), known.tolist(), strict=True)]
    planes, zeros, counts = [], [], []
    for level in range(header["bits"]):
        z, plane, count = parts[3 + 3 * level : 6 + 3 * level]
        zeros.append(struct.unpack("<Q", z)[0])
        planes.append(np.frombuffer(plane, np.uint8))
        counts.append(np.frombuffer(count, "<u4"))
    return doc_ids, np.frombuffer(parts[2], "<u8").astype(np.int64), WaveletMatrix(header["n"], planes, zeros, counts)


def _write_shards(batches: Iterator[pa.RecordBatch], folder: str, vocabulary: str, end: int) -> Iterator[pa.RecordBatch]:
    """One row per shard: its number, file, documents and tokens."""
    encode = tokenizer(vocabulary)
    part = TaskContext.get().partitionId()
    doc_ids, lengths, ids, held, number = [], [], [], 0, 0

    def close() -> pa.RecordBatch:
        name = f"{folder}/shard-{part:06d}-{number:04d}.wvm"
        bounds = np.concatenate(([0], np.cumsum(np.concatenate(lengths))))
        write_shard(name, doc_ids, bounds, np.concatenate(ids))
        row = ([part * (1 << 20) + number], [name], [len(doc_ids)], [held])
        return pa.RecordBatch.from_arrays([pa.array(x) for x in row], ["shard", "file", "docs", "tokens"])

    for batch in batches:
        for t in texts(batch.column("text")):
            got, bounds = encode(t)
            got = np.insert(got, bounds[1:], np.uint32(end))
            lengths.append(np.diff(bounds) + 1)
            ids.append(got.astype(np.uint16) if len(got) and got.max() < 1 << 16 else got)
            doc_ids += batch.column("doc_id")[t.rows.start : t.rows.stop].to_pylist()
            held += len(got)
            if held >= SHARD_TOKENS:
                yield close()
                doc_ids, lengths, ids, held, number = [], [], [], 0, number + 1
    if doc_ids:
        yield close()


def write(docs: DataFrame, folder: str, vocabulary: str | None = None, end: int = END) -> DataFrame:
    """Writes the shards of ``docs`` to ``folder`` (shared) and returns their list.

    Columns: shard (ascending with doc_id), file, docs, tokens, base (tokens of
    all shards before it).
    """
    ready(docs.sparkSession)
    run = partial(_write_shards, folder=folder, vocabulary=vocabulary or default_vocabulary(), end=end)
    shards = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
        .mapInArrow(run, "shard long, file string, docs long, tokens long"),
        "token-shards",
    )
    # One row per shard, some 10**7 tokens each: the running sum is over a small table.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long"))


def _read_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
            doc_ids, bounds, matrix = read_shard(name)
            ids = matrix.ids().astype("<u4").tobytes()
            for lo in range(0, len(doc_ids), 2048):
                cut = bounds[lo : lo + 2049]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids[lo : lo + 2048], pa.int64()),
                        pa.array(base + cut[:-1]),
                        pa.array(np.diff(cut)),
                        pa.array([ids[4 * a : 4 * b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )


def read(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of every document in the shards' files."""
    # A task per few shards, however few bytes their list has.
    dealt = shards.select("file", "base", "shard").repartition(max(1, shards.count()), "shard")
    return dealt.mapInArrow(_read_docs, "doc_id long, start long, n_tokens long, ids binary")


def digests(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    shards = write(docs, scratch_path(docs.sparkSession, "token-store"), vocabulary)
    return read(shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
