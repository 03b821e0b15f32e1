"""Packing of tokenized documents into sequences by power-of-two decomposition.

A document of L tokens is cut into pieces of ``max_length`` tokens and, for the
rest, one piece for each binary digit of its length.  Every piece is a sequence
of its own: no sequence crosses documents, every length is a power of two, so
nothing is padded, and batches are drawn from buckets of equal length
(``bucket``, the length's logarithm).

Tokenizing and cutting happen where a document is read; nothing is shuffled.
``sequence_id`` numbers the pieces within each input partition
(``monotonically_increasing_id``), so a task that runs again numbers them alike.

Defined results: null or empty text: the end token alone, one piece of length
1; repeated rows: packed each; null doc_id: kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ready
from ledgerline.llm.tokens import default_vocabulary, tokenizer
from ledgerline.llm.words import texts

MAX_LENGTH = 4096
END = 2


def piece_lengths(tokens: np.ndarray, max_length: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece lengths of all documents in order, number of pieces of each)."""
    top = max_length.bit_length() - 1
    places = [tokens // max_length] + [tokens >> bit & 1 for bit in range(top - 1, -1, -1)]
    table = np.stack(places, axis=1)
    lengths = np.tile(1 << np.arange(top, -1, -1), len(tokens))
    return np.repeat(lengths, table.ravel()), table.sum(axis=1)


def _pieces(path: str, max_length: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path)
        for batch in batches:
            for t in texts(batch.column("text")):
                ids, bounds = encode(t)
                # The end token follows every document.
                ids = np.insert(ids, bounds[1:], np.uint32(end))
                bounds = bounds + np.arange(len(bounds))
                tokens = np.diff(bounds)
                lengths, pieces = piece_lengths(tokens, max_length)
                cuts = np.concatenate(([0], np.cumsum(lengths)))
                row = np.repeat(np.arange(len(tokens)), pieces)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(row + t.rows.start)),
                        pa.array(cuts[:-1] - bounds[row]),
                        pa.array(lengths.astype(np.int64)),
                        pa.array(tokens[row].astype(np.int64)),
                        pa.LargeBinaryArray.from_buffers(
                            pa.large_binary(), len(row),
                            [None, pa.py_buffer((cuts * 4).astype(np.int64).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())],
                        ).cast(pa.binary()),
                    ],
                    ["doc_id", "start", "length", "doc_tokens", "ids"],
                )

    return run


def pack(docs: DataFrame, path: str | None = None, max_length: int = MAX_LENGTH, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset (0), bucket, ids.

    ``ids`` are little-endian unsigned 32-bit integers; ``path`` is the
    vocabulary file, which every executor must have.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _pieces(path or default_vocabulary(), max_length, end),
        "doc_id long, start long, length long, doc_tokens long, ids binary",
    )
    return (
        rows.withColumn("sequence_id", F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
        .withColumn("bucket", F.log2("length").cast("int"))
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """The packed sequences as Parquet, a folder per bucket of equal lengths."""
    packed.write.partitionBy("bucket").parquet(path)


def digests(docs: DataFrame, path: str | None = None, max_length: int = MAX_LENGTH, end: int = END) -> DataFrame:
    packed = pack(docs, path, max_length, end)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )
