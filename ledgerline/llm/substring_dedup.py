"""Removal of passages that repeat, word for word, anywhere in the corpus.

Method: difference-cover anchors.  ``COVER`` modulo ``PERIOD`` is a difference
cover: for any two positions i and j there is a shift below ``PERIOD`` that
takes both into the cover.  So two equal runs of ``window`` words share an
equal anchor of ``window - PERIOD + 1`` words that starts, in both documents,
at a cover position.  Only the anchors at cover positions (5 in 21) are hashed
and counted; only around anchors that occur twice are whole windows then
compared, by 95 bits of hash.

Spark does the grouping: anchors and windows are shuffled by their hash.  An
Arrow batch first settles what repeats within itself: all but one of its equal
rows are known to repeat and are salted, so a passage held by a third of all
documents reaches its hash's partition once per batch, not once per document.
Positions go back to their documents by a join on a 64-bit hash of the text;
copies of one text meet there, and one of them answers for all.  The texts are
shuffled once for both joins.

Windows are judged on the input.  Defined results: null or empty text: no
words, nothing removed; a text shorter than the window: nothing removed;
repeated rows and exact copies: both sides lose the repeated words; a null
doc_id is kept as it is.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import ready
from ledgerline.llm.words import Roller, WordHasher, mixed, texts

WINDOW = 35
#: A difference cover modulo 21 (fixed values; every residue is a difference of two of them).
PERIOD = 21
COVER = (0, 1, 6, 8, 18)

#: Column order for the shuffle: what is alike in neighbouring rows first, the hash last.
#: ``at`` has the position in its lower half, the second hash in its upper half.
ROWS = "salt int, n int, key long, at long, h long"

_hash1, _hash2 = WordHasher(101), WordHasher(202)
_roll1, _roll2 = Roller(303), Roller(404)


def _rows(found: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of one batch from (h, h2, key, pos, n) arrays, with what repeats within the batch marked.

    Equal hashes in a batch get n = 2 (known to repeat), and all but one of them a salt.
    """
    if not found:
        return
    h, h2, key, pos, n = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((h2, h))
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = (h[order][1:] == h[order][:-1]) & (h2[order][1:] == h2[order][:-1])
    twice, again = np.zeros(len(h), bool), np.zeros(len(h), bool)
    twice[order], again[order] = same[1:] | same[:-1], same[:-1]
    columns = (
        np.where(again, 1 + ((key ^ pos) & 0xFFFF), 0).astype(np.int32),
        np.where(twice, 2, n).astype(np.int32),
        key,
        pos.astype(np.int64) | h2.astype(np.int64) << 32,
        h.view(np.int64),
    )
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["salt", "n", "key", "at", "h"])


def anchor_rows(window: int):
    size = window - PERIOD + 1
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            found = []
            for t in texts(batch.column("text")):
                counts = np.diff(t.first)
                where = _roll1.windows(_roll1.prefix(_hash1(t.data, t.starts, t.ends)), size)
                doc = np.repeat(np.arange(len(counts)), counts)[: len(where)]
                at = np.arange(len(where)) - t.first[doc]
                use = (counts[doc] >= window) & (at <= counts[doc] - size) & cover[at % PERIOD]
                h = mixed(where[use]) >> np.uint64(16)
                none = np.zeros(len(h), np.int32)
                found.append((h, none, keys[t.rows][doc[use]], at[use], none + 1))
            yield from _rows(found)

    return run


def window_rows(window: int):
    """Whole windows around the anchors in ``at`` (positions of a document's repeating anchors).

    Rows come sorted by key.  Of neighbouring rows with one key, which are
    copies of one text, the first answers for all, with n = 2.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, anchors = batch.column("key").to_numpy(), batch.column("at")
            copy = np.append(False, keys[1:] == keys[:-1])
            times = np.where(np.append(copy[1:], False), 2, 1).astype(np.int32)
            found = []
            for t in texts(batch.column("text")):
                counts = np.diff(t.first)
                step = np.zeros(len(t.starts) + 1, np.int32)
                for k, row in enumerate(range(t.rows.start, t.rows.stop)):
                    if anchors[row].is_valid and counts[k] >= window and not copy[row]:
                        at = anchors[row].values.to_numpy()
                        np.add.at(step, t.first[k] + np.maximum(at - PERIOD + 1, 0), 1)
                        np.add.at(step, t.first[k] + np.minimum(at, counts[k] - window) + 1, -1)
                starts = np.flatnonzero(np.cumsum(step[:-1]) > 0)
                if not len(starts):
                    continue
                h, h2 = (
                    mixed(roll.runs(roll.prefix(hasher(t.data, t.starts, t.ends)), starts, starts + window))
                    for hasher, roll in ((_hash1, _roll1), (_hash2, _roll2))
                )
                doc = np.searchsorted(t.first, starts, "right") - 1
                found.append((h, h2 >> np.uint64(33), keys[t.rows][doc], starts - t.first[doc], times[t.rows][doc]))
            yield from _rows(found)

    return run


def _kept(window: int):
    """doc_id, words, removed words and the kept text of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("at")
            for t in texts(batch.column("text")):
                counts = np.diff(t.first)
                step = np.zeros(len(t.starts) + window + 1, np.int32)
                for k, row in enumerate(range(t.rows.start, t.rows.stop)):
                    if found[row].is_valid:
                        at = t.first[k] + found[row].values.to_numpy()
                        np.add.at(step, at, 1)
                        np.add.at(step, at + window, -1)
                gone = np.cumsum(step[: len(t.starts)]) > 0
                stay = np.flatnonzero(~gone)
                # A kept word takes the byte after it along as one space, except a document's last kept word.
                cut = np.searchsorted(stay, t.first)
                byte = np.zeros(len(t.data) + 2, np.int8)
                byte[t.starts[stay]] += 1
                space = np.ones(len(stay), np.int64)
                space[cut[1:][cut[1:] > cut[:-1]] - 1] = 0
                data = np.append(t.data, np.uint8(0x20))
                data[t.ends[stay][space == 1]] = 0x20
                np.add.at(byte, t.ends[stay] + space, -1)
                mask = np.cumsum(byte[: len(data)], dtype=np.int8) > 0
                sizes = np.zeros(len(stay) + 1, np.int64)
                np.cumsum(t.ends[stay] - t.starts[stay] + space, out=sizes[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[t.rows.start : t.rows.stop],
                        pa.array(counts.astype(np.int64)),
                        pa.array((counts - np.diff(cut)).astype(np.int64)),
                        pa.LargeBinaryArray.from_buffers(
                            pa.large_binary(), len(counts),
                            [None, pa.py_buffer(sizes[cut].astype(np.int64).tobytes()), pa.py_buffer(data[mask].tobytes())],
                        ).cast(pa.binary()),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept"],
                )

    return run


def _repeating(rows: DataFrame) -> DataFrame:
    """Positions (array ``at`` per document key) of the rows whose hash occurs twice or more."""
    group = Window.partitionBy("h", "salt", "h2")
    return (
        rows.repartition("h", "salt")
        .withColumn("h2", F.expr("at >> 32"))
        .withColumn("total", F.sum("n").over(group))
        .where("total >= 2")
        .groupBy("key")
        .agg(F.collect_set(F.expr("int(at & 4294967295)")).alias("at"))
    )


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("key")
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that no repeating window covers, UTF-8, one space between)."""
    if window < PERIOD + 4:
        raise ValueError(f"window must be at least {PERIOD + 4} words")
    ready(docs.sparkSession)
    rows = keyed(docs)
    anchors = _repeating(rows.select("key", "text").mapInArrow(anchor_rows(window), ROWS))
    near = rows.join(anchors, "key", "left")
    repeats = _repeating(near.mapInArrow(window_rows(window), ROWS))
    return rows.join(repeats, "key", "left").mapInArrow(
        _kept(window), "doc_id long, n_words long, n_removed long, kept binary"
    )


def digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``remove_repeats`` with the kept text's SHA-256 in place of the text."""
    return remove_repeats(docs, window).withColumn("kept", F.sha2("kept", 256)).withColumnRenamed("kept", "kept_sha256")
