"""Benchmark items inside documents, by SimHash windows of the items' size.

Every window of a document that has an item's size gets a 64-bit SimHash of
its words (lower-cased A-Z, every word one vote per bit).  Window sizes are the
steps of a grid (ratio 1.25 at most) up to seven eighths of an item's size; an
item is represented by the windows at its head and its tail, so a changed word
at either end leaves one of them as it was.  Fingerprints within ``RADIUS`` bits are
found by a multi-index: 64 bits in so many blocks (four for RADIUS 7) that one at
least differs in one bit or none, so every pair within the radius is met.  Candidates are verified by the
weighted Jaccard similarity of 5-word shingles, counted with repetition, of the
item and the document's words at its place; a shingle weighs the more the fewer
items of the whole benchmark have it.  A place starts where a head window was met, or ends where a tail
window was, and is as long as the item; where the count of equal shingles says that another length, up to one
and a half times the item's, is nearer (words were put in or left out), that place is judged too.

The documents stream through map tasks and nothing of them is shuffled.  The
benchmark is the stated query set: it is dealt into blocks of bounded bytes,
each block is broadcast and runs against all documents, and the blocks' results
are united, so its size bounds no result and no task's memory.  With several
blocks, the items that have a shingle are counted over all of them first: a block
gets the counts of its own items' shingles, and a place's other shingles get
theirs by a join, before places are judged.

Defined results: null or empty text on either side: no match; an item of fewer
words than a shingle: its whole sequence is its one shingle; equal items: one
row each; repeated rows: matched each; null ids are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ready, stored
from ledgerline.llm.words import Roller, Texts, WordHasher, mixed, texts

SHINGLE = 5
SIMILARITY = 0.75
RADIUS = 7
#: Text of a block of the benchmark, in bytes.
BLOCK_BYTES = 8 << 20
#: Words whose sums are held at a time.
CHUNK = 1 << 14

SCHEMA = "doc_id long, item_id long, similarity double, start_word long, end_word long, row long"

_hash, _roll = WordHasher(901), Roller(902)


def grid(size: int) -> int:
    """The largest step of 1, 2, 3, ..., then about 1.25 times the one before, that is at most ``size``."""
    step = 1
    while (nxt := max(step + 1, step * 5 // 4)) <= size:
        step = nxt
    return step


def simhashes(h: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every window of ``size`` words, given the words' hashes (a few thousand at most)."""
    return _of_sums(_sums(h, size), size)


def _sums(h: np.ndarray, longest: int) -> np.ndarray:
    """Running counts of the words that have each of the 64 bits, for windows of up to ``longest`` words.

    Several counts, each in a lane as wide as a window's count needs, are added as one 64-bit number.  A lane's carries
    go into the next one, but the difference of two rows is a window's counts, which carry nothing.
    """
    lane = np.uint8 if longest < 1 << 8 else np.uint16 if longest < 1 << 16 else np.uint32
    bits = np.unpackbits(h.view(np.uint8)).astype(lane, copy=False).view(np.uint64).reshape(len(h), 8 * lane().itemsize)
    sums = np.zeros((len(h) + 1, bits.shape[1]), np.uint64)
    np.cumsum(bits, axis=0, out=sums[1:])
    return sums


def _of_sums(sums: np.ndarray, size: int) -> np.ndarray:
    if len(sums) <= size:
        return np.zeros(0, np.uint64)
    lane = np.dtype(f"u{sums.shape[1] // 8}")
    return np.packbits(((sums[size:] - sums[:-size]).view(lane) > lane.type(size // 2)).ravel()).view(np.uint64)


class MultiIndex:
    """Fingerprints by the values of blocks of their bits, each value filed with those that differ from it in one bit."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        # 2 * blocks > radius: not every block can differ in two bits.
        count = max(4, (radius + 2) // 2)
        edges = [64 * k // count for k in range(count + 1)]
        self.blocks = []
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            shift, mask = np.uint64(lo), np.uint64((1 << (hi - lo)) - 1)
            flips = np.concatenate(([0], 1 << np.arange(hi - lo)))
            value = ((prints >> shift & mask).astype(np.int64)[:, None] ^ flips).ravel()
            order = np.argsort(value, kind="stable")
            first = np.searchsorted(value[order], np.arange((1 << (hi - lo)) + 1)).astype(np.int32)
            order //= len(flips)
            self.blocks.append((shift, mask, order, first, np.diff(first) > 0))

    def within(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``h``, fingerprint) of all pairs within the radius."""
        found = []
        for shift, mask, order, first, used in self.blocks:
            value = (h >> shift & mask).astype(np.int64)
            at = np.flatnonzero(used[value])
            value = value[at]
            count = first[value + 1] - first[value]
            where = np.repeat(at, count)
            which = order[np.arange(len(where)) + np.repeat(first[value] - np.cumsum(count) + count, count)]
            near = np.bitwise_count(h[where] ^ self.prints[which]) <= self.radius
            found.append(where[near] * len(self.prints) + which[near])
        both = np.unique(np.concatenate(found))
        return both // len(self.prints), both % len(self.prints)


class Benchmark:
    """A block of items, ready to be looked for."""

    def __init__(self, items: list[tuple[int | None, str | None]], radius: int, total: int | None = None, counts=()):
        """``total`` items in the whole benchmark (None: these), ``counts`` (shingle, items) of own shingles in several."""
        self.ids = [i for i, _ in items]
        self.total = len(items) if total is None else total
        self.shingles: list[tuple[np.ndarray, np.ndarray]] = []
        self.sizes = []
        classes: dict[int, list[tuple[int, int, np.uint64]]] = {}
        for t in texts(pa.array([x for _, x in items], pa.string()), lower=True):
            h = _hash(t.data, t.starts, t.ends)
            prefix = _roll.prefix(h)
            for a, b in zip(t.first[:-1].tolist(), t.first[1:].tolist(), strict=True):
                k, size = len(self.sizes), b - a
                self.sizes.append(size)
                self.shingles.append(np.unique(_shingles(prefix, a, b), return_counts=True))
                if size:
                    step = grid(size - size // 8)
                    for shift in {0, size - step}:
                        print_ = simhashes(h[a + shift : a + shift + step], step)[0]
                        classes.setdefault(step, []).append((k, shift, print_))
        items_of = np.concatenate([s for s, _ in self.shingles]) if self.shingles else np.zeros(0, np.uint64)
        self.known, self.items = np.unique(items_of, return_counts=True)
        if len(counts):
            self.items[np.searchsorted(self.known, np.array([s for s, _ in counts], np.int64).view(np.uint64))] = [n for _, n in counts]
        self.classes = {
            step: (np.array([k for k, _, _ in rows]), np.array([s for _, s, _ in rows]), MultiIndex(np.array([p for _, _, p in rows], np.uint64), radius))
            for step, rows in sorted(classes.items())
        }

    def weights(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of a shingle that d of N items have: log2(1 + N / d); d is 1 where none has it.  And which ones none has."""
        at = np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)
        known = self.known[at] == shingles
        return np.log2(1 + self.total / np.where(known, self.items[at], 1)), ~known

    def similarity(self, item: int, words: np.ndarray) -> float:
        """Weighted Jaccard similarity of an item's shingles and those given."""
        shared, every, *_ = self.compared(item, words)
        return shared / every

    def compared(self, item: int, words: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray, float]:
        """Weight of what an item's shingles and those given share and of what either has; the shingles given that no
        item here has, how often each occurs, and their part of the weight."""
        own, times = self.shingles[item]
        other, counts = np.unique(words, return_counts=True)
        every = np.union1d(own, other)
        x, y = np.zeros(len(every)), np.zeros(len(every))
        x[np.searchsorted(every, own)] = times
        y[np.searchsorted(every, other)] = counts
        w, new = self.weights(every)
        return float((w * np.minimum(x, y)).sum()), float((w * np.maximum(x, y)).sum()), every[new], y[new].astype(np.int64), float((w * y)[new].sum())


def _shingles(prefix: np.ndarray, a: int, b: int) -> np.ndarray:
    size = min(SHINGLE, b - a)
    if not size:
        return np.zeros(0, np.uint64)
    starts = np.arange(a, b - size + 1)
    return mixed(_roll.runs(prefix, starts, starts + size))


def _nearest_size(own: np.ndarray, times: np.ndarray, shingles: np.ndarray) -> int:
    """How many of the first ``shingles`` have the largest unweighted Jaccard similarity with an item's own (the fewest, at ties)."""
    at = np.minimum(np.searchsorted(own, shingles), len(own) - 1)
    order = np.argsort(shingles, kind="stable")
    first = np.concatenate(([0], np.flatnonzero(np.diff(shingles[order])) + 1))
    # The how-manieth of its kind each shingle is, from 0.
    nth = np.empty(len(shingles), np.int64)
    nth[order] = np.arange(len(shingles)) - np.repeat(first, np.diff(np.append(first, len(shingles))))
    shared = np.cumsum((own[at] == shingles) & (nth < times[at]))
    return int(np.argmax(shared / (times.sum() + np.arange(1, len(shingles) + 1) - shared))) + 1


def places(t: Texts, bench: Benchmark) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """(text, item, first word, word after, shingles) of every place where an item may be."""
    h = _hash(t.data, t.starts, t.ends)
    if not len(h) or not bench.classes:
        return
    longest = max(bench.classes)
    candidates = []
    for lo in range(0, len(h), CHUNK):
        sums = _sums(h[lo : lo + CHUNK + longest - 1], longest)
        for step, (items, shifts, index) in bench.classes.items():
            at, which = index.within(_of_sums(sums, step)[:CHUNK])
            if len(at):
                candidates.append(np.stack((at + lo, items[which], shifts[which], np.full(len(at), step))))
    if not candidates:
        return
    at, item, shift, step = np.concatenate(candidates, axis=1)
    text = np.searchsorted(t.first, at, "right") - 1
    inside = at + step <= t.first[text + 1]
    prefix = _roll.prefix(h)
    for k, a, i, s in zip(*(x[inside].tolist() for x in (text, at, item, shift)), strict=True):
        low, high, size = int(t.first[k]), int(t.first[k + 1]), bench.sizes[i]
        start, end = max(a - s, low), min(a - s + size, high)
        if size < SHINGLE or end - start < SHINGLE:
            yield k, i, start - low, end - low, _shingles(prefix, start, end)
            continue
        own, times = bench.shingles[i]
        # The end that was not met by a window may lie elsewhere.
        if s:
            some = _shingles(prefix, max(end - size - size // 2, low), end)[::-1]
        else:
            some = _shingles(prefix, start, min(start + size + size // 2, high))
        # Nothing in common at any length: no place.
        if not (own[np.minimum(np.searchsorted(own, some), len(own) - 1)] == some).any():
            continue
        plain, near = end - start - SHINGLE + 1, _nearest_size(own, times, some)
        for n in (plain, near) if near != plain else (plain,):
            x, y = (end - n - SHINGLE + 1, end) if s else (start, start + n + SHINGLE - 1)
            yield k, i, x - low, y - low, some[:n]


def matches(t: Texts, bench: Benchmark, similarity: float) -> Iterator[tuple[int, int, float, int, int]]:
    """(text, item, similarity, first word, word after) of the best place of every item in every text."""
    best = {}
    for k, i, start, end, words in places(t, bench):
        value = bench.similarity(i, words)
        if value >= similarity and value > best.get((k, i), (0.0,))[0]:
            best[k, i] = (value, start, end)
    for (k, i), (value, start, end) in sorted(best.items()):
        yield k, i, value, start, end


def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """block and shingle of every different shingle of every item."""
    for batch in batches:
        blocks = batch.column("block")
        for t in texts(batch.column("text"), lower=True):
            prefix = _roll.prefix(_hash(t.data, t.starts, t.ends))
            for k, (a, b) in enumerate(zip(t.first[:-1].tolist(), t.first[1:].tolist(), strict=True)):
                own = np.unique(_shingles(prefix, a, b)).view(np.int64)
                block = np.full(len(own), blocks[t.rows.start + k].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(own)], ["block", "shingle"])


def _places(batches: Iterator[pa.RecordBatch], sent, radius: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """The places that may reach the similarity, whatever number of items has the shingles that none here has."""
    items, total, counts, block = sent.value
    bench = Benchmark(items, radius, total, counts)
    kinds = {"block": pa.int64(), "number": pa.int64(), "item": pa.int64(), "place": pa.int64(), "doc_id": pa.int64(),
             "item_id": pa.int64(), "start_word": pa.int64(), "end_word": pa.int64(), "row": pa.int64(),
             "shared": pa.float64(), "rest": pa.float64(), "others": pa.list_(pa.int64()), "times": pa.list_(pa.int64())}
    for batch in batches:
        ids, keys, numbers = (batch.column(c) for c in ("doc_id", "row", "number"))
        for t in texts(batch.column("text"), lower=True):
            rows = []
            for place, (k, i, start, end, words) in enumerate(places(t, bench)):
                shared, every, others, times, weight = bench.compared(i, words)
                rest, at = max(0.0, every - weight), t.rows.start + k
                # A shingle weighs 1 at least: log2(1 + N / N).
                if shared >= (similarity - 1e-9) * (rest + int(times.sum())):
                    rows.append((block, numbers[at].as_py(), i, place, ids[at].as_py(), bench.ids[i], start, end, keys[at].as_py(),
                                 shared, rest, others.view(np.int64).tolist(), times.tolist()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)], list(kinds))


def _in_blocks(rows: DataFrame, items: DataFrame, blocks: int, radius: int, similarity: float) -> DataFrame:
    """``find`` with a benchmark of several blocks."""
    spark = rows.sparkSession
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    total = items.count()
    own = stored(items.select("block", "text").mapInArrow(_item_shingles, "block long, shingle long"), "benchmark-shingles")
    counts = stored(own.groupBy("shingle").agg(F.count("*").alias("items")).where("items > 1"), "benchmark-counts")
    own = stored(own.distinct().join(counts, "shingle"), "benchmark-own")
    schema = (
        "block long, number long, item long, place long, doc_id long, item_id long, start_word long, end_word long, row long,"
        " shared double, rest double, others array<long>, times array<long>"
    )
    rows, found = rows.withColumn("number", F.monotonically_increasing_id()), None
    for block in range(blocks):
        texts_ = [tuple(r) for r in items.where(F.col("block") == block).select("item_id", "text").collect()]
        several = [tuple(r) for r in own.where(F.col("block") == block).select("shingle", "items").collect()]
        sent = spark.sparkContext.broadcast((texts_, total, several, block))
        part = rows.mapInArrow(partial(_places, sent=sent, radius=radius, similarity=similarity), schema)
        found = part if found is None else found.unionAll(part)
    found = stored(found, "benchmark-places")
    key = ["block", "number", "item"]
    others = (
        found.select(*key, "place", F.explode(F.arrays_zip("others", "times")).alias("o"))
        .select(*key, "place", F.col("o.others").alias("shingle"), F.col("o.times").alias("times"))
        .join(counts, "shingle", "left")
        .groupBy(*key, "place").agg(F.sum(F.expr(f"times * log2(1 + {total} / coalesce(items, 1))")).alias("weight"))
    )
    best = F.struct("similarity", (-F.col("place")).alias("place"), "doc_id", "item_id", "start_word", "end_word", "row")
    return (
        found.join(others, [*key, "place"], "left")
        .withColumn("similarity", F.expr("shared / (rest + coalesce(weight, 0D))"))
        .where(F.col("similarity") >= similarity)
        .groupBy(*key).agg(F.max(best).alias("best"))
        .select(*(f"best.{c.split()[0]}" for c in SCHEMA.split(", ")))
    )


def _search(batches: Iterator[pa.RecordBatch], items, radius: int, similarity: float) -> Iterator[pa.RecordBatch]:
    bench = Benchmark(items.value, radius)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    for batch in batches:
        ids, keys = batch.column("doc_id"), batch.column("row")
        for t in texts(batch.column("text"), lower=True):
            rows = [
                (ids[t.rows.start + k].as_py(), bench.ids[i], value, start, end, keys[t.rows.start + k].as_py())
                for k, i, value, start, end in matches(t, bench, similarity)
            ]
            if rows:
                kinds = [pa.float64() if n == "similarity" else pa.int64() for n in names]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
                )


def find(
    docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """A row per document and benchmark item in it.

    doc_id, item_id, similarity, the words start_word to end_word (exclusive)
    of the best place, and row, a 64-bit hash of the document's id and text.
    """
    spark = ready(docs.sparkSession)
    items = stored(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")), "benchmark"
    )
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = -(-size // block_bytes)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("row"))
    if not blocks:
        return spark.createDataFrame([], SCHEMA)
    if blocks > 1:
        return _in_blocks(rows, items, blocks, radius, similarity)
    sent = spark.sparkContext.broadcast([tuple(r) for r in items.collect()])
    return rows.mapInArrow(partial(_search, items=sent, radius=radius, similarity=similarity), SCHEMA)
