"""Spelling variants: words one edit apart, grouped under their most frequent form.

The pairs come from the composition A o E o A: the minimised acceptor A of the
vocabulary, the transducer E of exactly one inserted, deleted or replaced code
point, and A again.  The composed machine is enumerated in partitions of its
initial states.  Of two words one edit apart, the shorter of L code points,
either the first h = L // 2 code points are the same or the last L - h are
(read from the end).  So every word starts at up to four initial states: behind
its first half and, reversed, behind its last half, as the shorter and as the
longer word; only words with the same state can meet.  Spark groups the words
by that state.  A task builds one minimised acceptor of all the states it
holds at a time (suffixes are shared between them) and follows the composed
states (p, edited or not, q) level by level as NumPy arrays; an arc carries the
number of strings before it, so a path's sum is its word.

A task puts out one row per word and state (how many near words, which has the
largest count), not pairs; their number grows with the vocabulary.  States that
hold more than ``STATE_CHARS`` code points (counted first) are split where the
edit may stand: one initial state per place, behind which only the edited code
point is left, so a state holds as many words as the alphabet has letters.

Counting words: a task adds up what it reads, Spark adds up the tasks' sums.

Defined results: null or empty text: no words; null doc_id: counts as empty text
before the colon; repeated rows: counted each; an empty table: no rows; words
of any length are compared whole; ties of n: the word smallest in code-point
order; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import joined, ready, stored
from ledgerline.llm.words import LOWER, WordHasher, mixed

LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
#: A run loses a code point when this divides its crc32.
LOSS = 31
SLICE_BYTES = 4 << 20
#: Words counted in a task before they are handed on.
HELD_WORDS = 300_000
#: Code points of one initial state beyond which it is split, and of all states that a task composes at once.
STATE_CHARS = 1 << 20
CHUNK_CHARS = 1 << 21

_U64 = np.uint64


# ---- counting words ------------------------------------------------------------------------


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


_CRC = _crc_table()
_ASCII = np.zeros(256, bool)
_ASCII[65:91] = _ASCII[97:123] = True
#: First byte of U+00C0 to U+00FF in UTF-8; one byte more follows it.
_LATIN = 0xC3


def _crcs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each run of bytes, continued from the crc32 of what stands before it."""
    order = np.argsort(-sizes, kind="stable")
    at, c = starts[order], before[order] ^ np.uint32(0xFFFFFFFF)
    left = np.searchsorted(-sizes[order], -np.arange(int(sizes.max(initial=0))), "left")
    for j, k in enumerate(left.tolist()):
        if k <= 4:  # a few very long runs: one call each
            for r in range(k):
                c[r] = zlib.crc32(data[at[r] + j : at[r] + sizes[order[r]]].tobytes(), int(c[r]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
            break
        c[:k] = _CRC[(c[:k] ^ data[at[:k] + j]) & np.uint32(255)] ^ (c[:k] >> np.uint32(8))
    out = np.empty(len(c), np.uint32)
    out[order] = c ^ np.uint32(0xFFFFFFFF)
    return out


def _slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, bounds of the texts) of some megabytes of texts at a time; null: empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    whole = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = min(max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1), len(column))
        yield row, whole[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def _words_of(ids: list, data: np.ndarray, bounds: np.ndarray, hasher: WordHasher, least: int, loss: int) -> Iterator[tuple[bytes, int]]:
    """(word, occurrences) in a slice of texts; a word may come more than once."""
    latin = data == _LATIN
    letter = np.zeros(len(data) + 2, bool)
    letter[1:-1] = _ASCII[data] | latin
    letter[2:-1] |= latin[:-1]
    inside = letter[1:-1]
    begins, closes = inside & ~letter[:-2], inside & ~letter[2:]
    edge = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
    begins[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    marks = np.concatenate(([0], np.cumsum(latin)))
    length = ends - starts - (marks[ends] - marks[starts])
    keep = length >= least
    starts, ends, length = starts[keep], ends[keep], length[keep]
    if not len(starts):
        return
    data = LOWER[data]
    row = np.searchsorted(bounds, starts, "right") - 1
    heads = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    h = _crcs(data, starts, ends - starts, heads[row])
    lost = h % loss == 0 if loss else np.zeros(len(h), bool)
    raw = data.tobytes()
    for s, e, k in zip(starts[lost].tolist(), ends[lost].tolist(), (h[lost] % length[lost]).tolist(), strict=True):
        word = raw[s:e].decode()
        if len(word) > least:
            yield (word[:k] + word[k + 1 :]).encode(), 1
    starts, ends = starts[~lost], ends[~lost]
    _, first, n = np.unique(hasher(data, starts, ends), return_index=True, return_counts=True)
    for s, e, k in zip(starts[first].tolist(), ends[first].tolist(), n.tolist(), strict=True):
        yield raw[s:e], k


def _counts(least: int, loss: int):
    def rows(held: dict[bytes, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held = WordHasher(1107), {}
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, data, bounds in _slices(batch.column(1)):
                for word, n in _words_of(ids[at : at + len(bounds) - 1], data, bounds, hasher, least, loss):
                    held[word] = held.get(word, 0) + n
                if len(held) >= HELD_WORDS:
                    yield rows(held)
                    held = {}
        if held:
            yield rows(held)

    return run


def vocabulary(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, loss: int = LOSS
) -> DataFrame:
    """(word, n) of all runs of Latin letters, A-Z lower-cased; with ``loss`` (0: none) a share loses a code point."""
    ready(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    found = rows.mapInArrow(_counts(least_length, loss), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ---- acceptor and composition --------------------------------------------------------------


class Acceptor:
    """Minimised acceptor of strings behind several initial states.

    ``initial`` numbers each row's initial state (rows of one state together,
    their strings distinct, of one length and sorted); ``cells`` has the
    strings' code points aligned at the right.  State 0 is final, the others'
    arcs are sorted by label; ``skip`` counts the strings of the arcs before.
    """

    def __init__(self, initial: np.ndarray, length: np.ndarray, cells: np.ndarray):
        rows, width = cells.shape
        shared = np.full(rows, -1)
        if rows > 1 and width:
            shared[1:] = (cells[1:] != cells[:-1]).argmax(axis=1) - (width - length[1:])
        shared[np.concatenate(([True], initial[1:] != initial[:-1]))[:rows]] = -1
        state = np.zeros(rows, np.int64)
        arcs, ends, self.strings = [], [np.zeros(1, np.int64)], np.ones(1, np.int64)
        kids, last = np.arange(rows), 0
        for height in range(1, int(length.max(initial=0)) + 1):
            # One row for each node of the trie one level below, under its parent at this height.
            kids = kids[(length[kids] >= height) & (shared[kids] < length[kids] - height + 1)]
            heads = np.flatnonzero(shared[kids] < length[kids] - height)
            label, child = cells[kids, width - height].astype(np.int64), state[kids]
            arc = (label.astype(_U64) << _U64(40)) + child.astype(_U64)
            one = np.add.reduceat(mixed(arc * _U64(0x9E3779B97F4A7C15) + _U64(1)), heads)
            two = np.add.reduceat(mixed(arc * _U64(0xC2B2AE3D27D4EB4F) + _U64(2)), heads)
            # Nodes with the same arcs are one state.
            order = np.lexsort((two, one))
            new = np.concatenate(([True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])))
            same = np.empty(len(heads), np.int64)
            same[order] = np.cumsum(new) - 1
            kept = order[new]
            size = np.diff(np.append(heads, len(kids)))
            take, _ = _spread(heads[kept], size[kept])
            below = self.strings[child]
            before = np.cumsum(below) - below
            arcs.append((label[take], child[take], before[take] - np.repeat(before[heads[kept]], size[kept])))
            ends.append(last + np.cumsum(size[kept]))
            last = int(ends[-1][-1])
            state[kids[heads]] = len(self.strings) + same
            self.strings = np.append(self.strings, np.add.reduceat(below, heads)[kept])
        self.label, self.child, self.skip = (np.concatenate(x) if arcs else np.zeros(0, np.int64) for x in (zip(*arcs, strict=True) if arcs else ((),) * 3))
        self.ends = np.concatenate(ends)  # arcs of state s: ends[s - 1]:ends[s]
        self.state = state
        self.keys = np.repeat(np.arange(len(self.strings)), np.diff(np.append(0, self.ends))) << 21 | self.label

    def arcs(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(arcs of all the states, which entry each belongs to)."""
        first = np.where(states > 0, self.ends[states - 1], 0)
        return _spread(first, self.ends[states] - first)

    def follow(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The arc of each state with the label; -1 where there is none."""
        want = states << 21 | labels
        at = np.searchsorted(self.keys, want)
        found = at < len(self.keys)
        found[found] = self.keys[at[found]] == want[found]
        return np.where(found, at, -1)


def _spread(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All members of the ranges first:first + size, and the range each is of."""
    owner = np.repeat(np.arange(len(first)), size)
    total = np.cumsum(size)
    return np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - size, size) + first[owner], owner


def composed(a: Acceptor, equal: np.ndarray, longer: np.ndarray, shorter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (u, v) of all accepted pairs.

    Replacements within the states that begin at the rows ``equal``, and
    deletions from those at ``longer`` to those at ``shorter``.  Of a run of
    equal code points the last one is deleted, so each pair comes once.
    """
    p, u = a.state[equal], equal
    li = (a.state[longer], a.state[shorter], longer, shorter)
    edited = tuple(np.zeros(0, np.int64) for _ in range(5))
    us, vs = [], []
    while len(p) or len(li[0]) or len(edited[0]):
        new = []
        # Not edited yet, the same state on both sides.
        more = a.strings[p] > 1
        p, u = p[more], u[more]
        arc, owner = a.arcs(p)
        others, of = _spread(arc + 1, a.ends[p][owner] - arc - 1)
        new.append((a.child[arc[of]], a.child[others], u[owner[of]] + a.skip[arc[of]], u[owner[of]] + a.skip[others], np.full(len(of), -1)))
        p, u = a.child[arc], u[owner] + a.skip[arc]
        # Not edited yet, the left word one longer.
        lp, lq, lu, lv = li
        arc, owner = a.arcs(lp)
        new.append((a.child[arc], lq[owner], lu[owner] + a.skip[arc], lv[owner], a.label[arc]))
        to = a.follow(lq[owner], a.label[arc])
        hit = np.flatnonzero(to >= 0)
        li = (a.child[arc[hit]], a.child[to[hit]], lu[owner[hit]] + a.skip[arc[hit]], lv[owner[hit]] + a.skip[to[hit]])
        # Edited: both read the same from here on.
        ep, eq, eu, ev, taken = edited
        arc, owner = a.arcs(ep)
        to = np.where(a.label[arc] == taken[owner], -1, a.follow(eq[owner], a.label[arc]))
        hit = np.flatnonzero(to >= 0)
        new.append((a.child[arc[hit]], a.child[to[hit]], eu[owner[hit]] + a.skip[arc[hit]], ev[owner[hit]] + a.skip[to[hit]], np.full(len(hit), -1)))
        edited = tuple(np.concatenate(x) for x in zip(*new, strict=True))
        done = (edited[0] == 0) & (edited[1] == 0)
        us.append(edited[2][done])
        vs.append(edited[3][done])
        edited = tuple(x[~done] for x in edited)
    return np.concatenate([np.zeros(0, np.int64), *us]), np.concatenate([np.zeros(0, np.int64), *vs])


def _pairs(key: np.ndarray, longer: np.ndarray, rests: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows (u, v) one edit apart, of rows sorted by (key, longer, rest)."""
    initial = np.cumsum(np.concatenate(([0], (key[1:] != key[:-1]) | (longer[1:] != longer[:-1]))))
    length = np.array([len(r) for r in rests])
    points = np.frombuffer("".join(rests).encode("utf-32-le"), np.uint32)
    begin = np.cumsum(length) - length
    # States in the order of their strings' length, so that a matrix has little room to spare.
    group = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
    low = np.minimum.reduceat(length, np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))))[group]
    order = np.lexsort((np.arange(len(key)), low))
    us, vs, at = [], [], 0
    while at < len(order):
        # Whole groups of keys whose matrix stays small.
        width = low[order[at]] * 2 + 16
        stop = min(int(np.searchsorted(low[order], width, "right")), at + max(1, 4 * CHUNK_CHARS // width))
        while stop < len(order) and group[order[stop]] == group[order[stop - 1]]:
            stop += 1
        rows = order[at:stop]
        at = stop
        size = length[rows]
        cells = np.zeros((len(rows), int(size.max())), np.uint32)
        flat, owner = _spread(begin[rows], size)
        cells[owner, cells.shape[1] - size[owner] + flat - begin[rows][owner]] = points[flat]
        a = Acceptor(initial[rows], size, cells)
        start = np.flatnonzero(np.concatenate(([True], initial[rows][1:] != initial[rows][:-1])))
        long_ = longer[rows[start]]
        both = np.flatnonzero((group[rows[start]][1:] == group[rows[start]][:-1]) & long_[1:] & ~long_[:-1])
        u, v = composed(a, start[~long_], start[both + 1], start[both])
        us.append(rows[u])
        vs.append(rows[v])
    return np.concatenate(us), np.concatenate(vs)


def _near_rows(words: pa.Array, n: np.ndarray, key: np.ndarray, longer: np.ndarray, back: np.ndarray, rests: list[str]) -> pa.RecordBatch | None:
    """One row per word and state with near words: how many, and which has the largest count."""
    u, v = _pairs(key, longer, rests)
    if not len(u):
        return None
    left, right = words.take(pa.array(u)).to_pylist(), words.take(pa.array(v)).to_pylist()
    keep = np.empty(len(u), bool)
    for i, (a, b, reverse) in enumerate(zip(left, right, back[u].tolist(), strict=True)):
        h = min(len(a), len(b)) // 2
        # Keys are hashes: look at the words.  Pairs whose first halves agree belong to the states behind them.
        tail = min(len(a), len(b)) - h
        keep[i] = (a[:h] != b[:h] and a[-tail:] == b[-tail:]) if reverse else a[:h] == b[:h]
    u, v = u[keep], v[keep]
    if not len(u):
        return None
    rank = np.empty(len(words), np.int64)
    rank[pc.sort_indices(words.cast(pa.binary())).to_numpy()] = np.arange(len(words))
    x, y = np.concatenate((u, v)), np.concatenate((v, u))
    order = np.lexsort((rank[y], -n[y], x))
    x, y = x[order], y[order]
    first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    return pa.RecordBatch.from_arrays(
        [
            words.take(pa.array(x[first])),
            pa.array(np.diff(np.append(first, len(x)))),
            pa.array(n[y[first]]),
            words.take(pa.array(y[first])),
        ],
        ["word", "n_near", "best_n", "best"],
    )


_STARTS = ["key", "longer", "back", "rest", "word", "n"]


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of rows sorted by (key, longer, rest), whole keys at a time."""
    held: list[pa.Table] = []
    chars = 0

    def near(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key = t.column("key").to_numpy()
        # A key with one word has no pairs.
        alone = np.concatenate(([True], key[1:] != key[:-1])) & np.concatenate((key[1:] != key[:-1], [True]))
        t = t.filter(pa.array(~alone)).combine_chunks()
        if len(t):
            col = lambda c: t.column(c).to_numpy()
            words = t.column("word").combine_chunks()
            words = words.chunk(0) if isinstance(words, pa.ChunkedArray) else words
            found = _near_rows(words, col("n"), col("key"), col("longer"), col("back"), t.column("rest").to_pylist())
            if found is not None:
                yield found

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        chars += pc.sum(pc.utf8_length(batch.column("rest"))).as_py() + batch.num_rows
        if chars < CHUNK_CHARS:
            continue
        whole = pa.concat_tables(held)
        key = whole.column("key").to_numpy()
        cut = int(np.searchsorted(key, key[-1], "left"))
        if cut:
            yield from near(whole.slice(0, cut))
            held = [whole.slice(cut)]
            chars = pc.sum(pc.utf8_length(held[0].column("rest"))).as_py() + len(held[0])
    if held:
        yield from near(pa.concat_tables(held))


def _starts(words: DataFrame) -> DataFrame:
    """The initial states of every word: behind a half from the front or from the back, as the shorter or the longer."""
    size = F.length("word")

    def start(short: Column, back: bool) -> Column:
        head = F.floor(short / 2).cast("int")
        tail = short - head
        part = F.substring("word", size - tail + 1, tail) if back else F.substring("word", F.lit(1), head)
        rest = F.reverse(F.substring("word", F.lit(1), size - tail)) if back else F.substring("word", head + 1, size)
        return F.struct(
            F.xxhash64(F.lit(back), short, part).alias("key"), (size > short).alias("longer"), F.lit(back).alias("back"), rest.alias("rest")
        )

    starts = F.array(start(size, False), start(size, True), start(size - 1, False), start(size - 1, True))
    return words.where(size > 0).select("word", "n", F.inline(starts)).select(*_STARTS)


def _split(starts: DataFrame) -> DataFrame:
    """A state's words dealt to one state per place of the edit, with the edited code point alone behind it."""
    size = F.length("rest")
    # The shorter word lacks a code point at any place of the longer one, its end included.
    last = size + F.when(F.col("longer"), 0).otherwise(1)
    places = starts.select("*", F.explode(F.sequence(F.lit(1), last)).alias("at"))
    part = lambda first, count: F.substring("rest", first, count)
    before, here, after = part(F.lit(1), F.col("at") - 1), part(F.col("at"), F.lit(1)), part(F.col("at") + 1, size)
    rows = lambda kind, found, without, rest: found.select(
        F.xxhash64(F.lit(kind), "key", "at", *without).alias("key"), "longer", "back", rest.alias("rest"), "word", "n"
    )
    short = places.where(~F.col("longer"))
    long_ = places.where(F.col("longer") & (here != part(F.col("at") + 1, F.lit(1))))
    return (
        rows("replaced", short.where(F.col("at") <= size), [before, after], here)
        .unionAll(rows("deleted", long_, [F.concat(before, after)], here))
        .unionAll(rows("deleted", short, [F.col("rest")], F.lit("")))
    )


def near_words(words: DataFrame, state_chars: int = STATE_CHARS) -> DataFrame:
    """(word, n_near, best_n, best) of the words of ``words`` (word, n; distinct) that have near ones."""
    ready(words.sparkSession)
    starts = _starts(words)
    big = starts.groupBy("key").agg(F.sum(F.length("rest") + 1).alias("chars")).where(F.col("chars") > state_chars).select("key")
    big = stored(big, "big-states")
    if big.limit(1).count():
        starts = joined(starts, big, ["key"], "left_anti").unionAll(_split(joined(starts, big, ["key"], "left_semi").select(*_STARTS)))
    rows = starts.select(*_STARTS).repartition("key").sortWithinPartitions("key", "longer", "rest")
    near = rows.mapInArrow(_compose, "word string, n_near long, best_n long, best string")
    # The largest n, and of those the smallest word.
    first = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return near.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first")).select(
        "word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best")
    )


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last one, twice as far in every round.

    A form's n is at least ``TIMES`` its word's, so no chain is longer than the digits of the largest n.
    """
    now = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("last"))
        moved = stored(now.join(onward, "root", "left").select("word", F.coalesce("last", "root").alias("root"), F.col("last").isNotNull().alias("moved")), "roots")
        now = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return now


def variants(words: DataFrame, times: int = TIMES, state_chars: int = STATE_CHARS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``words`` (word, n; distinct)."""
    words = stored(words.select("word", "n"), "vocabulary")
    near = near_words(words, state_chars)
    fits = F.col("best_n") >= times * F.col("n")
    rows = stored(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fits, F.col("best")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n")
        ),
        "forms",
    )
    found = roots(rows.where("form is not null"))
    return rows.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
