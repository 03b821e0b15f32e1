"""Token ids of whole texts with the word-level BPE vocabulary, by its own library.

The vocabulary's pre-tokenizer drops white space and never joins across it, so
a text's ids are its words' ids one after another.  It also lower-cases, and
parts a run of punctuation from the letter or digit before it, so words are
looked up with A-Z lower-cased and short runs of ASCII punctuation at their
ends taken off as words of their own.  A worker keeps the ids of
words it has met in a direct-mapped table (a fixed number of slots by the
word's 64-bit hash, later words replace earlier ones), looks a whole slice of
text up at once, and encodes only the words it doesn't find.  The table's size
is fixed, whatever the corpus.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from ledgerline.llm.words import LOWER, Texts, WordHasher

#: Slots of the word table, and ids kept of a word; longer words are encoded each time they come.
SLOTS_LOG2 = 21
INLINE = 8

_TAIL = np.zeros(256, bool)
_TAIL[list(b"!#$%&*+,-./:;=?@^_`~()[]{}\"|")] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True


def parts(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(data, starts, ends, first) with words lower-cased and parted from up to three marks at their ends."""
    if not len(t.starts):
        return t.data, t.starts, t.ends, t.first
    # The vocabulary's special tokens are matched as they are written.
    data = t.data if b"<|" in t.data.tobytes() else LOWER[t.data]
    core = t.ends.copy()
    for _ in range(3):
        core[_TAIL[data[core - 1]] & (core - 1 > t.starts)] -= 1
    cut = (core < t.ends) & _PLAIN[data[core - 1]]
    at = np.concatenate(([0], np.cumsum(1 + cut)))
    starts, ends = np.empty(at[-1], np.int64), np.empty(at[-1], np.int64)
    starts[at[:-1]], ends[at[1:] - 1] = t.starts, t.ends
    ends[at[:-1][cut]] = starts[at[1:][cut] - 1] = core[cut]
    return data, starts, ends, at[t.first]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Ids of the words of ``Texts`` slices; one per worker and vocabulary file (``tokenizer``)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.inner = Tokenizer.from_file(path)
        self.hasher = WordHasher(707)
        size = 1 << SLOTS_LOG2
        self.keys = np.zeros(size, np.uint64)
        self.lens = np.zeros(size, np.uint8)
        small = self.inner.get_vocab_size(with_added_tokens=True) <= 1 << 16
        self.ids = np.zeros((size, INLINE), np.uint16 if small else np.uint32)
        mark = self.inner.encode("\x01", add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each).

        Words are encoded together, each followed by a control character as a
        word of its own whose single id marks the end; where that isn't clear
        (the character occurs in a word), one by one.
        """
        if self.mark is not None and words:
            line = self.inner.encode_batch_fast([" \x01 ".join(words) + " \x01"], add_special_tokens=False)[0]
            ids = np.array(line.ids, np.uint32)
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) == len(words):
                lens = np.diff(np.concatenate(([-1], ends))) - 1
                return ids[ids != self.mark], lens
        got = [x.ids for x in self.inner.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for x in got for i in x], np.uint32), np.array([len(x) for x in got], np.int64)

    def __call__(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds): text k has ids[bounds[k]:bounds[k + 1]]."""
        data, word_starts, word_ends, first = parts(t)
        n = len(word_starts)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(t.first), np.int64)
        h = self.hasher(data, word_starts, word_ends)
        h[h == 0] = 1
        slot = (h >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)
        lens = np.zeros(n, np.int64)
        known = self.keys[slot] == h
        lens[known] = self.lens[slot[known]]
        new = np.flatnonzero(~known)
        if len(new):
            _, at, back = np.unique(h[new], return_index=True, return_inverse=True)
            where = new[at]
            raw = data.tobytes()
            words = [raw[s:e].decode("utf-8", "replace") for s, e in zip(word_starts[where].tolist(), word_ends[where].tolist(), strict=True)]
            got, sizes = self.encode_words(words)
            begins = np.cumsum(sizes) - sizes
            lens[new] = sizes[back]
        ends = np.cumsum(lens)
        begin = ends - lens
        out = np.zeros(int(ends[-1]), np.uint32)
        hit, cell = np.flatnonzero(known), slot[known]
        for j in range(INLINE):
            more = self.lens[cell] > j
            hit, cell = hit[more], cell[more]
            out[begin[hit] + j] = self.ids[cell, j]
        if len(new):
            count = sizes[back]
            total = np.cumsum(count)
            step = np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - count, count)
            out[np.repeat(begin[new], count) + step] = got[np.repeat(begins[back], count) + step]
            keep = np.flatnonzero(sizes <= INLINE)
            cells = slot[where[keep]]
            rows = np.zeros((len(keep), INLINE), np.uint32)
            for j in range(INLINE):
                has = sizes[keep] > j
                rows[has, j] = got[begins[keep][has] + j]
            # Two new words of one slot: the later one wins in every array alike.
            last = len(cells) - 1 - np.unique(cells[::-1], return_index=True)[1]
            self.keys[cells[last]] = h[where[keep[last]]]
            self.lens[cells[last]] = sizes[keep[last]]
            self.ids[cells[last]] = rows[last]
        return out, np.concatenate(([0], ends))[first]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)
