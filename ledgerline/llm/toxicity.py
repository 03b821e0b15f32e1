"""Toxicity scores from a fuzzy lexicon and the words around its hits.

The lexicon is learned: words that toxic documents of the training rows use far
more often than the others.  Its trie is intersected with Levenshtein automata
(one edit for terms of 5 letters or more, two from 10): the product's states
are sets of (trie node, edits so far), made as words ask for them, so a word is
matched against all terms at once and most words die after a few letters.  Words
that share no string with a term after as many letters left out as it has edits
(they can't be within them) are not run through it.

A term is a word whose use by toxic documents is beyond chance among all words
counted, however rare it is.

A hit has its term's weight, or, where training rows hold the very word, that
word's own (smoothed) log odds, so an ordinary neighbour that clean documents use
counts for little.  A misspelling that training doesn't hold has its term's
weight less ``EDIT`` for every edit.  The
``WINDOW`` words on either side separate quotation from abuse: quotation marks
and words of reporting lower a hit, other hits and words of address raise it.
A logistic regression (Spark ML) over a document's hit features gives the score.

Only labels and texts are learned from; doc_id only keeps rows together.  The
classifier (lexicon, weights, regression) is fitted on at most ``TRAINING_ROWS``
labelled documents, all of them up to that bound, and is the only thing that is
sent to the tasks: at most LEXICON terms and KNOWN words.

Defined results: null or empty text: the score of no hits; repeated rows: a row
each; several labels of a document: toxic if one says so; null labels or
doc_ids teach nothing; no usable label: every score is 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ready, stored
from ledgerline.llm.tokens import parts
from ledgerline.llm.words import Texts, WordHasher, texts

FOLDS, HELD_OUT = 5, 0
TRAINING_ROWS = 200_000
LEXICON, KNOWN = 5000, 100_000
#: A term occurs in so many toxic training documents at least, that much more often (log odds) than in others, and so
#: often that chance would make fewer than so many terms of all words counted.
MIN_TOXIC, MIN_ODDS, BY_CHANCE = 4, 2.0, 1.0
#: (node, edits) pairs that an automaton's states hold.
MOST_NODES = 400_000
#: Log odds that an edit takes off a term's.
EDIT = 1.5
WINDOW = 8
SLOTS_LOG2 = 20

#: Words of reporting and of address (fixed values).
REPORTING = frozenset("said says wrote quote quoted called term word dit écrit sagte schrieb dijo escribió".split())
ADDRESS = frozenset("you your you're u du dich dein ihr tu toi vous votre tú te eres usted".split())
MARKS = "\"“”«»„"

FEATURES = ("strongest", "total", "terms", "dense", "quoted", "addressed", "size")


def edits_of(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 10 else 2


def shortened(word: str, letters: int) -> list[str]:
    """The word with up to so many letters (two at most) left out."""
    out = [word]
    if letters:
        out += [word[:i] + word[i + 1 :] for i in range(len(word))]
    if letters > 1:
        out += [word[:i] + word[i + 1 : j] + word[j + 1 :] for i in range(len(word)) for j in range(i + 1, len(word))]
    return out


class FuzzyTrie:
    """The terms' trie and Levenshtein automata, as one automaton made on demand."""

    def __init__(self, terms: list[str], most_states: int = 1 << 11):
        self.terms, self.most_states = terms, most_states
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        self.budget = [0]  # most edits of any term below a node
        for k, term in enumerate(terms):
            at, edits = 0, edits_of(term)
            self.budget[0] = max(self.budget[0], edits)
            for c in term:
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                    self.budget.append(0)
                at = self.children[at][c]
                self.budget[at] = max(self.budget[at], edits)
            self.ends[at] = k
        self.exact: dict[str, int] = {}
        #: By edits: the terms with so many letters left out, or fewer.
        self.short: list[set[str]] = [set(), set(), set()]
        #: Of terms with two edits: the pieces of a word, by its length and their places in it.
        self.pieces: dict[int, dict[tuple[int, int], set[str]]] = {}
        for k, term in enumerate(terms):
            self.exact.setdefault(term, k)
            edits = edits_of(term)
            self.short[edits].update(shortened(term, edits))
            if edits == 2:
                self._cut(term)
        self._clear()

    def _cut(self, term: str) -> None:
        """Files the term's thirds, of which one is whole in every word within two edits, by where words would have it."""
        size = len(term)
        cuts = [size * k // 3 for k in range(4)]
        for length in range(size - 2, size + 3):
            places = self.pieces.setdefault(length, {})
            for k, shifts in enumerate(((0,), (-1, 0, 1), (length - size,))):
                for d in shifts:
                    places.setdefault((cuts[k] + d, cuts[k + 1] + d), set()).add(term[cuts[k] : cuts[k + 1]])

    def _may(self, word: str) -> bool:
        """Whether the word and a term, both with at most the term's edits of letters left out, have a string in common:
        true of all words within a term's edits, and of few others."""
        if 4 <= len(word) <= 10 and not self.short[1].isdisjoint(shortened(word, 1)):
            return True
        places = self.pieces.get(len(word), {})
        return any(word[a:b] in some for (a, b), some in places.items()) and not self.short[2].isdisjoint(shortened(word, 2))

    def _clear(self) -> None:
        self.numbers: dict[frozenset, int] = {frozenset(): 0}
        self.states: list[dict[int, int]] = [{}]
        self.moves: list[dict[str, int]] = [{}]
        self.accepts: list[tuple[int, int] | None] = [None]
        self.held = 0
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """The number of the state of these (node: edits), after letters of terms that a word may leave out."""
        todo = list(nodes.items())
        for node, e in todo:
            if nodes[node] == e:
                for child in self.children[node].values():
                    if e + 1 <= self.budget[child] and e + 1 < nodes.get(child, 9):
                        nodes[child] = e + 1
                        todo.append((child, e + 1))
        key = frozenset(nodes.items())
        if key not in self.numbers:
            ends = [(e, self.ends[n]) for n, e in nodes.items() if self.ends[n] >= 0 and e <= edits_of(self.terms[self.ends[n]])]
            self.numbers[key] = len(self.states)
            self.states.append(nodes)
            self.held += len(nodes)
            self.moves.append({})
            self.accepts.append(min(ends, default=None))
        return self.numbers[key]

    def _step(self, state: int, c: str) -> int:
        new: dict[int, int] = {}
        for node, e in self.states[state].items():
            for letter, child in self.children[node].items():
                cost = e + (letter != c)
                if cost <= self.budget[child] and cost < new.get(child, 9):
                    new[child] = cost
            if e + 1 <= self.budget[node] and e + 1 < new.get(node, 9):
                new[node] = e + 1
        return self._state(new)

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term number) of the nearest term within its edits; ties: the first term."""
        if word in self.exact:
            return 0, self.exact[word]
        if not self._may(word):
            return None
        if len(self.states) > self.most_states or self.held > MOST_NODES:
            self._clear()
        state = self.start
        for c in word:
            state = self.moves[state].get(c) or self._move(state, c)
            if not state:
                return None
        return self.accepts[state]

    def _move(self, state: int, c: str) -> int:
        to = self._step(state, c)
        self.moves[state][c] = to
        return to


class Model(NamedTuple):
    terms: list[str]
    odds: list[float]
    by_edits: list[float]  # what a misspelling that training rows don't have weighs less than its term, by edits
    known: dict[str, float]  # words near a term that training rows have
    coefficients: list[float]
    intercept: float


def plain(word: str) -> str:
    """The word's letters, lower-cased, without what is not a letter at its ends."""
    word = word.lower()
    lo, hi = 0, len(word)
    while lo < hi and not word[lo].isalpha():
        lo += 1
    while hi > lo and not word[hi - 1].isalpha():
        hi -= 1
    return word[lo:hi]


class Scorer:
    """Hit features of texts under a model; keeps the weights of words it has met in a table of fixed size."""

    def __init__(self, model: Model):
        self.model, self.trie = model, FuzzyTrie(model.terms)
        self.hasher = WordHasher(811)
        self.keys = np.zeros(1 << SLOTS_LOG2, np.uint64)
        self.weights = np.zeros(1 << SLOTS_LOG2, np.float32)

    def weight(self, word: str) -> float:
        if len(word) < 3:
            return 0.0
        found = self.trie.match(word)
        if found is None:
            return 0.0
        edits, term = found
        if not edits:
            return self.model.odds[term]
        return max(0.0, self.model.known.get(word, self.model.odds[term] - self.model.by_edits[edits]))

    def features(self, t: Texts) -> np.ndarray:
        out = np.zeros((len(t.first) - 1, len(FEATURES)))
        if not len(t.starts):
            return out
        data, starts, ends, first = parts(t)
        h = self.hasher(data, starts, ends)
        h[h == 0] = 1
        slot = (h >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)
        new = np.flatnonzero(self.keys[slot] != h)
        weights = self.weights[slot]
        raw = data.tobytes()
        if len(new):
            _, at, back = np.unique(h[new], return_index=True, return_inverse=True)
            where = new[at]
            found = np.array([
                self.weight(plain(raw[a:b].decode("utf-8", "replace")))
                for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)
            ], np.float32)
            weights[new] = found[back]
            last = len(where) - 1 - np.unique(slot[where][::-1], return_index=True)[1]
            self.keys[slot[where[last]]], self.weights[slot[where[last]]] = h[where[last]], found[last]
        out[:, 6] = np.log1p(np.diff(first))
        hits = np.flatnonzero(weights > 0)
        texts_of = np.searchsorted(first, hits, "right") - 1
        for k in np.unique(texts_of).tolist():
            own = hits[texts_of == k]
            out[k, :6] = self._document(raw, starts, ends, int(first[k]), int(first[k + 1]), own, weights[own])
        return out

    def _document(self, raw, starts, ends, lo, hi, hits, weights) -> tuple:
        scores, quoted, addressed, terms = [], 0.0, 0.0, set()
        for at, weight in zip(hits.tolist(), weights.tolist(), strict=True):
            a, b = max(lo, at - WINDOW), min(hi, at + WINDOW + 1)
            around = raw[starts[a] : ends[b - 1]].decode("utf-8", "replace")
            words = {plain(w) for w in around.split()}
            in_quotes = any(m in around for m in MARKS) or bool(words & REPORTING)
            to_someone = bool(words & ADDRESS)
            others = int(np.searchsorted(hits, b) - np.searchsorted(hits, a)) - 1
            scores.append(weight * (1 + 0.25 * min(others, 4) + 0.25 * to_someone) * (0.5 if in_quotes else 1.0))
            quoted, addressed = quoted + in_quotes, addressed + to_someone
            terms.add(raw[starts[at] : ends[at]])
        n = len(scores)
        return max(scores), math.log1p(sum(scores)), math.log1p(len(terms)), n / (hi - lo), quoted / n, addressed / n


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _near(batches: Iterator[pa.RecordBatch], terms: list[str]) -> Iterator[pa.RecordBatch]:
    """The words within a term's edits, with the edits."""
    trie = FuzzyTrie(terms)
    for batch in batches:
        found = [trie.match(w) for w in batch.column("word").to_pylist()]
        keep = pa.array([f is not None for f in found])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).filter(keep) for c in ("word", "bad", "good")), pa.array([f[0] for f in found if f], pa.int32())],
            ["word", "bad", "good", "edits"],
        )


_scorers: list[Scorer] = []


def _scorer(model: Model) -> Scorer:
    """The worker's scorer, with the words met in earlier tasks of the same model."""
    if not _scorers or _scorers[0].model is not model:
        _scorers[:] = [Scorer(model)]
    return _scorers[0]


def _features(batches: Iterator[pa.RecordBatch], model, carry: list[str]) -> Iterator[pa.RecordBatch]:
    scorer = _scorer(model.value)
    for batch in batches:
        for t in texts(batch.column("text")):
            found = scorer.features(t)
            own = [batch.column(c)[t.rows.start : t.rows.stop] for c in carry]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(x) for x in found.T)], [*carry, *FEATURES])


def featured(docs: DataFrame, model: Model, carry: dict[str, str]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join([*(f"{c} {t}" for c, t in carry.items()), *(f"{f} double" for f in FEATURES)])
    return docs.select(*carry, "text").mapInArrow(partial(_features, model=sent, carry=list(carry)), schema)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model | None:
    """The model from the labelled documents outside the held-out fold (of the smallest id hashes, if over ``rows``)."""
    some = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    some = stored(some, "toxic-labels")
    # At most ``rows`` rows of two numbers.
    train = docs.join(F.broadcast(some), "doc_id").select("doc_id", "toxic", "text")
    sizes = some.groupBy("toxic").count().collect()
    bad, good = (sum(r["count"] for r in sizes if (r.toxic > 0) == side) for side in (True, False))
    if not bad or not good:
        return None
    # As ``plain`` cuts them.
    words = F.expr(
        "array_distinct(transform(split(lower(coalesce(text, '')), '[\\\\x20\\\\x09-\\\\x0D]+'),"
        " w -> regexp_replace(w, '^[^\\\\p{L}]+|[^\\\\p{L}]+$', '')))"
    )
    counted = stored(
        train.select("toxic", F.explode(words).alias("word")).where("length(word) between 3 and 40")
        .groupBy("word").agg(F.sum((F.col("toxic") > 0).cast("long")).alias("bad"), F.sum((F.col("toxic") <= 0).cast("long")).alias("good")),
        "toxic-words",
    )

    def odds(x: float, y: float) -> float:
        return math.log((x + 0.5) / (bad + 1)) - math.log((y + 0.5) / (good + 1))

    score = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    least = min(MIN_TOXIC, max(2, bad // 20))
    # Chernoff's bound: chance has a word in ``bad`` or more toxic documents of all its own with at most exp(-surprise).
    both, share = F.col("bad") + F.col("good"), bad / (bad + good)
    surprise = F.col("bad") * F.log(F.col("bad") / both / share) + F.when(
        F.col("good") > 0, F.col("good") * F.log(F.col("good") / both / (1 - share))
    ).otherwise(0.0)
    beyond = math.log(max(1, counted.count()) / BY_CHANCE)
    lexicon = (
        counted.where(F.col("bad") >= least).withColumn("odds", score)
        .where((F.col("odds") >= MIN_ODDS) & (surprise >= beyond))
        .orderBy(F.desc("odds"), F.desc("bad"), "word").limit(LEXICON).collect()
    )
    terms = [r.word for r in lexicon]
    near = stored(counted.mapInArrow(partial(_near, terms=terms), "word string, bad long, good long, edits int"), "toxic-near")
    known = near.where("edits > 0").orderBy(F.desc(F.col("bad") + F.col("good")), "word").limit(KNOWN).collect()
    by_edits = [EDIT * e for e in range(3)]
    model = Model(terms, [r.odds for r in lexicon], by_edits, {r.word: odds(r.bad, r.good) for r in known}, [], 0.0)
    rows_ = stored(featured(train, model, {"toxic": "int"}), "toxic-features")
    rows_ = rows_.withColumn("label", (F.col("toxic") > 0).cast("double"))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows_)
    fitted = LogisticRegression(featuresCol="x", labelCol="label", regParam=1e-3, maxIter=60, tol=1e-7).fit(vectors)
    return model._replace(coefficients=[float(c) for c in fitted.coefficients], intercept=float(fitted.intercept))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    ready(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = fit(docs, labels)
    if model is None:
        rows = docs.withColumn("score", F.lit(0.0))
    else:
        line = " + ".join(f"{c!r}D * {f}" for c, f in zip(model.coefficients, FEATURES, strict=True))
        rows = featured(docs, model, {"doc_id": "long"}).withColumn("score", F.expr(f"1D / (1D + exp(-({model.intercept!r}D + {line})))"))
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
