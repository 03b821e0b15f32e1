import random
import zlib

import pytest

from ledgerline.llm import toxicity as tx
from ledgerline.llm.words import texts


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


@pytest.mark.parametrize("most_states", [1 << 16, 3])
def test_automaton_equals_edit_distance(most_states):
    rng = random.Random(1)
    terms = ["idiot", "idle", "réeuxment", "abcdefghijk", "abcdefghij", "zz", "moron", "morons"]
    trie = tx.FuzzyTrie(terms, most_states)
    words = [""] + terms
    for _ in range(1500):
        w = list(rng.choice(terms))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w) + 1)
            w[at : at + rng.randrange(2)] = rng.choice(["", "x", "a", "é", "i"])
        words.append("".join(w))
    for w in words:
        near = [(distance(w, t), k) for k, t in enumerate(terms) if distance(w, t) <= tx.edits_of(t)]
        assert trie.match(w) == min(near, default=None), w


def model():
    return tx.Model(["moron"], [3.0], [0.0, 1.5, 1.0], {"morons": 0.2}, [], 0.0)


def test_context_separates_quotation_from_abuse():
    import pyarrow as pa

    docs = ["what a moron that one is", "the word “moron” he wrote there", "you moron you", "a m0ron or moran here", "no hits at all", "", None, "two morons"]
    scorer = tx.Scorer(model())
    got = [row.tolist() for t in texts(pa.array(docs)) for row in scorer.features(t)]
    again = [row.tolist() for t in texts(pa.array(docs), slice_bytes=30) for row in scorer.features(t)]
    assert got == again
    strongest = [r[0] for r in got]
    assert strongest[1] < strongest[0] < strongest[2] and 0 < strongest[3] < strongest[0]
    assert got[4][:6] == got[5][:6] == got[6][:6] == [0.0] * 6
    assert strongest[7] == pytest.approx(0.2, abs=1e-6)


def corpus(n=600):
    rng = random.Random(4)
    vocab = [f"w{c}{d}" for c in "abcdefghij" for d in "klmnop"] + ["the", "of", "moral"]
    bad = ["idiot", "pathetic", "worthless", "scum"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randrange(5, 60))]
        toxic = int(rng.random() < 0.3)
        for _ in range(3 * toxic):
            w = rng.choice(bad)
            words[rng.randrange(len(words))] = w if rng.random() < 0.8 or len(w) < 5 else w[:2] + "x" + w[3:]
        docs.append((i, " ".join(words), "toxic"))
        labels.append((i, 1, toxic))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    docs += [(1000, None, "x"), (1001, "", "x"), (None, "idiot idiot idiot scum", "x"), (5, docs[5][1], "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string, toxic string").repartition(3)
    lab = spark.createDataFrame(labels + [(5, 1, None), (None, 0, 1), (7, 0, 0)], "doc_id long, quality int, toxic int")
    rows = tx.score(d, lab).collect()
    assert len(rows) == len(docs)
    truth = {i: t for i, _, t in labels}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert len(held) > 80 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[1000].score == by[1001].score < 0.5 and by[None].predicted == 1


def test_without_labels_or_rows(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [(r.score, r.predicted) for r in tx.score(d, lab).collect()] == [(0.0, 0)]
    assert tx.score(d.limit(0), lab).collect() == []


def test_misspellings_that_training_does_not_hold(spark):
    docs, labels = corpus()
    # Ordinary neighbours of the terms, in clean documents and toxic ones.
    docs = [(i, text + (" idiom worthiess" if i % 2 else " idiotic pathetik"), x) for i, text, x in docs]
    vocab = "waka wbl wcm wdn the of wep wfo wgk whl"
    odd = ["idi0t", "1diot", "patheticc", "worthl3ss", "idiott", "path3tic"]
    docs += [(2000 + k, f"{vocab} {w} {vocab} {w} {odd[k - 1]}", "x") for k, w in enumerate(odd)]
    docs += [(2100, f"{vocab} idiom {vocab} worthiess pathetik", "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string, toxic string").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    by = {r.doc_id: r.predicted for r in tx.score(d, lab).collect()}
    assert [by[2000 + k] for k in range(len(odd))] == [1] * len(odd) and by[2100] == 0


def test_rare_words_of_toxic_documents_are_terms(spark):
    rng = random.Random(6)
    vocab = [f"w{c}{d}" for c in "abcdefghij" for d in "klmnop"]
    # 5,000 toxic documents of 10,000: a 200th of them is more than have any of the rare words.
    rare = [a + b + "ggot" for a in "bcdfg" for b in "aeio"]
    docs, labels = [], []
    for i in range(10_000):
        words = [rng.choice(vocab) for _ in range(8)]
        if i % 2:
            words[3] = "scum" if i // 2 % 15 else rare[i // 30 % 20]
        docs.append((i, " ".join(words)))
        labels.append((i, 1, i % 2))
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert set(rare) <= set(tx.fit(d, lab).terms)
    truth = {i for i, text in docs if set(text.split()) & set(rare)}
    held = [r for r in tx.score(d, lab).collect() if r.held_out]
    hits = [r.predicted for r in held if r.doc_id in truth]
    assert len(hits) > 30 and sum(hits) >= 0.9 * len(hits)
    assert sum(r.predicted for r in held if not r.doc_id % 2) == 0
