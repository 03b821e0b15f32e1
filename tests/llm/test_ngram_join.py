import random
import re

import pytest

from ledgerline.llm import ngram_join as nj


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(docs):
    sets = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(text))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= 75 * len(x | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return sorted(((d, len(sets[i]), ids.get(find(i), d)) for i, (d, _) in enumerate(docs)), key=str)


def corpus(seed, groups=25):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["É", "ß", "The", "the", "A,"]
    fresh = lambda n: [rng.choice(vocab) for _ in range(n)]
    common = fresh(30)
    docs = []
    for _ in range(groups):
        base = fresh(rng.choice([3, 5, 9, 20, 60, 150])) + rng.choice([[], common, common[:9]])
        for _ in range(rng.choice([1, 2, 3, 8])):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                at = rng.randrange(len(w))
                w[at : at + rng.choice([0, 1])] = fresh(1)
            docs.append(" ".join(w) if rng.random() < 0.8 else "\n".join(w).upper())
    rng.shuffle(docs)
    docs += [None, "", " \t", docs[0], docs[0].upper()]
    return [(i * 3, t) for i, t in enumerate(docs)] + [(0, docs[0]), (None, docs[3]), (None, "only this one here is so unlike")]


def result(spark, docs, parts=4):
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, node string, n int")
    rows = nj.join_components(frame.repartition(parts)).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs = corpus(seed)
    assert result(spark, docs) == brute(docs)


@pytest.mark.parametrize("rare,few", [(1, 12), (2, 2), (3, 40)])
def test_frequent_tokens_equal_brute_force(spark, monkeypatch, rare, few):
    """Nearly every token counts as frequent: links come from stars and combinations."""
    monkeypatch.setattr(nj, "RARE", rare)
    monkeypatch.setattr(nj, "FEW", few)
    docs = corpus(7 + rare, groups=18)
    assert result(spark, docs, 1) == brute(docs)


def test_empty_table(spark):
    assert result(spark, []) == []
