import hashlib
import random
import re
from collections import Counter

import pytest

from ledgerline.llm import substring_dedup as sd


def brute(docs, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(docs, words, strict=True):
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_cover_has_every_difference():
    assert {(a - b) % sd.PERIOD for a in sd.COVER for b in sd.COVER} == set(range(sd.PERIOD))


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["a", "bé", "ß", "d,", "été", "x y", "😀", "of", "the", " z"] + [f"w{i}" for i in range(300)]
    fresh = lambda n: [rng.choice(vocab) for _ in range(n)]
    passages = [fresh(n) for n in (34, 35, 36, 50, 90)]
    docs = []
    for i in range(60):
        w = fresh(rng.randrange(0, 80))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            k = rng.randrange(len(p))
            w += p[k % 3 :] + fresh(rng.randrange(3, 40))
        docs.append((i, rng.choice([" ", "\n", "\t ", "\x0b", "\r\n"]).join(w)))
    loop = ["one", "two"] * 60
    return docs + [(100, " ".join(loop)), (101, None), (102, ""), (103, " \n"), (104, docs[0][1]), (105, docs[7][1]),
                   (105, docs[7][1]), (None, docs[9][1]), (106, " ".join(fresh(3000) + passages[4] + fresh(3000)))]


@pytest.mark.parametrize("seed,window", [(1, 35), (2, 35), (3, 40), (4, 25)])
def test_equals_brute_force(spark, seed, window):
    docs = corpus(seed)
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, key string, h int")
    got = sorted((tuple(r) for r in sd.digests(frame.repartition(5), window).collect()), key=str)
    assert got == brute(docs, window)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert sd.digests(frame).collect() == []
