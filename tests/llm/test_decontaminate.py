import random

import numpy as np
import pytest

from ledgerline.llm import decontaminate as dc


def test_multi_index_finds_every_pair_within_the_radius():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 64, 40, dtype=np.uint64)
    near = prints[rng.integers(0, 40, 3000)]
    for k in range(9):
        near[k::9] ^= np.uint64(1) << rng.integers(0, 64, len(near[k::9]), dtype=np.uint64)
    for _ in range(6):
        near ^= np.where(rng.random(3000) < 0.7, np.uint64(1) << rng.integers(0, 64, 3000, dtype=np.uint64), np.uint64(0))
    for radius in (3, 6, 7):
        at, which = dc.MultiIndex(prints, radius).within(near)
        want = {(i, j) for i in range(3000) for j in range(40) if int(near[i] ^ prints[j]).bit_count() <= radius}
        assert set(zip(at.tolist(), which.tolist(), strict=True)) == want


def test_simhash_is_the_majority_of_bits():
    h = np.random.default_rng(2).integers(0, 1 << 64, 30, dtype=np.uint64)
    got = dc.simhashes(h, 7)
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).astype(int)
    for i in range(24):
        assert (np.unpackbits(got[i : i + 1].view(np.uint8)) == (bits[i : i + 7].sum(axis=0) > 3.5)).all()


def test_sums_of_very_long_windows_do_not_overflow():
    h = np.full(40_000, 0xF0F0F0F0F0F0F0F0, np.uint64)
    assert set(dc.simhashes(h, 33_000).tolist()) == {0xF0F0F0F0F0F0F0F0}


def weighted(item, segment, bench):
    """Weighted Jaccard similarity of two word lists, by counting."""
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)]
    x, y = grams(item), grams(segment)
    weight = lambda g: np.log2(1 + len(bench) / max(1, sum(g in grams(b) for b in bench)))
    every = set(x) | set(y)
    return sum(weight(g) * min(x.count(g), y.count(g)) for g in every) / sum(weight(g) * max(x.count(g), y.count(g)) for g in every)


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_planted_items_are_found_and_clean_documents_are_not(spark, block_bytes):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)] + ["the", "of", "and"] * 30
    fresh = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [fresh(n) for n in (3, 7, 15, 16, 20, 33, 37, 40, 59, 61, 120)] + [["é", "😀", "x,"] * 6]
    items.append(items[5])
    docs, want = [], set()
    for d in range(80):
        words = fresh(rng.randrange(0, 300))
        if d % 2:
            i = d // 2 % len(items)
            item = list(items[i])
            if d % 3 == 0 and len(item) > 50:
                item[len(item) // 2] = "changed"
            at = rng.randrange(len(words) + 1)
            words[at:at] = item
            want |= {(d, j) for j in range(len(items)) if items[j] == items[i]}
        docs.append((d, (" \n"[d % 5 == 0]).join(words).replace("the", "THE" if d % 7 == 0 else "the"), "x"))
    docs += [(None, " ".join(items[6]), "x"), (200, None, "x"), (201, "", "x"), (202, " ".join(fresh(20_000) + items[8]), "x"), (1, docs[1][1], "x")]
    want |= {(None, 6), (202, 8)}
    bench = [(i, " ".join(w)) for i, w in enumerate(items)] + [(90, None), (91, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string, row string").repartition(3)
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = dc.find(d, b, block_bytes=block_bytes).collect()
    # A three-word item may also occur by chance.
    assert want <= {(r.doc_id, r.item_id) for r in got}
    for r in got:
        text = next(t for i, t, _ in docs if i == r.doc_id).replace("THE", "the").split()
        value = weighted(items[r.item_id], text[r.start_word : r.end_word], items + [[], []] if block_bytes > 300 else items)
        if block_bytes > 300:
            assert abs(value - r.similarity) < 1e-9
        assert value >= 0.7 and ((r.doc_id, r.item_id) in want or len(items[r.item_id]) < 8)
    assert sum(r.doc_id == 1 for r in got) == 2 * sum(x[0] == 1 for x in want)


def test_empty_tables(spark):
    d, b = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert dc.find(d, b).collect() == [] == dc.find(one, b).collect()
    assert dc.find(d, one.withColumnRenamed("doc_id", "item_id")).collect() == []


def test_similarity_does_not_depend_on_blocks(spark):
    rng = random.Random(8)
    fresh = lambda n: [f"v{rng.randrange(500)}" for _ in range(n)]
    common = fresh(12)
    items = [fresh(20) + common + fresh(8) for _ in range(8)] + [fresh(30) for _ in range(8)]
    docs = []
    for d in range(40):
        item = list(items[d % 16])
        item[rng.randrange(len(item))] = "changed"
        # Words that other items have, inside the place.
        item[-6:] = common[:6] if d % 3 == 0 else item[-6:]
        docs.append((d, " ".join(fresh(50) + item + fresh(50))))
    docs.append(docs[1])
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    one, many = (
        sorted((r.doc_id, r.item_id, r.start_word, r.end_word, round(r.similarity, 9)) for r in dc.find(d, b, similarity=0.4, block_bytes=n).collect())
        for n in (1 << 20, 400)
    )
    assert one == many and len(one) > 30
    assert dc.RADIUS >= 7


def test_copies_with_words_put_in_or_left_out_are_found(spark):
    rng = random.Random(21)
    fresh = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    items = [fresh(n) for n in (50, 52, 55, 57, 59, 80, 120, 121)]
    docs, want = [], set()
    for d in range(200):
        item = items[d % 8]
        copy, at = list(item), rng.randrange(len(item))
        for _ in range(rng.randrange(1, 9)):
            p = min(len(copy) - 1, max(0, at + rng.randrange(-4, 5)))
            copy[p : p + rng.randrange(2)] = [] if rng.randrange(2) else fresh(1)
        docs.append((d, " ".join(fresh(40) + copy + fresh(40))))
        if weighted(item, copy, items) >= 0.75:
            want.add((d, d % 8))
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = dc.find(d, b).collect()
    assert len(want) > 100 and len(want - {(r.doc_id, r.item_id) for r in got}) <= len(want) // 50
    for r in got:
        text = docs[r.doc_id][1].split()
        assert abs(weighted(items[r.item_id], text[r.start_word : r.end_word], items) - r.similarity) < 1e-9
        assert r.item_id == r.doc_id % 8 and r.similarity >= 0.75
