import random
import re
import zlib
from collections import Counter

import pytest

from ledgerline.llm import spelling as sp

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(n):
    rows, form = {}, {}
    for w in n:
        close = [x for x in n if near(w, x)]
        best = min(close, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
        rows[w] = len(close)
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], rows[w], n[form[w]] if form[w] else None))
    return out


def vocabulary(seed, size=400, letters="abé", least=1, most=11):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(least, most))) for _ in range(size)}
    return {w: rng.choice([2, 3, 20, 21, 200, 200, 5000]) for w in sorted(words)}


def frame(spark, n):
    return spark.createDataFrame(list(n.items()), "word string, n long").repartition(5)


def result(rows):
    return sorted((tuple(r) for r in rows.collect()), key=str)


@pytest.mark.parametrize("seed,letters,state_chars", [(1, "abé", sp.STATE_CHARS), (2, "ab", 40), (3, "abcdefgh", 0), (4, "aÿ\U0001f600", 12), (5, "a", 5)])
def test_forms_equal_comparing_all(spark, monkeypatch, seed, letters, state_chars):
    n = vocabulary(seed, letters=letters)
    want = sorted(brute(n), key=str)
    assert result(sp.variants(frame(spark, n), state_chars=state_chars)) == want
    assert any(r[1] != r[2] and r[1] for r in want) or len(letters) != 3


def test_chunks_are_cut_between_states(monkeypatch):
    """The composition in tiny chunks and matrices gives the pairs that comparing all gives."""
    n = vocabulary(6, size=300, least=2)
    words = sorted(n)
    rows = []
    for w in words:
        for back in (False, True):
            for short in (len(w), len(w) - 1):
                h = short // 2
                part, rest = (w[len(w) - (short - h) :], w[: len(w) - (short - h)][::-1]) if back else (w[:h], w[h:])
                rows.append((zlib.crc32(repr((back, short, part)).encode()), len(w) > short, back, rest, w, n[w]))
    rows.sort(key=lambda r: (r[0], r[1], r[3]))
    for chunk in (1, 50, 1 << 21):
        monkeypatch.setattr(sp, "CHUNK_CHARS", chunk)
        got = Counter()
        table = sp.pa.Table.from_pylist([dict(zip(sp._STARTS, r, strict=True)) for r in rows])
        for batch in sp._compose(iter(table.to_batches(max_chunksize=37))):
            for r in batch.to_pylist():
                got[r["word"]] += r["n_near"]
        assert got == {w: k for w in words if (k := sum(near(w, x) for x in words))}


def test_minimised_and_numbered():
    import numpy as np

    words = sorted(a + b for a in ("ab", "ac", "bc", "zz") for b in ("ing", "ed!", "est"))
    cells = np.array([[ord(c) for c in w] for w in words], np.uint32)
    a = sp.Acceptor(np.zeros(len(words), np.int64), np.full(len(words), 5), cells)
    # The end, three and two states inside the endings, one before them, behind a, b and z one each, the start.
    assert len(a.strings) == 1 + 3 + 2 + 1 + 3 + 1
    for i, w in enumerate(words):
        state, number = int(a.state[0]), 0
        for c in w:
            arc = int(a.follow(np.array([state]), np.array([ord(c)]))[0])
            number, state = number + int(a.skip[arc]), int(a.child[arc])
        assert (state, number) == (0, i)


def texts(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeEFé×÷ÿß") for _ in range(rng.randint(5, 12))) for _ in range(60)]
    docs = []
    for i in range(200):
        body = [rng.choice(base[: rng.choice([5, 60])]) for _ in range(rng.randint(0, 60))]
        docs.append((i, "".join(w + rng.choice([" ", ", ", "1", "\n", "Ā", "'", "…"]) for w in body)))
    docs += [(None, docs[3][1]), (7, docs[7][1]), (200, None), (201, ""), (202, "q" * 300_000 + " " + "q" * 300_000), (203, "ÿ" * 9), (204, "ÿ" * 9)]
    return docs


def test_query_equals_brute_force(spark):
    docs = texts(1)
    rows = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, word string").repartition(4)
    n = counted(docs)
    assert {(r.word, r.n) for r in sp.vocabulary(rows).collect()} == set(n.items())
    assert result(sp.variants(sp.vocabulary(rows))) == sorted(brute(n), key=str)
    assert any(k for _, k in n.items()) and "q" * 300_000 in n


def test_tiny_slices_count_alike(spark, monkeypatch):
    docs = texts(2)
    ids, column = [i for i, _ in docs], sp.pa.array([t for _, t in docs], sp.pa.string())
    monkeypatch.setattr(sp, "SLICE_BYTES", 300)
    monkeypatch.setattr(sp, "HELD_WORDS", 10)
    got = Counter()
    for batch in sp._counts(7, 31)(iter([sp.pa.RecordBatch.from_arrays([sp.pa.array([None if i is None else str(i) for i in ids]), column], ["doc_id", "text"])])):
        for r in batch.to_pylist():
            got[r["word"]] += r["n"]
    assert {w: k for w, k in got.items() if k >= 2} == counted(docs)


def test_very_long_words(spark):
    rng = random.Random(3)
    body = "".join(rng.choice("abc") for _ in range(30_000))
    n = {body: 50, body[:100] + body[101:]: 2, body[:-1] + "z": 3, "z" + body: 4, body[::-1]: 2, body[:20_000] + "y" + body[20_001:]: 70}
    assert result(sp.variants(frame(spark, n))) == sorted(brute(n), key=str)


def test_empty_table(spark):
    rows = spark.createDataFrame([], "doc_id long, text string")
    assert sp.variants(sp.vocabulary(rows)).collect() == []
