import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import token_store as ts
from ledgerline.llm.tokens import default_vocabulary
from tests.llm.test_packing import corpus


@pytest.mark.parametrize("n,top", [(0, 2), (1, 1), (700, 49408), (5000, 3), (1537, 70000)])
def test_wavelet_matrix(tmp_path, n, top):
    rng = random.Random(n)
    ids = np.array([rng.randrange(top) for _ in range(n)], np.uint32)
    path = f"file://{tmp_path}/a/b.wvm"
    ts.write_shard(path, [5, None], np.array([0, n // 2, n]), ids)
    docs, bounds, m = ts.read_shard(path)
    assert docs == [5, None] and bounds.tolist() == [0, n // 2, n]
    assert m.ids().tolist() == ids.tolist()
    for i in rng.sample(range(n), min(n, 60)):
        assert m.access(i) == ids[i]
        token = int(ids[rng.randrange(n)])
        assert m.rank(token, i) == int((ids[:i] == token).sum())
        where = np.flatnonzero(ids == token)
        k = rng.randrange(len(where))
        assert m.select(token, k) == where[k]
    assert m.rank(1 << 20, n) == 0
    with pytest.raises(IndexError):
        m.select(1 << 20, 0)


@pytest.mark.parametrize("shard_tokens", [1 << 24, 50])
def test_round_trip_against_the_library(spark, monkeypatch, shard_tokens):
    monkeypatch.setattr(ts, "SHARD_TOKENS", shard_tokens)
    docs = [(i * 7 - 50, d) for i, d in enumerate(corpus(5))] + [(None, "no id"), (-50, corpus(5)[0])]
    random.Random(1).shuffle(docs)
    plain = Tokenizer.from_file(default_vocabulary())
    want, start = [], 0
    for d, text in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    frame = spark.createDataFrame([(d, t, 0, "x") for d, t in docs], "doc_id long, text string, start int, file string")
    got = [tuple(r) for r in ts.digests(frame.repartition(3)).collect()]
    assert sorted(got, key=lambda r: r[1]) == want


def test_empty_table(spark):
    assert ts.digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []
