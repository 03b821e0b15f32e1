"""Bucketed neighbour lookup equals a per-account Python loop on random ledgers."""

import random

import pytest
from pyspark.sql import types as T

from ledgerline.operators.neighbors import add_neighbors

SCHEMA = T.StructType(
    [
        T.StructField("k", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("v", T.DoubleType()),
        T.StructField("s", T.StringType()),
    ]
)


def _expected(rows):
    by_key = {}
    for k, seq, v, s in sorted(rows, key=lambda r: r[1]):
        by_key.setdefault(k, []).append((seq, v, s))
    out = {}
    for k, items in by_key.items():
        for i, (seq, v, s) in enumerate(items):
            nxt = items[i + 1] if i + 1 < len(items) else (None, None, None)
            prv = items[i - 1] if i > 0 else (None, None, None)
            out[seq] = (nxt[1], prv[1], prv[2])
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("span", [1, 3, 17, 1000])
def test_bucketed_equals_loop(spark, seed, span):
    rnd = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    seqs = rnd.sample(range(0, 600), 200)
    rows = [(rnd.choice(keys), q, float(rnd.randint(0, 5)), rnd.choice(["x", "", None])) for q in seqs]
    df = spark.createDataFrame(rows, SCHEMA)
    got = add_neighbors(df, "k", "seq", lead={"nv": "v"}, lag={"pv": "v", "ps": "s"}, span=span)
    res = {r.seq: (r.nv, r.pv, r.ps) for r in got.collect()}
    assert res == _expected(rows)
    assert got.count() == len(rows)
