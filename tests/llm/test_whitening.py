import math
from fractions import Fraction

import numpy as np
import pytest

from ledgerline.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, label int, n long, component string, v double"


def frame(spark, vectors, parts=3):
    return spark.createDataFrame([(i, v, 1, 2, "x", 3.0) for i, v in vectors], SCHEMA).repartition(parts)


def random_symmetric(rng, n, values):
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    return (q * values) @ q.T


@pytest.mark.parametrize("n,kind", [(1, "spread"), (2, "spread"), (3, "ties"), (12, "spread"), (40, "spread"), (40, "ties"), (40, "near"), (25, "rank"), (16, "diagonal"), (9, "zero")])
def test_eigenvectors_equal_the_library(n, kind):
    rng = np.random.default_rng(n)
    values = {
        "spread": np.sort(rng.uniform(0.1, 9, n))[::-1],
        "ties": np.repeat(np.arange(n, 0, -1.0), 5)[:n] if n > 5 else np.ones(n),
        "near": 5 + 1e-9 * np.arange(n)[::-1],
        "rank": np.where(np.arange(n) < 4, 3.0 - 0.1 * np.arange(n), 0),
        "diagonal": np.arange(n, 0, -1.0),
        "zero": np.zeros(n),
    }[kind]
    matrix = np.diag(values[::-1]) if kind in ("diagonal", "zero") else random_symmetric(rng, n, values)
    matrix = (matrix + matrix.T) / 2
    e, v = w.leading_components(matrix, 8)
    k = min(n, 8)
    norm = max(np.abs(values).max(), 1e-300)
    assert e.shape == (k,) and v.shape == (k, n)
    assert np.abs(e - np.linalg.eigvalsh(matrix)[::-1][:k]).max() < 1e-14 * n * norm + 1e-300
    assert np.abs(v @ v.T - np.eye(k)).max() < 1e-13
    assert np.abs(v @ matrix - e[:, None] * v).max() < 1e-13 * norm + 1e-300


def brute(vectors, dims):
    """Everything by exact integers, eigenvectors by the library."""
    rows = [
        (i, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v])
        for i, v in vectors
        if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) and abs(np.float32(c)) < 2.0**40 for c in v)
    ]
    n = len(rows)
    s = [sum(x[j] for _, x in rows) for j in range(dims)]
    centred = [[n * x[j] - s[j] for j in range(dims)] for _, x in rows]
    cov = np.array([[float(Fraction(sum(c[a] * c[b] for c in centred), n**3)) for b in range(dims)] for a in range(dims)])
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1].T
    white = (np.array(centred, float) / n) @ v[:8].T / np.sqrt(np.maximum(e[:8], 1e-300))
    return [i for i, _ in rows], n, [sum(c * c for c in row) for row in centred], e, white, np.trace(cov)


def vectors(seed, dims=10, count=300):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(dims, dims)) * np.linspace(2, 0.2, dims)
    out = [(i, [float(c) for c in rng.normal(size=dims) @ mix + 0.3]) for i in range(count)]
    hot = out[7][1]
    out += [(count + i, hot) for i in range(150)]
    odd = [None, [], [1.0] * (dims + 1), [float("nan")] + [0.0] * (dims - 1), [float("inf")] * dims, [None] + [1.0] * (dims - 1), [3e38] * dims]
    return out + [(9000 + i, v) for i, v in enumerate(odd)] + [(None, out[3][1]), (5, out[5][1])]


def test_whitened_vectors_equal_exact_arithmetic(spark):
    data = vectors(1)
    ids, n, far, e, white, trace = brute(data, 10)
    got = w.digests(frame(spark, data)).collect()
    assert len(got) == 8 * len(ids) and {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    for c in range(1, 9):
        sign = None
        for i, d, z in zip(ids, far, white[:, c - 1], strict=True):
            for r in by[i, c]:
                assert r.deviation in (x for k, x in zip(ids, far, strict=True) if k == i) and int(r.deviation_wide) == r.deviation
                assert abs(r.explained / (e[c - 1] / trace) - 1) < 1e-12
            if len(by[i, c]) == 1 and abs(z) > 1e-6:
                sign = sign or math.copysign(1, z * r.whitened)
                assert abs(by[i, c][0].whitened * sign - z) < 1e-9
    assert {r.vec_id for r in got} == set(ids)


def test_result_does_not_hang_on_partitions(spark):
    data = vectors(2)
    one, many = (
        {(r.vec_id, r.component): r for r in w.digests(frame(spark, data, parts)).collect() if r.vec_id not in (None, 5)} for parts in (1, 13)
    )
    assert one.keys() == many.keys()
    for c in range(1, 9):
        sign = math.copysign(1, one[0, c].whitened * many[0, c].whitened)
        assert all(abs(one[k].whitened - sign * many[k].whitened) < 1e-9 and one[k].deviation == many[k].deviation for k in one if k[1] == c)


def test_whiten_keeps_other_columns(spark):
    data = vectors(3)
    rows = frame(spark, data).withColumn("whitened", w.F.lit("old"))
    model = w.fit(rows)
    got = w.whiten(rows, model).collect()
    assert len(got) == model.n and got[0].component == "x" and len(got[0].whitened) == 8
    z = np.array([r.whitened for r in got])
    assert np.abs(np.cov(z.T, bias=True) - np.eye(8)).max() < 1e-10 and np.abs(z.mean(axis=0)).max() < 1e-10


def test_deviations_beyond_a_long():
    rng = np.random.default_rng(4)
    for n, top in ((1000, 1000), (5_000_000, 2000), (3_000_000, 1 << 30), (1 << 20, 1 << 53)):
        y = rng.integers(-top, top, (20, 6))
        model = w.Whitening(6, n, [int(v) for v in rng.integers(-top, top, 6) * n // 2], np.ones(1), np.ones((1, 6)), 1.0)
        want = [sum((n * (int(a) + 100000) - s) ** 2 for a, s in zip(row, model.x_sums(), strict=True)) for row in y]
        assert model.deviations(y) == want


def test_empty_and_equal_vectors(spark):
    assert w.digests(frame(spark, [])).collect() == []
    assert w.digests(frame(spark, [(1, None), (2, [])])).collect() == []
    same = frame(spark, [(i, [0.5, 0.25]) for i in range(5)])
    assert w.digests(same).collect() == [] and w.whiten(same, w.fit(same)).collect() == []
    two = w.digests(frame(spark, [(1, [0.0, 1.0]), (2, [1.0, 0.0])])).collect()
    assert [(r.component, abs(round(r.whitened, 9)), r.explained) for r in two] == [(1, 1.0, 1.0)] * 2
