import math

import numpy as np
import pytest

from shelfcast.llm import whitening as W

from .conftest import SF

KIND = "vec_id bigint, embedding array<float>, n int, component int, z int, key string"


def brute(rows, k=16):
    """{(vec_id, component): (n, deviation, |whitened|, explained)} by plain numpy over the distinct integer vectors."""
    ints = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in ints})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    y = np.array([[(n * x[j] - sums[j]) / n for j in range(d)] for x in fit])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    z = {x: r for x, r in zip(fit, y @ vectors / np.sqrt(values), strict=True)}
    total = float(np.trace(y.T @ y / n))
    return [(i, c + 1, n, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)), z[x][c], values[c] / total) for i, x in ints for c in range(len(values))]


def same(got, want):
    got, want = ([sorted(r, key=lambda t: (t[0] is None, t[0] or 0, t[1], abs(t[4]))) for r in (got, want)])
    assert [t[:4] for t in got] == [t[:4] for t in want]
    assert np.allclose([abs(t[4]) for t in got], [abs(t[4]) for t in want], rtol=1e-6, atol=1e-7)
    assert np.allclose([t[5] for t in got], [t[5] for t in want], rtol=1e-8)
    signs = {}  # either sign, but one for all rows
    for a, b in zip(got, want, strict=True):
        if abs(b[4]) > 1e-3:
            signs.setdefault(a[1], set()).add(np.sign(a[4]) == np.sign(b[4]))
    assert all(len(s) == 1 for s in signs.values())


def run(df, **more):
    return [tuple(r) for r in W.whiten(df, **more).collect()]


def test_against_numpy_with_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(0, 1, (300, 20)) @ np.diag(np.linspace(2, 0.3, 20))
    rows = [(i, [float(c) for c in v.astype(np.float32)]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # a third are copies, and count once in the fit
    rows += [(5, rows[5][1]), (None, rows[6][1]), (2000, None), (2001, [1.0, None] * 10), (2002, [float("nan")] * 20), (2003, [float("inf")] * 20)]
    df = spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], KIND).repartition(7)
    got = run(df)
    same(got, brute(rows))
    assert {r[2] for r in got} == {300} and max(r[6] for r in got) < 1e-9


def test_on_the_given_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in df.collect()]
    same([tuple(r) for r in W.op11_whitening(spark, SF).collect()], brute(rows))


def test_many_blocks_and_column_blocks(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_ROWS", 8)
    monkeypatch.setattr(W, "BLOCK_COLUMNS", 5)
    monkeypatch.setattr(W, "SPLIT_BLOCKS", 3)
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in v.astype(np.float32)]) for i, v in enumerate(rng.normal(0, 1, (101, 13)) * np.arange(1, 14))]
    same(run(spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], KIND).repartition(4)), brute(rows))


def test_without_variance_other_lengths_and_large_entries(spark):
    kind = "vec_id bigint, embedding array<double>"
    one = run(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], kind))
    assert sorted(one) == [(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]
    line = run(spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, []), (4, [7.0])], kind))
    assert sorted((r[0], r[1], r[2], r[3], r[4] and abs(round(r[4], 9)), r[5]) for r in line) == [
        (1, 1, 2, 64**2, 1.0, 1.0), (1, 2, 2, 64**2, None, 0.0), (2, 1, 2, 64**2, 1.0, 1.0), (2, 2, 2, 64**2, None, 0.0), (4, 1, 1, 0, None, None),
    ]
    huge = run(spark.createDataFrame([(1, [1e300]), (2, [-1e300]), (3, [0.0])], kind))
    assert {r[3] for r in huge if r[0] != 3} == {2**63 - 1} and all(math.isfinite(r[4]) for r in huge)


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty(spark, rows):
    assert run(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")) == []
