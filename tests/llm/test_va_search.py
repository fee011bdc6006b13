import math

import numpy as np
import pytest

from shelfcast.llm import va_search as V

KIND = "vec_id bigint, embedding array<float>"


def brute(rows, asked, k):
    ints = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints[i] = [math.floor(256 * float(np.float32(x))) for x in v]
    out = set()
    for q in asked:
        if q in ints:
            scores = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q and len(v) == len(ints[q]))
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


def found(df, queries, k, **more):
    return {tuple(r) for r in V.top_k(df, queries, k, **more).select("query_id", "rank", "vec_id", "score").collect()}


@pytest.mark.parametrize("block", [8_192, 40])
def test_exact_on_random_vectors(spark, block):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 16).astype(np.float32)]) for i in range(400)]
    df = spark.createDataFrame(rows, KIND).repartition(5)
    got = found(df, df.filter("vec_id % 10 = 0"), 5, query_block=block)
    assert got == brute(rows, range(0, 400, 10), 5)


def test_ties_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(1)
    same = [float(x) for x in rng.normal(0, 1, 4).astype(np.float32)]
    rows = [(i, same if i % 3 else [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(120)]
    rows += [(200, None), (201, [1.0, None, 2.0, 3.0]), (202, [float("nan")] * 4), (203, [float("inf")] * 4), (None, same)]
    rows += [(210, [1.0, 2.0]), (220, [3.0, -1.0]), (230, []), (240, []), (250, [1.0])]
    df = spark.createDataFrame(rows, KIND)
    asked = [i for i, _ in rows if i is not None and i % 10 == 0]
    assert found(df, df.filter("vec_id % 10 = 0"), 5) == brute(rows, asked, 5)


def test_large_values_and_repeated_rows(spark):
    rows = [(0, [3e30, 1.0]), (1, [-3e30, 2.0]), (2, [2.0**40, 1.0]), (3, [1.0, 1.0])]
    df = spark.createDataFrame(rows, KIND)
    got = found(df.union(df), df.union(df), 3)
    top = 2**63 - 1
    assert {(q, v): s for q, _, v, s in got}[(0, 1)] == -top - 1
    assert {(q, v): s for q, _, v, s in got}[(2, 3)] == 2**48 * 256 + 256 * 256
    assert len(got) == 12


def test_empty(spark):
    df = spark.createDataFrame([], KIND)
    assert found(df, df, 5) == set()
