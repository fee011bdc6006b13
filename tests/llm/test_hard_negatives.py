import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import hard_negatives as H

KIND = "vec_id bigint, label int, embedding array<float>, id int, score int, key string, angles int, norm int"


def brute(rows, asked, k=5, low=80, high=100):
    """Result rows by plain Python over all pairs."""
    ints = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            ints.setdefault(i, set()).add((label, tuple(math.floor(256 * float(np.float32(c))) for c in v)))
    everything = [(i, label, v) for i, some in ints.items() for label, v in some]
    out = set()
    for a in asked:
        if a not in ints:
            continue
        label, x = min(ints[a])
        scored = sorted((-sum(p * q for p, q in zip(x, v, strict=True)), i, other) for i, other, v in everything if i != a and len(v) == len(x))
        for minus, positive in [(s, i) for s, i, other in scored if other == label][:k]:
            fits = [(-s, i) for s, i, other in scored if other != label and low * -minus <= 100 * -s <= high * -minus]
            out |= {(a, positive, r + 1, i, -minus, s) for r, (s, i) in enumerate(fits[:k])}
    return out


def found(df, asked, **more):
    got = [tuple(r) for r in H.mine(df, F.col("id").isin(asked), **more).collect()]
    assert len(got) == len(set(got))
    return set(got)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "k", 3, 4) for r in rows], KIND)


def clustered(seed, n=500, d=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (6, d))
    place = rng.integers(0, 6, n)
    x = centres[place] + rng.normal(0, 0.4, (n, d))
    return [(i, int(p if rng.random() < 0.8 else rng.integers(0, 6)), [float(c) for c in v.astype(np.float32)]) for i, (p, v) in enumerate(zip(place, x, strict=True))]


@pytest.mark.parametrize("block", [8_192, 20])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(H, "WINDOW", 8)
    monkeypatch.setattr(H, "KEEP", 50)
    rows, asked = clustered(0), list(range(0, 500, 10))
    got = found(table(spark, rows).repartition(5), asked, anchor_block=block)
    assert got == brute(rows, asked) and len(got) > 500


def test_copies_ties_and_unusable_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, i % 3, [float(c) for c in rng.integers(-2, 3, 4)]) for i in range(150)]
    rows += [(200 + i, i % 2, [1.0, 0.5, 0.25, 1.0]) for i in range(80)]  # a third are copies, in two labels
    rows += [(400, None, [1.0] * 4), (401, 1, None), (402, 1, [1.0, None, 1.0, 1.0]), (403, 1, [float("nan")] * 4), (404, 1, [float("inf")] * 4), (None, 1, [1.0] * 4)]
    rows += [(410, 1, [1.0, 2.0]), (411, 1, [1.0, 1.0]), (412, 2, [1.0, 1.5]), (420, 1, []), (421, 2, []), (422, 1, []), (430, 0, [0.0] * 4)]
    rows += [(10, 2, [2.0] * 4), (20, *rows[20][1:])]
    asked = [*range(0, 150, 10), 200, 201, 400, 401, 402, 410, 420, 430]
    assert found(table(spark, rows), asked) == brute(rows, asked)


def test_text_labels_and_other_limits(spark):
    rows = clustered(2, n=150)
    df = table(spark, rows).withColumn("label", F.concat(F.lit("c"), "label"))
    assert found(df, [0, 50], positives=3, negatives=3, low=10, high=60) == brute(rows, [0, 50], k=3, low=10, high=60)


def test_scores_beyond_64_bits(spark):
    rows = [(0, 1, [3e30, 1.0]), (1, 1, [2e30, 2.0]), (2, 2, [2e30, 1.0]), (3, 2, [1.0, 1.0]), (4, 2, [-2e30, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    top = 2**63 - 1
    assert found(df, [0]) == {(0, 1, 1, 2, top, top), (0, 1, 2, 3, top, top)}


def test_bounds_hold_and_windows_are_left_out():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 300, (5, 16))
    x = np.floor(np.repeat(centres, 64, axis=0) + rng.normal(0, 20, (320, 16)))
    directions = H.directions_of(x[::7].tolist())[16]
    a, norm = H.angles(x, directions), np.sqrt((x * x).sum(axis=1))
    starts = np.arange(0, 320, 64)
    low, high = np.minimum.reduceat(a, starts), np.maximum.reduceat(a, starts)
    least, most = H.score_bounds(a, norm, low, high, np.minimum.reduceat(norm, starts), np.maximum.reduceat(norm, starts))
    scores = (x @ x.T).reshape(320, 5, 64)
    assert (scores.max(axis=2) <= most).all() and (scores.min(axis=2) >= least).all()
    own = scores.max(axis=2).max(axis=1) * 0.8
    assert (most >= own[:, None]).mean() < 0.5


@pytest.mark.parametrize("rows", [[], [(1, 1, None)], [(1, 1, [1.0])]])
def test_empty(spark, rows):
    assert found(spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>"), [1]) == set()


def test_copies_with_large_ids_are_anchors(spark):
    """Only the six smallest of equal rows can be among the best, but each of them is asked for."""
    rows = [(i, 1, [1.0, 0.5]) for i in range(40)] + [(100 + i, 2, [0.95, 0.5]) for i in range(10)]
    got, asked = found(table(spark, rows), [0, 30, 39, 109]), [0, 30, 39, 109]
    assert got == brute(rows, asked) and {r[0] for r in got} >= {0, 30, 39}
