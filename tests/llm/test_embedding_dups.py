import math

import numpy as np
import pytest

from shelfcast.llm import embedding_dups as E

from .conftest import SF

KIND = "vec_id bigint, embedding array<float>, key string, size int, links int, root int, id int"


def brute(rows, threshold=0.9):
    """(id, n_links, component_id, kept) of each row, by all pairs."""
    def good(v):
        return v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)

    unit = [None if not good(v) else np.array(v, float) / np.linalg.norm(np.array(v, float)) for _, v in rows]
    n = len(rows)
    near = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold - 1e-13] for i in range(n)]
    part = [None] * n
    for i in range(n):
        if part[i] is None:
            part[i], todo = i, [i]
            while todo:
                for j in near[todo.pop()]:
                    if part[j] is None:
                        part[j] = i
                        todo.append(j)
    ids = {p: min((rows[i][0] for i in range(n) if part[i] == p and rows[i][0] is not None), default=None) for p in set(part)}
    return sorted([(rows[i][0], len(near[i]), ids[part[i]], rows[i][0] == ids[part[i]]) for i in range(n)], key=str)


def found(df):
    return sorted([tuple(r) for r in E.near_duplicates(df).select("id", "n_links", "component_id", "kept").collect()], key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, 3, 4) for r in rows], KIND)


def vectors(seed, n=260, d=24):
    """Random directions, chains of neighbours, and a group of near copies with a third of the rows."""
    rng = np.random.default_rng(seed)
    base = rng.normal(0, 1, (n, d)) * np.linspace(2, 0.4, d)
    base[: n // 3] = base[0] + rng.normal(0, 0.05, (n // 3, d))
    for i in range(n // 3, n // 2):  # chains: each near the one before
        base[i] = base[i - 1] + rng.normal(0, 0.25, d) * np.linspace(2, 0.4, d)
    return [(i, [float(c) for c in v.astype(np.float32)]) for i, v in enumerate(base[rng.permutation(n)])]


@pytest.mark.parametrize("block", [16_384, 30])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)
    monkeypatch.setattr(E, "TILE", 16)
    monkeypatch.setattr(E, "STEPS", (4, 9))
    rows = vectors(0)
    assert found(table(spark, rows).repartition(6)) == brute(rows)


def test_copies_scaled_copies_unusable_and_repeated_rows(spark):
    rows = vectors(1, n=60)
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(2000, [2 * c for c in rows[3][1]])]
    rows += [(5, rows[5][1]), (7, rows[9][1]), (None, rows[4][1]), (None, None), (None, rows[8][1])]
    rows += [(3000, None), (3001, [0.0] * 24), (3002, [1.0, None] * 12), (3003, [float("nan")] * 24), (3004, [float("inf")] * 24), (3005, [])]
    rows += [(3006, [1.0, 2.0]), (3007, [2.0, 4.0]), (3008, [-1.0, -2.0]), (3009, [-0.0, 1.0]), (3010, [0.0, 1.0])]
    assert found(table(spark, rows)) == brute(rows)


def test_cosines_at_the_threshold(spark):
    exact = [(0, [1.0, 0.0, 0.0, 0.0]), (1, [9.0, 3.0, 3.0, 1.0]), (2, [8.999, 3.0, 3.0, 1.0]), (3, [0.0, 0.0, 0.0, -1.0])]
    df = spark.createDataFrame(exact, "vec_id bigint, embedding array<double>")
    got = {r["id"]: r["n_links"] for r in E.near_duplicates(df).collect()}
    assert got == {0: 1, 1: 2, 2: 1, 3: 0}  # 0-1 is 0.9, 0-2 is just below


def test_extreme_lengths(spark):
    rows = [(0, [1e300, 1e300]), (1, [1e-300, 1e-300]), (2, [1e300, -1e300])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert found(df) == [(0, 1, 0, True), (1, 1, 0, False), (2, 0, 2, True)]


def test_most_pairs_stop_early():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (600, 64)) / np.arange(1, 65)
    _, axes = np.linalg.eigh(x.T @ x)
    tiles = E.compare(x, axes[:, ::-1], None, np.ones(600), 0.9)[2]
    assert tiles.steps[1] < 0.05 * tiles.steps[0]


def test_far_groups_never_meet():
    group = lambda at, g: {"size": 2, "group": g, "n": 10, "rest": 0.1, "low": [at - 0.05] + [0] * 7, "high": [at + 0.05] + [0] * 7}
    partners = [m[4] for m in E._meetings([group(0.95, 0), group(-0.95, 1), group(0.9, 2)], 0.9)]
    assert partners == [[(0, 1), (2, 1)], [(1, 1)], [(0, 1), (2, 1)]]


def test_the_given_table_has_its_links(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = E.op12_embedding_dups(spark, SF).select("vec_id", "n_links", "component_id", "kept")
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty(spark, rows):
    assert found(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")) == [(i, 0, i, True) for i, _ in rows]
