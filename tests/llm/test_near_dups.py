import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import near_dups as N
from shelfcast.llm.components import components

from .conftest import DOC, words


def brute(rows, width, percent=80):
    sets = {}
    for i, text in rows:
        w = words(text, lower=True)
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * min(len(sets[a]), len(sets[b])) >= percent * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("width", [2, 5])
def test_components_of_the_table(docs, width):
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in N.groups(docs, width=width).collect()}
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()], width)


def test_a_large_group_of_variants(spark, monkeypatch):
    """Copies with a few or many changed words: chains, near misses, and blocks smaller than buckets."""
    monkeypatch.setattr(N, "BLOCK", 16)
    rng = random.Random(5)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(240):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 7, 10, 14])):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(copy), "en", "s", 0))
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in N.groups(spark.createDataFrame(rows, DOC), width=2).collect()}
    assert got == brute([r[:2] for r in rows], 2)


def test_exact_copies_of_a_third_of_all_rows(spark):
    df = spark.range(900).selectExpr("id AS doc_id", "if(id % 3 = 0, 'the very same words again', concat('own ', id, ' text ', id * 7)) AS text")
    got = {r["id"]: r["component_id"] for r in N.groups(df, width=2).collect()}
    assert all(got[i] == (0 if i % 3 == 0 else i) for i in range(900))


def test_small_tables_are_few_files_whatever_the_number_of_partitions(spark, tmp_path, monkeypatch):
    """Each file costs an executor processes and open buffers; few rows are not as many files as partitions."""
    conf = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    conf |= {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    there = {p.name for p in shared.glob("*")}
    before = {k: spark.conf.get(k) for k in conf}
    monkeypatch.setattr(N, "BLOCK", 16)
    rng = random.Random(8)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(200):
        copy = list(base) if i % 2 else [f"own{i}" for _ in range(3)] + [f"y{i}x{k}" for k in range(9)]
        for _ in range(rng.choice([0, 1, 2, 7, 14])):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(copy), "en", "s", 0))
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        found = N.groups(spark.createDataFrame(rows, DOC).coalesce(2), width=2)
        found.write.parquet(str(tmp_path / "result"))
        got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == brute([r[:2] for r in rows], 2)
    tables = [p for p in [*shared.iterdir(), tmp_path / "result"] if p.name not in there]
    files = {p.name: len(list(p.glob("part-*"))) for p in tables}
    assert len(files) > 8 and max(files.values()) <= spark.sparkContext.defaultParallelism, files


def test_odd_rows(odd_docs, no_docs):
    rows = N.groups(odd_docs, width=2).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["id"], set()).add((r["n_shingles"], r["component_id"]))
    assert by[1] == {(0, 1)} and by[2] == {(0, 2)} and by[3] == {(0, 3)} and by[5] == {(1, 5)}
    assert by[7] == by[8] == {(4, 7)}
    assert by[None] == {(3, None)}
    assert N.groups(no_docs).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)] + [(7, 530), (3, 3)]
    rng = random.Random(1)
    links = [p if rng.random() < 0.5 else p[::-1] for p in chain + star]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in [7, *range(500, 560)]}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_block_pairs_are_all_that_sketches_allow(seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    base = rng.integers(-(2**63), 2**63, 16)
    sketch = np.array([base ^ np.where(rng.random(16) < 0.5, np.int64(1) << rng.integers(0, 64, 16), 0) for _ in range(40)])
    one = {"n": np.full(40, 9), "root": np.arange(40), "keys": np.full((40, N.BANDS), 5), "sketch": sketch.view(np.uint64)}
    one["parity"] = [N.parity_bits(np.arange(9, dtype=np.uint64))] * 40
    i, j = N._block_pairs(one, one, True, 5, 80)
    assert len(i) == 40 * 39 // 2  # at most 32 bits differ in any pair


def test_parity_bitmaps_never_exceed_the_difference():
    import numpy as np

    rng = np.random.default_rng(4)
    sets = []
    for n in (1, 7, 60, 64, 65, 500, 3_000):
        base = rng.integers(0, 2**63, n).astype(np.uint64)
        for share in (1.0, 0.9, 0.8, 0.5):
            kept = base[: max(1, int(n * share))]
            sets.append(np.unique(np.concatenate((kept, rng.integers(0, 2**63, n - len(kept)).astype(np.uint64)))))
    pairs = [(a, b) for a in sets for b in sets]
    true = np.array([len(np.setxor1d(a, b)) for a, b in pairs])
    found = N._differences([N.parity_bits(a) for a, _ in pairs], [N.parity_bits(b) for _, b in pairs])
    assert (found <= true).all()
    alike = np.array([0.8 <= len(a) / len(b) <= 1.25 for a, b in pairs])
    assert (found >= 0.6 * true)[alike].all()


def test_sketches_estimate_similarity():
    import numpy as np

    rng = np.random.default_rng(3)
    for share, low, high in ((1.0, 0, 0), (0.8, 70, 160), (0.3, 230, 600)):
        both = rng.integers(0, 2**63, int(1_000 * share)).astype(np.uint64)
        n = 1_000 - len(both)
        sides = [np.concatenate((both, rng.integers(0, 2**63, n // 2).astype(np.uint64))) for _ in range(2)]
        a, b = (N.odd_sketch(N.minhashes(s)) for s in sides)
        assert low <= np.bitwise_count((a ^ b).view(np.uint64)).sum() <= high


def test_repeated_ids_with_different_texts_in_ten_orders(spark):
    """Texts are the nodes: each text of an id keeps its own links, whatever the order of the rows."""
    rng = random.Random(7)
    base = [" ".join(f"b{k}w{rng.randrange(500)}" for _ in range(60)) for k in range(6)]
    rows = [(i % 5, f"{base[i % 6]} tail{i}", "en", "s", i) for i in range(30)] + [(3, base[0], "en", "s", 0), (3, base[0], "en", "s", 0)]
    want = {}
    by_text = brute([((i, t), t) for i, t, *_ in rows], 2)  # nodes named by (id, text)
    for key, (n, root) in by_text.items():
        want.setdefault(root, set()).add(key)
    smallest = {key: (by_text[key][0], min(i for i, _ in want[root])) for root, keys in want.items() for key in keys}
    for seed in range(10):
        df = spark.createDataFrame(rows, DOC).orderBy(F.rand(seed)).repartition(1 + seed % 4)
        found = N.groups(df, width=2)
        texts = {h: t for h, t in df.select(F.xxhash64("text"), "text").distinct().collect()}
        got = {(r["id"], texts[r["digest"]]): (r["n_shingles"], r["component_id"]) for r in found.collect()}
        assert got == smallest


def test_recall_on_a_larger_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in N.groups(docs, width=2).collect()}
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()], 2)
