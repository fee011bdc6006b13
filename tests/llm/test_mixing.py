import pytest
from pyspark.sql import functions as F

from shelfcast.llm import mixing as M

from .conftest import DOC, words


def brute_targets(sizes, share=M.SHARE, most=M.MOST_EPOCHS):
    """Shares by weight; what is above a cap is shared again among the others."""
    order = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, free, rest = {}, set(sizes), share * sum(sizes.values())
    while free:
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            target.update({s: level * weight[s] for s in free})
            break
        for s in over:
            target[s] = most * sizes[s]
            rest -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("digits", [1, 2])
def test_targets_and_exact_budgets(spark, docs, digits, monkeypatch):
    monkeypatch.setattr(M, "_slice_digits", lambda df: digits)
    rows = M.mix(docs.withColumn("source", F.when(F.col("source") != "src3", F.col("source")))).collect()
    sizes = {}
    for r in rows:
        assert r["size"] == len(words(r["text"]))
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    targets = brute_targets(sizes)
    assert len(rows) == docs.count()
    for source, target in targets.items():
        own = [r for r in rows if r["source"] == source]
        assert own[0]["target"] == pytest.approx(target) and own[0]["source_size"] == sizes[source]
        assert sum(r["taken"] for r in own) == int(own[0]["target"])
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in own)


def test_slices_do_not_change_the_mix(docs, monkeypatch):
    taken = []
    for digits in (1, 3):
        monkeypatch.setattr(M, "_slice_digits", lambda df, d=digits: d)
        taken.append({r["doc_id"]: r["taken"] for r in M.mix(docs).collect()})
    assert taken[0] == taken[1]


def test_materialised_rows_hold_the_taken_words(docs):
    mixed = M.mix(docs)
    copies = M.materialise(mixed)
    assert copies.columns == docs.columns
    by_doc = {r["doc_id"]: r["n"] for r in copies.groupBy("doc_id").agg(F.sum(M.word_count(F.col("text"))).alias("n")).collect()}
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert by_doc == {r["doc_id"]: r["taken"] for r in mixed.collect() if r["taken"]}
    assert all(whole[r["doc_id"]].startswith(r["text"]) for r in copies.collect())


def test_odd_rows(odd_docs, no_docs):
    rows = M.mix(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["taken"] == 0 for r in rows if not words(r["text"]))
    for source in ("a", "b", None):
        own = [r for r in rows if r["source"] == source]
        assert sum(r["taken"] for r in own) == int(own[0]["target"])
    assert "weight" in M.mix(odd_docs).columns
    assert M.mix(no_docs).collect() == [] and M.materialise(M.mix(no_docs)).collect() == []


def test_one_source_is_capped(rows):
    only = rows([(1, "a b c", "en", "s", 5), (2, "d", "en", "s", 1)], DOC)
    got = {r["doc_id"]: r for r in M.mix(only).collect()}
    assert got[1]["target"] == 6.0 and got[1]["taken"] + got[2]["taken"] == 6


def test_a_hot_source_is_cut_into_slices(spark):
    rows = spark.range(6_000).selectExpr("id AS doc_id", "'a b' AS text", "if(id % 3 < 2, 'hot', concat('s', id % 7)) AS source")
    mixed = M.mix(rows)
    plan = mixed._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    hot = mixed.filter("source = 'hot'")
    assert hot.agg(F.sum("taken")).first()[0] == int(hot.first()["target"])


def test_reruns_agree_for_repeated_and_null_ids(spark):
    """A third of the rows under one id and a third without, in ten orders."""
    rows = [(i if i % 3 == 0 else 7 if i % 3 == 1 else None, " ".join(["w"] * (1 + i % 5) + [str(i % 40)]), "en", "s" if i % 2 else None, i) for i in range(300)]
    mixes = set()
    for seed in range(10):
        df = spark.createDataFrame(rows, DOC).orderBy(F.rand(seed)).repartition(1 + seed)
        mixes.add(tuple(sorted((tuple(r) for r in M.materialise(M.mix(df)).collect()), key=str)))
    assert len(mixes) == 1


def test_rows_of_one_id_spread_over_slices(spark, monkeypatch):
    monkeypatch.setattr(M, "_slice_digits", lambda df: 2)
    rows = spark.range(4_000).selectExpr("if(id % 3 = 0, 7, id) AS doc_id", "concat('text ', id) AS text", "'s' AS source")
    plan = M.mix(rows)._jdf.queryExecution().optimizedPlan().toString()
    digest = F.substring(F.md5(F.concat(F.lit("7 "), F.md5(F.col("text").cast("binary"))).cast("binary")), 1, 2)
    assert rows.filter("doc_id = 7").groupBy(digest).count().agg(F.max("count")).first()[0] < 30 and "mix_key" in plan


def test_texts_move_once(docs, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        mixed = M.mix(docs)
        mixed.collect()
        lines = mixed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [below for line, below in zip(lines, lines[1:]) if "Exchange hashpartitioning" in line]
    assert sum(", text#" in below for below in moved) == 1 and len(moved) > 3
