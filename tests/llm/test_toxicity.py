import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfcast.llm import toxicity as T

STEMS = ("grumbel", "zankar", "vexor")


def made_up(n, seed, endings):
    """(texts, labels): bad texts hold an inflected stem at a rate of about two in a hundred words."""
    rng = random.Random(seed)
    syllables = "ba do ki lu me na po ri su ta ve wo".split()
    texts, labels = [], []
    for i in range(n):
        word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
        text = [word() for _ in range(rng.randint(60, 300))]
        bad = i % 4 == 0
        for _ in range(max(1, len(text) // 50) if bad else 0):
            text[rng.randrange(len(text))] = rng.choice(STEMS) + rng.choice(endings)
        texts.append(" ".join(text))
        labels.append(int(bad))
    return texts, np.array(labels)


def test_unseen_spellings_are_caught_and_clean_texts_left_alone():
    texts, labels = made_up(2_000, 1, ["a", "en", "os", "ik"])
    windows, y, of = [], [], []
    for k, w in enumerate(T.sample_windows(pa.array(texts))):
        windows, y, of = windows + w, y + [labels[k]] * len(w), of + [k] * len(w)
    model = T.fit_windows(windows, y, of, labels.mean())
    # endings that were seen, and endings that never were
    for seed, endings, least in ((3, ["a", "en", "os", "ik"], 0.95), (2, ["uma", "elt", "ior"], 0.75)):
        fresh, truth = made_up(400, seed, endings)
        predicted = T.score_texts(pa.array(fresh), model) >= T.THRESHOLD
        assert predicted[truth == 1].mean() >= least and predicted[truth == 0].mean() <= 0.02


def test_a_score_is_of_the_worst_window_and_ignores_its_neighbours():
    weights = np.zeros(1 << T.BUCKET_BITS, np.float32)
    marked = np.frombuffer(b" bad ", np.uint8)
    for bucket, valid in T.grams(marked):
        weights[bucket[valid]] = 500
    model = T.Model(weights, -4.0, 0.1)
    clean = "fine " * 500
    got = T.score_texts(pa.array([clean, clean + "bad", "bad " + clean, clean * 9 + "bad " + clean, "BAD", "", None, " \n"]), model)
    assert got[0] < 0.1 and (got[1:5] > 0.5).all() and (got[5:] == 0.1).all()


def test_windows_are_even():
    starts, ends, begin = T.window_bounds(np.array([0, 0, 1, 50, 101, 101, 300]))
    assert (np.diff(begin) == [0, 1, 1, 2, 0, 4]).all()
    assert (ends > starts).all() and (ends - starts).max() <= T.WINDOW
    assert sorted(zip(starts, ends, strict=True))[-1][1] == 300


def test_spark_scores_as_numpy_and_keeps_rows(spark, docs, odd_docs, no_docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = T.fit(docs, labels)
    rows = T.score(docs, model).select("doc_id", "text", "score").collect()
    assert np.allclose([r["score"] for r in rows], T.score_texts(pa.array([r["text"] for r in rows]), model))
    again = T.fit(docs.repartition(7), labels.repartition(3))
    assert np.array_equal(again.weights, model.weights)
    odd = T.score(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert all(r["score"] == model.share for r in odd if not (r["text"] or "").strip())
    assert T.score(no_docs, model).collect() == []


def test_labels_of_one_kind_or_none(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    odd = spark.createDataFrame([(0, None), (1, 7), (None, 1)], "doc_id bigint, toxic int")
    ones = spark.createDataFrame([(0, 1), (1, 1)], "doc_id bigint, toxic int")
    assert T.fit(docs, none) == T.fit(docs, odd) == T.Model(None, 0.0, 0.0)
    model = T.fit(docs, ones)
    assert model.share == 1.0
    assert T.score(docs, model).agg(F.min("score")).first()[0] == 1.0
    conflicting = spark.createDataFrame([(0, 0), (0, 1), (1, 0)], "doc_id bigint, toxic int")
    assert T.fit(docs, conflicting).share == 0.5
