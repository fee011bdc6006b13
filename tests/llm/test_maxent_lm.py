import collections
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import maxent_lm as M
from shelfcast.llm.tables import written

from .conftest import words

END = object()


def tokens(text):
    return [*words(text, lower=True), END]


def check_base(rows, training):
    counts = collections.Counter(t for text in training for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        own = tokens(r["text"])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(counts[t] > 0 for t in own), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own))


def run(docs, training):
    counts = written(M.word_counts(training), "counts")
    model = M.fit(training, counts)
    return model, M.score(docs, model, counts, ["doc_id", "text"]).collect()


@pytest.mark.parametrize("known", [M.KNOWN, 50])
def test_counts_and_base(docs, known, monkeypatch):
    monkeypatch.setattr(M, "KNOWN", known)
    training = docs.filter("doc_id % 5 <> 0")
    _, rows = run(docs, training)
    assert len(rows) == docs.count()
    check_base(rows, [r["text"] for r in training.collect()])
    held_out = [r for r in rows if r["doc_id"] % 5 == 0]
    assert sum(r["score"] for r in held_out) > sum(r["base_score"] for r in held_out)


def test_probabilities_add_up(docs):
    """After any words, the class factors add up to 1, and so do the words of each class with its unseen share."""
    counts = written(M.word_counts(docs), "counts")
    model = M.fit(docs, counts)
    table = counts.toArrow()
    hashes, buckets, c = table["h"].to_numpy().view(np.uint64), table["bucket"].to_numpy(), table["c"].to_numpy()
    classes = model.codes.classes[model.codes.of(hashes, buckets.copy())]
    within = np.bincount(classes, (c + 1) / model.mass[classes], minlength=M.CLASSES) + (np.arange(M.CLASSES) > M.HEAD) / model.mass
    assert np.allclose(within[model.mass > 1], 1)
    rows = np.random.default_rng(0).integers(0, M.ROWS, (4, 50)).astype(np.uint16)
    assert np.allclose(M._softmax(model.weights, model.bias, rows).sum(axis=1), 1, atol=1e-5)


def test_score_equals_a_word_by_word_sum(docs):
    model, rows = run(docs, docs)
    counts = collections.Counter(t for r in docs.collect() for t in tokens(r["text"]))
    for r in rows[:10]:
        own, total = tokens(r["text"]), 0.0
        for _, hashes, buckets, bounds in M.tokens(pa.array([r["text"]])):
            codes = model.codes.of(hashes, buckets)
            weights = M.features(codes, bounds, model.codes.start)
            for i, token in enumerate(own):
                logits = model.bias + model.weights[weights[:, i]].sum(axis=0)
                p = np.exp(logits) / np.exp(logits).sum()
                k = model.codes.classes[codes[i]]
                total += math.log10(p[k] * (counts[token] + 1) / model.mass[k])
        assert r["score"] == pytest.approx(total, rel=1e-4)


def test_context_matters():
    """A word that follows another one is likelier after it."""
    texts = pa.array(["alpha beta gamma delta " * 40, "delta gamma " * 60] * 900)
    stream = np.concatenate([h for _, h, _, _ in M.tokens(texts)])
    head = np.unique(stream[stream != M.END])
    codes = M.Codes(head, np.concatenate((np.arange(len(head)), [M.HEAD, 0], np.full(M.BUCKETS, M.HEAD + 1))))
    learner = M.Learner(np.zeros((M.ROWS, M.CLASSES), np.float32), np.zeros(M.CLASSES, np.float32))
    learner.learn(texts, codes)
    (_, hashes, buckets, bounds), *_ = M.tokens(pa.array(["alpha beta gamma"]))
    code = codes.of(hashes, buckets)
    p = M._softmax(learner.weights, learner.bias, M.features(code, bounds, codes.start))
    assert p[1, codes.classes[code[1]]] > 0.8 and p[2, codes.classes[code[2]]] > 0.6


def test_odd_rows(odd_docs, no_docs, docs):
    counts = written(M.word_counts(odd_docs), "counts")
    model = M.fit(odd_docs, counts)
    rows = M.score(odd_docs, model, counts, ["doc_id", "text", "score"][:2]).collect()
    assert len(rows) == odd_docs.count()
    check_base(rows, [r["text"] for r in odd_docs.collect()])
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    nothing = written(M.word_counts(no_docs), "counts")
    blank = M.fit(no_docs, nothing)
    assert M.score(no_docs, blank, nothing, ["doc_id"]).collect() == []
    alone = M.score(docs, blank, nothing, ["doc_id"]).agg(F.min("base_score"), F.max("n_known"), F.max("train_tokens")).first()
    assert tuple(alone) == (0.0, 0, 0)


def test_words_of_one_class_are_told_apart_by_the_words_before(spark, tmp_path):
    """Equally frequent words with equal last bytes are likelier after the word that they follow in training."""
    rng = np.random.default_rng(5)
    rare = [(f"first{a}{b}ing", f"then{a}{b}ing") for a in "abcdef" for b in "abcdef"]
    texts = [" ".join(w for k in rng.permutation(len(rare)) for w in (*rare[k], *(f"often{j}" for j in rng.integers(0, 20, 2)))) for _ in range(800)]
    swapped = list(zip([a for a, _ in rare], [b for _, b in rare[1:] + rare[:1]], strict=True))
    rows = [(7 * i + 1, t) for i, t in enumerate(texts)]
    rows += [(-1, " often1 ".join(" ".join(p) for p in rare)), (-2, " often1 ".join(" ".join(p) for p in swapped))]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    by = {r["doc_id"]: r for r in M.op6_maxent_lm(spark, str(tmp_path)).collect()}
    assert by[-1]["base_score"] == pytest.approx(by[-2]["base_score"])
    assert by[-1]["score"] > by[-2]["score"] + len(rare) / 2


def test_the_second_factor_adds_up(docs):
    """After any words, the words of a class and its unseen share add up to 1; without weights it is the closed form."""
    counts = written(M.word_counts(docs), "counts")
    model = M.fit(docs, counts)
    within = M.fit_within(docs, model, counts)
    table = counts.toArrow()
    hashes, buckets, c = table["h"].to_numpy().view(np.uint64), table["bucket"].to_numpy(), table["c"].to_numpy()
    classes = model.codes.classes[model.codes.of(hashes, buckets.copy())]
    keys = np.repeat(np.random.default_rng(0).integers(0, 1 << 60, (4, 1)).astype(np.uint64), len(hashes), axis=1)
    for w, changes in ((within, True), (within._replace(weights=np.zeros_like(within.weights)), False)):
        ratio = w.log10(hashes, classes, keys, model.mass)
        total = np.bincount(classes, 10**ratio * (c + 1) / model.mass[classes], minlength=M.CLASSES) + (np.arange(M.CLASSES) > M.HEAD) / model.mass
        assert np.allclose(total[model.mass > 1], 1, atol=1e-4)
        assert (np.abs(ratio).max() > 1e-3) == changes


def test_scores_do_not_depend_on_the_tasks(docs, monkeypatch):
    """The same documents in one, few or many tasks train the same model."""
    scores = []
    for parts, room in ((1, M.TASK_TOKENS), (7, 5_000), (23, 1)):
        monkeypatch.setattr(M, "TASK_TOKENS", room)
        given = written(docs.repartition(parts), "dealt")
        counts = written(M.word_counts(given), "counts")
        model = M.fit(given, counts)
        rows = M.score(given, model, counts, ["doc_id"], within=M.fit_within(given, model, counts)).collect()
        scores.append({r["doc_id"]: r["score"] for r in rows})
    for other in scores[1:]:
        assert other == pytest.approx(scores[0], rel=1e-3)


def test_the_trained_score_equals_a_word_by_word_sum(docs):
    """Both trained factors, one word at a time and with plain softmaxes over each word's digits."""
    counts = written(M.word_counts(docs), "counts")
    model = M.fit(docs, counts)
    within = M.fit_within(docs, model, counts)
    rows = M.score(docs, model, counts, ["doc_id", "text"], within=within).collect()
    known = collections.Counter(t for r in docs.collect() for t in tokens(r["text"]))
    for r in rows[:8]:
        own, total = tokens(r["text"]), 0.0
        for _, hashes, buckets, bounds in M.tokens(pa.array([r["text"]])):
            codes = model.codes.of(hashes, buckets)
            weights, keys = M.features(codes, bounds, model.codes.start), M.contexts(hashes, bounds)
            for i, token in enumerate(own):
                logits = (model.bias + model.weights[weights[:, i]].sum(axis=0)).astype(float)
                k = model.codes.classes[codes[i]]
                total += math.log10(np.exp(logits[k]) / np.exp(logits).sum())
                if k <= M.HEAD:
                    total += math.log10((known[token] + 1) / model.mass[k])
                    continue
                nodes, taken, cell = within.places(hashes[i : i + 1], np.array([k - M.HEAD - 1]))
                for node, digit, at in zip(nodes[:, 0], taken[:, 0], within.rows(keys[:, i : i + 1], nodes).T, strict=True):
                    logits = (within.offsets[node] + within.weights[at].sum(axis=0)).astype(float)
                    total += math.log10(np.exp(logits[digit]) / np.exp(logits).sum())
                total += math.log10((known[token] + 1) / within.cells[cell[0]] * (model.mass[k] - 1) / model.mass[k])
        assert r["score"] == pytest.approx(total, rel=1e-4)


def test_probabilities_beyond_single_precision():
    """Logits whose exponentials overflow or vanish give the same probabilities as exact ones."""
    weights = np.array([[0, 300, -300, 5], [-400, -390, -500, -395], [0, 0, 0, 0]], np.float32)
    rows = np.array([[0, 1, 2]])
    exact = weights.astype(float) - weights.max(axis=1, keepdims=True)
    exact = np.exp(exact) / np.exp(exact).sum(axis=1, keepdims=True)
    assert np.allclose(M._softmax(weights, np.zeros(4, np.float32), rows), exact, atol=1e-6)
    assert np.allclose(M._softmax(None, weights[1], rows), exact[[1, 1, 1]], atol=1e-6)


def test_sums_over_runs_and_without_weights(docs, monkeypatch):
    """Rows are summed alike in short and long runs; without weights softmaxes follow the nodes, not the tokens."""
    rng = np.random.default_rng(3)
    values, times = rng.random((50, 16), np.float32), np.array([1, 2, 40, 1, 9, 8, 3])
    places, first = rng.integers(0, 50, times.sum()), np.cumsum(times) - times
    assert np.allclose(M._run_sums(values, places, first, times), np.add.reduceat(values[places], first, axis=0), rtol=1e-5)
    known = np.sort(np.append(M.mix64(np.arange(1, 900)), [np.uint64(0), ~np.uint64(0)]))
    asked = np.concatenate((known, M.mix64(np.arange(5_000)), known - np.uint64(1)))
    assert (M._finder(known)(asked) == np.minimum(np.searchsorted(known, asked), len(known) - 1)).all()

    counts = written(M.word_counts(docs), "counts")
    model = M.fit(docs, counts)
    within = M.fit_within(docs, model, counts)
    within = within._replace(weights=np.zeros_like(within.weights))
    texts = docs.select("text").toArrow()["text"].combine_chunks()
    plain, asked = M._softmax, []
    monkeypatch.setattr(M, "_softmax", lambda weights, bias, rows: (asked.append(rows.size // len(rows)), plain(weights, bias, rows))[1])
    learner, codes = M.WithinLearner(within), model.codes
    learner.learn(texts, codes)
    exact = np.zeros(learner.expected.shape)
    assert sum(asked) <= len(within.offsets)
    for _, hashes, buckets, bounds in M.tokens(texts):
        classes = codes.classes[codes.of(hashes, buckets)]
        here = np.flatnonzero(classes > M.HEAD)
        nodes, _, _ = within.places(hashes[here], classes[here] - M.HEAD - 1)
        for rows in within.rows(M.contexts(hashes, bounds)[:, here], nodes):
            np.add.at(exact, rows, plain(None, within.offsets[nodes.ravel()], rows[None]))
    assert np.allclose(learner.expected, exact, rtol=1e-4, atol=1e-4)
    first_round = M.Learner(np.zeros_like(model.weights), model.bias)
    first_round.learn(texts, codes)
    shares = plain(None, model.bias, np.zeros((1, 1), np.int64))
    assert np.allclose(first_round.expected, first_round.seen.sum(axis=1, keepdims=True) * shares, rtol=1e-5)


def test_a_round_reads_its_documents_once_for_both_factors(docs, monkeypatch):
    """Trained together, the factors are those trained one after the other, from as many rounds as there are parts."""
    counts = written(M.word_counts(docs), "counts")
    model = M.fit(docs, counts)
    within = M.fit_within(docs, model, counts)
    plain, rounds = M._round, []
    monkeypatch.setattr(M, "_round", lambda *given: (rounds.append(len(given[-1])), plain(*given))[1])
    both = M.fit_both(docs, counts)
    assert rounds == [2] * M.ROUNDS
    assert np.allclose(both[0].weights, model.weights, atol=1e-3) and np.allclose(both[1].weights, within.weights, atol=1e-3)
    assert model.weights.any() and within.weights.any()


def test_last_bytes_of_words():
    """Up to three bytes, each plus 1 in nine bits, the last one lowest."""
    texts = ["a", "", "bc def ghij\tk", "é", " xyz\n", "zz"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    starts, ends, _ = M.word_bounds(np.frombuffer(data, np.uint8), offsets)
    exact = [sum((byte + 1) << 9 * k for k, byte in enumerate(data[a:b][::-1][:3])) for a, b in zip(starts, ends, strict=True)]
    assert len(exact) == 8 and M._tails(np.frombuffer(data, np.uint8), starts, ends).tolist() == exact
    assert M._tails(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)).tolist() == []
