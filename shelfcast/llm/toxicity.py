"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (3 to 6 bytes, with one space on either side), hashed
into BUCKETS embeddings; a word's vector is their mean, a window's vector the mean over its distinct
words, and a linear softmax gives the class. Misspellings and inflections that were never seen
share most n-grams with words that were. The softmax is linear, so for scoring every bucket
collapses to one number, and a text is scored in one pass over its bytes. A text's score is the
highest of its windows, all of them, so one passage in a long text counts as much as in a short one.

Training. The fit sees at most MOST_DOCS labelled documents of each class (by hash of their id)
and WINDOWS_PER_DOC windows of each, evenly spaced; these bounds are parameters. Windows inherit
their document's label at first; then the windows of a positive document that score low beside
its best one are left out. Classes are drawn evenly and the true share of positives, counted over
all labelled rows, is put back into the bias. N-grams of fewer than LEAST_MET windows have no weight.

Defined cases: null, empty and white space texts score the share of positives; labels other than
0 and 1 are ignored, of several labels of a document the highest counts; without examples of
both classes every text scores the share of positives (0 where nothing is labelled).
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType

from shelfcast.llm.tables import bounded_batches, documents, without
from shelfcast.llm.textops import LOWER, SPACE, crc_mod, hash_spans, mix64, release_memory, slices, stream64, word_bounds

BUCKET_BITS = 17
SIZES = (3, 4, 5, 6)
DIMENSIONS = 8
WINDOW = 50
FEWEST = 25  # words that a window counts as at least: few words are weak evidence
MOST_DOCS = 3_000
WINDOWS_PER_DOC = 8
WINDOW_BYTES = 4_000
CALIBRATION = 5  # every fifth of them is kept for the calibration
LEAST_CALIBRATION = 8  # of each class; with fewer the scores stay as trained
LEAST_MET = 4  # windows with an n-gram's bucket; others keep no weight
LEAST_STEPS = 250  # of gradient, in each turn: few windows are seen more often, up to MOST_EPOCHS times
MOST_EPOCHS = 10
HELD_OUT = 2
THRESHOLD = 0.3
_FACTORS = (stream64(max(SIZES), 7) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


class Model(NamedTuple):
    """What scoring needs: a number for each bucket, the bias, and the share of positives."""

    weights: np.ndarray | None
    bias: float
    share: float


def spaced(data, offsets):
    """Lower-cased bytes with one space before each row and at the end, and the rows' bounds in it."""
    rows = len(offsets) - 1
    out = np.full(len(data) + rows + 1, 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(1, rows + 1), np.diff(offsets))] = LOWER[data]
    out[SPACE[out]] = 0x20
    return out, offsets + np.arange(rows + 1)


def grams(stream):
    """For each n-gram size: (bucket, valid) at each position; valid ones have no space inside."""
    space = stream == 0x20
    at = np.arange(len(stream), dtype=np.int32)
    ahead = np.where(space, at, np.int32(len(stream)))
    ahead = np.minimum.accumulate(ahead[::-1])[::-1]  # the first space at or after a position
    wide = stream.astype(np.uint32) + np.uint32(1)
    total = np.zeros(len(stream), np.uint32)
    for n in range(1, max(SIZES) + 1):
        room = len(stream) - n + 1
        if room <= 0:
            return
        total = total[:room] + wide[n - 1 :] * _FACTORS[n - 1]
        if n in SIZES:
            mixed = (total ^ np.uint32((0x9E3779B9 * n) & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0xC2B2AE35)
            yield mixed >> np.uint32(32 - BUCKET_BITS), ahead[1 : room + 1] >= at[:room] + (n - 1)


def word_scores(data, offsets, weights):
    """(mean of the n-gram weights of each word, hash of each word, first word of each row)."""
    stream, bounds = spaced(data, offsets)
    value, count = np.zeros(len(stream)), np.zeros(len(stream), np.int16)
    for bucket, valid in grams(stream):
        value[: len(bucket)] += np.where(valid, weights[bucket], 0)
        count[: len(bucket)] += valid
    starts, ends, first = word_bounds(stream, np.append(bounds[:-1], len(stream)), stream == 0x20)
    if not len(starts):
        return np.zeros(0), np.zeros(0, np.uint64), first
    total, grams_of = np.concatenate(([0.0], np.cumsum(value))), np.concatenate(([0], np.cumsum(count, dtype=np.int64)))
    means = (total[ends - 1] - total[starts - 1]) / (grams_of[ends - 1] - grams_of[starts - 1])
    return means, hash_spans(stream, starts, ends), first


def window_bounds(first, size=WINDOW):
    """(first word, last word + 1) of the windows, and the first window of each row.

    A row's windows are as even as can be, so that only short texts have short windows.
    """
    words = np.diff(first)
    windows = -(-words // size)
    begin = np.concatenate(([0], np.cumsum(windows)))
    within = np.arange(begin[-1]) - np.repeat(begin[:-1], windows)
    words, windows, base = (np.repeat(x, windows) for x in (words, windows, first[:-1]))
    return base + within * words // windows, base + (within + 1) * words // windows, begin


def first_in_window(hashes, starts, ends):
    """Whether a word is the first of its kind in its window."""
    key = hashes ^ mix64(np.repeat(np.arange(1, len(starts) + 1), ends - starts))
    order = np.argsort(key, kind="stable")
    same = np.concatenate(([False], key[order][1:] == key[order][:-1]))
    out = np.empty(len(key), bool)
    out[order] = ~same
    return out


def best_logits(column, model):
    """The logit of each text's highest window; none (nan) without words."""
    out = np.full(len(column), np.nan)
    for at, to, data, offsets in slices(column):
        scores, hashes, first = word_scores(data, offsets, model.weights)
        starts, ends, begin = window_bounds(first)
        if len(starts):
            new = first_in_window(hashes, starts, ends)
            kinds = np.add.reduceat(new, starts, dtype=np.int64)
            logit = np.add.reduceat(scores * new, starts) / np.maximum(kinds, FEWEST) + model.bias
            rows = np.flatnonzero(np.diff(begin))
            out[at + rows] = np.maximum.reduceat(logit, begin[:-1][rows])
    return out


def score_texts(column, model):
    """The scores of an Arrow column of texts."""
    if model.weights is None:
        return np.full(len(column), model.share)
    logits = best_logits(column, model)
    return np.where(np.isnan(logits), model.share, 1 / (1 + np.exp(-np.clip(logits, -60, 60))))


def sample_windows(texts):
    """For each text the bytes of up to WINDOWS_PER_DOC evenly spaced windows."""
    out = [[] for _ in range(len(texts))]
    for at, to, data, offsets in slices(texts):
        starts, ends, first = word_bounds(data, offsets)
        from_word, to_word, begin = window_bounds(first)
        for row in range(to - at):
            n = begin[row + 1] - begin[row]
            for k in sorted({int(n * (2 * i + 1) // (2 * WINDOWS_PER_DOC)) for i in range(WINDOWS_PER_DOC)}) if n else ():
                w, last = from_word[begin[row] + k], to_word[begin[row] + k] - 1
                out[at + row].append(data[starts[w] : min(ends[last], starts[w] + WINDOW_BYTES)].tobytes())
    return out


def _narrow(values):
    """The same numbers in the narrowest unsigned type."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


class _Bags:
    """Windows as a matrix in three layers: n-grams of the distinct words of windows.

    Kept small, as all batches stay in memory: n-grams are numbers into the batch's distinct
    buckets, by word for the forward pass; and words, by bucket, for the backward pass.
    """

    def __init__(self, windows):
        windows = [b" ".join(dict.fromkeys(w.lower().split())) for w in windows]
        data = np.frombuffer(b"".join(windows), np.uint8)
        offsets = np.concatenate(([0], np.cumsum([len(w) for w in windows])))
        stream, bounds = spaced(data, offsets)
        starts, ends, first = word_bounds(stream, np.append(bounds[:-1], len(stream)), stream == 0x20)
        word_at = np.cumsum(np.bincount(starts - 1, minlength=len(stream))) - 1
        found = [(b[v], np.flatnonzero(v)) for b, v in grams(stream)]
        buckets, places = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(places, kind="stable")
        buckets, word = buckets[order], word_at[places[order]]
        self.words = np.searchsorted(word, np.arange(len(starts) + 1)).astype(np.int32)
        self.windows = first.astype(np.int32)
        unique, slots = np.unique(buckets, return_inverse=True)
        order = np.argsort(slots, kind="stable")
        self.buckets, self.slots, self.word_by_bucket = unique.astype(np.int32), _narrow(slots), _narrow(word[order])
        self.begin = np.searchsorted(slots[order], np.arange(len(unique))).astype(np.int32)
        # in how many windows each distinct bucket occurs
        window = np.searchsorted(first, word[order], "right")
        new = np.ones(len(order), bool)
        new[1:] = (window[1:] != window[:-1]) | (slots[order][1:] != slots[order][:-1])
        self.met = np.add.reduceat(new, self.begin, dtype=np.int64)


def _means(values, bounds):
    return np.add.reduceat(values, bounds[:-1], axis=0) / np.diff(bounds)[:, None].astype(np.float32)


def fit_windows(windows, labels, documents_of, share, rounds=(2, 3, 4)):
    """Trains on the windows, again from the start after each clearing of the positive ones.

    A positive document's windows mostly lack what made it positive. Those that the last model
    rates under half of the document's best, or under the top twentieth of the negative windows,
    are left out of the next one.
    """
    labels, documents_of = np.asarray(labels), np.asarray(documents_of)
    use, column = np.arange(len(windows)), pa.array(windows, pa.large_binary())
    for turn, epochs in enumerate(rounds):
        if turn:
            scores = score_texts(column, model)  # noqa: F821
            best = np.zeros(documents_of.max() + 1)
            np.maximum.at(best, documents_of, scores)
            least = np.maximum(0.5 * best[documents_of], np.quantile(scores[labels == 0], 0.95))
            kept = np.flatnonzero((labels == 0) | (scores >= least))
            use = kept if labels[kept].any() else use
        model = _train([windows[i] for i in use], labels[use], share, epochs)
        release_memory()
    return model


def _train(windows, labels, share, epochs, batch=256, rate=0.3, seed=1):
    """Embeddings and softmax, jointly, by Adagrad over shuffled batches."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    out, bias = rng.normal(0, 0.3, (DIMENSIONS, 2)).astype(np.float32), np.zeros(2, np.float32)
    seen = [np.full(1 << BUCKET_BITS, 1e-8, np.float32), np.full_like(out, 1e-8), np.full_like(bias, 1e-8)]
    positive = labels == 1
    weight = np.where(positive, 0.5 / positive.sum(), 0.5 / (~positive).sum()) * len(labels)
    shuffled, parts, met = rng.permutation(len(windows)), [], np.zeros(1 << BUCKET_BITS, np.int64)
    for at in range(0, len(windows), batch):
        rows = shuffled[at : at + batch]
        bag = _Bags([windows[i] for i in rows])
        parts.append((bag, labels[rows], weight[rows]))
        met[bag.buckets] += bag.met
    rare = met < LEAST_MET  # they say more about single documents than about words
    table[rare] = 0
    for _ in range(max(epochs, min(MOST_EPOCHS, -(-LEAST_STEPS // len(parts))))):
        for bag, y, w in parts:
            vectors = table[bag.buckets]
            hidden = _means(_means(vectors[bag.slots], bag.words), bag.windows)
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p *= (w / len(y))[:, None]
            d_out, d_bias, d_hidden = hidden.T @ p, p.sum(axis=0), p @ out.T
            in_window, in_word = (np.diff(b).astype(np.float32) for b in (bag.windows, bag.words))
            d_word = np.repeat(d_hidden / in_window[:, None], np.diff(bag.windows), axis=0)
            step = np.add.reduceat((d_word / in_word[:, None])[bag.word_by_bucket], bag.begin, axis=0)
            step[rare[bag.buckets]] = 0
            past = seen[0][bag.buckets] + (step * step).mean(axis=1)
            seen[0][bag.buckets] = past
            table[bag.buckets] = vectors - (rate * step / np.sqrt(past)[:, None]).astype(np.float32)
            for value, step, past in ((out, d_out, seen[1]), (bias, d_bias, seen[2])):
                past += step * step
                value -= (rate * step / np.sqrt(past)).astype(np.float32)
    share = min(max(share, 1e-6), 1 - 1e-6)  # the classes were weighed evenly
    shift = math.log(share / (1 - share))
    return Model((table @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]) + shift, share)


def fit(docs, labels, id_col="doc_id", text_col="text", label_col="toxic", most_docs=MOST_DOCS):
    """A model from the labelled documents given: all rows of ``labels`` count as training rows."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    known = known.groupBy(id_col).agg(F.max(label_col).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if len(counts) < 2:
        return Model(None, 0.0, share)
    drawn = None
    for y in (0, 1):
        some = known.filter(F.col("y") == y).orderBy(F.xxhash64(id_col), id_col).limit(most_docs)
        drawn = some if drawn is None else drawn.union(some)
    bounded_batches(docs.sparkSession)
    # at most 2 * most_docs ids
    texts = docs.select(id_col, text_col).join(F.broadcast(drawn), id_col).dropDuplicates([id_col])
    cut = F.arrow_udf(lambda t: pa.array(sample_windows(t), pa.list_(pa.binary())), ArrayType(BinaryType()))
    rows = texts.select(id_col, "y", cut(F.col(text_col)).alias("w")).orderBy(F.xxhash64(id_col), id_col).collect()
    windows, y, of = [], [], []
    for k, r in enumerate(rows):
        windows += [bytes(w) for w in r["w"]]
        y += [r["y"]] * len(r["w"])
        of += [k] * len(r["w"])
    if len(set(y)) < 2:
        return Model(None, 0.0, share)
    return fit_windows(windows, y, of, share)


def score(df, model, text_col="text", name="score"):
    """The table with a column ``name``: how likely each whole text is to be labelled 1."""
    bounded_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(texts):
        out = pa.array(score_texts(texts, shared.value), pa.float64())
        release_memory()
        return out

    scores = F.arrow_udf(run, "double")
    return without(df, name).withColumn(name, scores(F.col(text_col)))


def training_labels(spark, sf_dir):
    """The rows of ``labels`` that a fit may see."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet").filter(crc_mod(F.col("doc_id"), 4) != HELD_OUT)


def op1_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = score(docs, fit(docs, training_labels(spark, sf_dir)))
    held_out = crc_mod(F.col("doc_id"), 4) == HELD_OUT
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))
