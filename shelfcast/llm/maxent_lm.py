"""Language model scores: a hashed maximum-entropy model with a class-factored softmax.

P(word | before) = P(class | before) * P(word | class). The first factor is a softmax over CLASSES
classes with n-gram and skip features of the three words before (the last, the second last, the
third last, and the last two together), hashed into ROWS weight rows. The second starts from a
closed form: (c + 1) over the class's sum of (c + 1), with one share for words never seen. The HEAD most
frequent words and the end are classes of their own; other words go by the hash of their last
three bytes into BUCKETS buckets, which are grouped into the remaining classes by the frequent
words that precede them, counted over all training documents.

Within a class the words seen are told apart by the digits (of four bits) of their hashes: P(word |
class, before) is a product of softmaxes over the next digit, each with the closed form's sums as
its offset and the same four features of whole words (by hash) as its weights, so that without
weights it is the closed form. Digits follow the distinct words (a cell for each word, up to
MOST_DIGITS digits; words that share a cell share it by their counts), and weight rows follow the
tokens, up to MOST_ROWS.

Training. Counts are one grouped aggregate over words (64-bit hashes), combined in the tasks first.
The softmax starts from the classes' shares and is trained in ROUNDS rounds over disjoint parts of
all training documents. In a round every task adds up, at the same weights, how often each weight
row saw each class and how often the model expected it; their difference is the gradient. A grouped
sum over the tasks gives one scaled step, STEP * log((seen + PRIOR) / (expected + PRIOR)), which to
first order is the gradient over the expected count. As tasks only add up, the step does not depend
on how many there are or which rows they hold. The second factor is trained likewise, in the same
rounds, so that texts are read and cut into words once for both. A task takes
about TASK_TOKENS tokens, so that what it sends stays in proportion to what it read.
What the driver receives is bounded: the weights, bucket statistics, the sums of cells and the
KNOWN most frequent words.

Scoring. One pass works out the class factor and looks up frequent words; the rest of a text's
words, with their numbers, are joined with the counts and summed by document. So no vocabulary is
broadcast whole, and the score is exact for every word.

Defined cases: a null or empty text is its end alone; rows with equal ids are scored one by one;
without training documents every token's base probability is 1; an empty table has no rows. Scores
sum in double precision, in no fixed order.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfcast.llm.tables import bounded_batches, documents, written
from shelfcast.llm.textops import LOWER, crc_mod, hash_spans, mix64, release_memory, slices, word_bounds

HEAD = 20
CLASSES = 32
BUCKETS = 4_096
ROWS = 1 << 14
ROUNDS = 2
KNOWN = 100_000
BATCH = 2_048
SHORT_RUN = 8
STEP = 0.4
PRIOR = 1.0
TASK_TOKENS = 1 << 22
HELD_OUT = 2
DIGIT = 16
MOST_DIGITS = 4
MOST_ROWS = 1 << 18
END = np.uint64(0x9D39247E33776D41)
LOG10 = np.log(10.0)


def _finder(known, spare=0):
    """A function that gives for hashes where they would be in sorted ones (the last place at most).

    With ``spare`` bits more of a hash, its first guess is wrong less often.
    """
    shift = np.uint64(64 - max(1, len(known)).bit_length() - spare)
    first = np.searchsorted(known, np.arange(1 << (64 - int(shift)), dtype=np.uint64) << shift)
    last = len(known) - 1

    def places(hashes):
        at = np.minimum(first[(hashes >> shift).astype(np.int64)], last)
        more = np.flatnonzero(known[at] < hashes)
        while len(more := more[at[more] < last]):
            at[more] += 1
            more = more[known[at[more]] < hashes[more]]
        return at

    return places


class Codes(NamedTuple):
    """How words become codes (HEAD words, end, start, buckets) and codes become classes."""

    head: np.ndarray  # sorted hashes of the most frequent words
    classes: np.ndarray  # by code

    @property
    def end(self):
        return len(self.head)

    @property
    def start(self):
        return len(self.head) + 1

    def of(self, hashes, buckets):
        """Codes of words; the bucket of the end is -1."""
        codes = buckets + np.int64(self.start + 1)
        if len(self.head):
            at = _finder(self.head, 8)(hashes)
            found = self.head[at] == hashes
            codes[found] = at[found]
        codes[buckets < 0] = self.end
        return codes


def _tails(data, starts, ends):
    """The last three bytes of each word, each plus 1 in nine bits; 0 where the word has fewer."""
    padded = np.concatenate((np.zeros(3, np.uint8), data, np.zeros(1, np.uint8)))
    fours = np.lib.stride_tricks.as_strided(padded[:4].view(np.uint32), (len(data) + 1,), (1,))
    last, lengths = fours[ends], ends - starts
    tail = ((last >> np.uint32(16)) & np.uint32(255)) + np.uint32(1)
    for k in (2, 3):
        byte = ((last >> np.uint32(8 * (3 - k))) & np.uint32(255)) + np.uint32(1)
        tail |= (byte << np.uint32(9 * (k - 1))) * (lengths >= k).astype(np.uint32)
    return tail.astype(np.uint64)


def tokens(column):
    """(first row, hashes, buckets, bounds by row) of slices of a column; each text ends with END."""
    for at, to, data, offsets in slices(column):
        data = LOWER[data]
        starts, ends, first = word_bounds(data, offsets)
        rows = to - at
        words = np.arange(len(starts)) + np.repeat(np.arange(rows), np.diff(first))
        bounds = first + np.arange(rows + 1)
        hashes = np.full(bounds[-1], END)
        buckets = np.full(bounds[-1], -1, np.int64)
        hashes[words] = hash_spans(data, starts, ends)
        buckets[words] = (mix64(_tails(data, starts, ends)) % np.uint64(BUCKETS)).astype(np.int64)
        yield at, hashes, buckets, bounds


def before(codes, bounds, start, k):
    """The code k tokens earlier in the same row; ``start`` where there is none."""
    out = np.full(len(codes), start, codes.dtype)
    out[k:] = codes[:-k] if k else codes
    for j in range(k):
        at = bounds[:-1] + j
        out[at[at < bounds[1:]]] = start
    return out


def features(codes, bounds, start):
    """Weight rows of the four features of each token."""
    one, two, three = (before(codes, bounds, start, k).astype(np.uint64) for k in (1, 2, 3))
    with np.errstate(over="ignore"):
        keys = (one + np.uint64(1 << 40), two + np.uint64(2 << 40), three + np.uint64(3 << 40), (one << np.uint64(20)) + two + np.uint64(4 << 40))
    return np.stack([(mix64(k) % np.uint64(ROWS)).astype(np.uint16) for k in keys])


def _exponentials(weights, bias, rows):
    """Each token's probabilities before they are divided by their sum, and the sum; ``weights`` of None are zero."""
    if weights is None:
        logits = np.array(np.broadcast_to(bias, (rows.size // len(rows), bias.shape[-1])))
    else:
        logits = weights.take(rows[0], axis=0)
        logits += bias
        for r in rows[1:]:
            logits += weights.take(r, axis=0)
    ones = np.ones(logits.shape[1], np.float32)
    with np.errstate(over="ignore"):
        p = np.exp(logits)
    sums = p @ ones
    if len(p) and not (1e-20 < sums.min() and sums.max() < 1e30):
        # beyond single precision: relative to each token's largest
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        sums = p @ ones
    return p, sums


def _softmax(weights, bias, rows):
    """Probabilities of each token; ``weights`` of None are zero."""
    p, sums = _exponentials(weights, bias, rows)
    p /= sums[:, None]
    return p


def _chosen(weights, bias, rows, taken):
    """Probability of the outcome ``taken`` of each token."""
    p, sums = _exponentials(weights, bias, rows)
    return p[np.arange(len(p)), taken] / sums


def _put(table, rows, values):
    """table[rows] = values, for contiguous tables; rows are copied as one item each."""
    item = f"V{table.itemsize * table.shape[1]}"
    table.view(item).ravel().put(rows, values.view(item).ravel())


def _run_sums(values, places, first, times):
    """Sums of values[places] over runs of places, which begin at ``first`` and have ``times`` members."""
    sums = values.take(places[first], axis=0)
    more, k = np.flatnonzero(times > 1), 1
    while len(more) and k < SHORT_RUN:  # most are short: the k-th members of all of them at once
        _put(sums, more, sums.take(more, axis=0) + values.take(places[first[more] + k], axis=0))
        k += 1
        more = more[times[more] > k]
    if len(more):
        rest = times[more] - k
        starts = np.cumsum(rest) - rest
        inside = np.arange(starts[-1] + rest[-1]) + np.repeat(first[more] + k - starts, rest)
        sums[more] += np.add.reduceat(values.take(places[inside], axis=0), starts, axis=0)
    return sums


class Learner:
    """Adds up the gradient of a part of the documents at given weights."""

    def __init__(self, weights, bias):
        self.start, self.bias = weights, bias
        # a copy: numpy asks for huge pages for it, pickle does not
        self._given = weights.copy() if weights.any() else None
        self._seen = np.zeros(weights.size, np.int64)
        self._waiting, self._size = [], 0
        self._expected = np.zeros(weights.shape, np.float32)

    @property
    def expected(self):
        """How often the model expected each outcome at each weight row."""
        if self._given is None:  # the same shares for every token
            shares = _softmax(None, self.bias, np.zeros((1, 1), np.int64))
            return (self.seen.sum(axis=1, keepdims=True) * shares.astype(float)).astype(np.float32)
        return self._expected

    @property
    def seen(self):
        """How often each weight row saw each outcome."""
        if self._waiting:
            self._seen += np.bincount(np.concatenate(self._waiting), minlength=len(self._seen))
            self._waiting, self._size = [], 0
        return self._seen.reshape(self.start.shape)

    @property
    def weights(self):
        """The weights after a step with this part alone."""
        return self.start + (STEP * np.log((self.seen + PRIOR) / (self.expected + PRIOR))).astype(np.float32)

    def see(self, rows, taken):
        """Tokens with the weight rows ``rows`` and outcomes ``taken``."""
        n = len(taken)
        cells = (rows.reshape(-1, n).astype(np.int32) * np.int32(self.start.shape[1]) + taken.astype(np.int32)).ravel()
        self._waiting.append(cells)
        self._size += len(cells)
        if self._size > len(self._seen):
            self.seen  # counted in one go

    def expect(self, rows, p):
        """Tokens with the weight rows ``rows`` and probabilities ``p``."""
        n = len(p)
        shift = max(1, n - 1).bit_length()
        kind = np.uint32 if len(self.start) << shift <= 1 << 32 else np.uint64
        # the row and the token in one number, which sorts faster than places do
        both = ((rows.reshape(-1, n).astype(kind) << kind(shift)) | np.arange(n, dtype=kind)).ravel()
        both.sort()
        ranked, token = both >> kind(shift), (both & kind((1 << shift) - 1)).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(ranked[1:] != ranked[:-1]) + 1))
        touched, times = ranked[first].astype(np.int64), np.diff(first, append=len(both))
        sums = _run_sums(p, token, first, times)
        sums += self._expected.take(touched, axis=0)
        _put(self._expected, touched, sums)

    def learn(self, column, codes):
        learn([self], column, codes)

    def add(self, hashes, code, classes, bounds, start):
        """Tokens with their codes and classes; text r has those from bounds[r] to bounds[r + 1]."""
        rows = features(code, bounds, start)
        self.see(rows, classes)
        for at in range(0, len(code) if self._given is not None else 0, BATCH):
            part = rows[:, at : at + BATCH]
            self.expect(part, _softmax(self._given, self.bias, part))


def learn(learners, column, codes):
    """Shows the tokens of a column, which are read once, to all learners."""
    for _, hashes, buckets, bounds in tokens(column):
        code = codes.of(hashes, buckets)
        classes = codes.classes[code]
        for learner in learners:
            learner.add(hashes, code, classes, bounds, codes.start)


class Within(NamedTuple):
    """The second factor: softmaxes over the digits of a word's hash, below its class."""

    digits: int
    offsets: np.ndarray  # by node, the logs of its children's sums of (c + 1)
    cells: np.ndarray  # the sums of (c + 1) of the last digits' children
    weights: np.ndarray

    def places(self, hashes, groups):
        """(nodes, digits) by depth of words of infrequent classes, and their cells."""
        code = (mix64(hashes) >> np.uint64(64 - 4 * MOST_DIGITS)).astype(np.int64)
        nodes, taken, first = [], [], 0
        for d in range(self.digits):
            rest = 4 * (MOST_DIGITS - d)
            nodes.append(first + (groups << (4 * d)) + (code >> rest))
            taken.append((code >> (rest - 4)) & (DIGIT - 1))
            first += (CLASSES - HEAD - 1) << (4 * d)
        return np.stack(nodes), np.stack(taken), (groups << (4 * self.digits)) + (code >> (4 * (MOST_DIGITS - self.digits)))

    def rows(self, keys, nodes):
        """Weight rows of the four features at the nodes, by depth within each feature."""
        at = mix64(nodes.astype(np.uint64) + np.uint64(1))
        return np.stack([(mix64(k[None] ^ at) & np.uint64(len(self.weights) - 1)).astype(np.int64).ravel() for k in keys])

    def log10(self, hashes, classes, keys, mass):
        """log10 of what the trained factor of each seen word is to the closed form, which has the word's count over its class's mass."""
        out = np.zeros(len(hashes))
        inside = np.flatnonzero(classes > HEAD)
        for a in range(0, len(inside), BATCH):
            here = inside[a : a + BATCH]
            nodes, taken, cells = self.places(hashes[here], classes[here] - HEAD - 1)
            p = _chosen(self.weights, self.offsets.take(nodes.ravel(), axis=0), self.rows(keys[:, here], nodes), taken.ravel())
            out[here] = np.log10(np.maximum(p, 1e-30)).reshape(nodes.shape).sum(axis=0) + np.log10(np.maximum(mass[classes[here]] - 1, 1) / np.maximum(self.cells[cells], 1))
        return out


def contexts(hashes, bounds):
    """Keys of the four features of each token, by the hashes of the words before."""
    one, two, three = (before(hashes, bounds, np.uint64(0), k) for k in (1, 2, 3))
    with np.errstate(over="ignore"):
        both = mix64(one + np.uint64(4)) + two
        return np.stack([mix64(one + np.uint64(1)), mix64(two ^ np.uint64(2 << 40)), mix64(three ^ np.uint64(3 << 40)), mix64(both)])


class WithinLearner(Learner):
    """Adds up the gradient of the second factor; without weights the probabilities follow from the node alone."""

    def __init__(self, within):
        super().__init__(within.weights, None)
        self.within = within
        if self._given is None:
            self._shares = _softmax(None, within.offsets, np.zeros((1, len(within.offsets)), np.int64))

    @property
    def expected(self):
        return self._expected

    def add(self, hashes, code, classes, bounds, start):
        keys, inside = contexts(hashes, bounds), np.flatnonzero(classes > HEAD)
        for a in range(0, len(inside), BATCH):
            here = inside[a : a + BATCH]
            nodes, taken, _ = self.within.places(hashes[here], classes[here] - HEAD - 1)
            rows, nodes = self.within.rows(keys[:, here], nodes), nodes.ravel()
            self.see(rows, taken.ravel())
            if self._given is None:
                p = self._shares.take(nodes, axis=0)
            else:
                p = _softmax(self._given, self.within.offsets.take(nodes, axis=0), rows)
            self.expect(rows, p)


def group_buckets(together, groups, rounds=12):
    """Groups rows of counts by their profile (weighted k-means of square roots); a group for each row."""
    sizes = together.sum(axis=1)
    profile = np.sqrt(together / np.maximum(sizes, 1)[:, None])
    centers = profile[[int(sizes.argmax())]]
    while len(centers) < groups:
        # the next center: the heaviest row far from all so far
        gap = ((profile[:, None] - centers[None]) ** 2).sum(axis=2).min(axis=1)
        centers = np.concatenate((centers, profile[[int((gap * np.sqrt(sizes)).argmax())]]))
    for _ in range(rounds):
        near = ((profile[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        weight = np.bincount(near, sizes, minlength=groups)
        sums = np.stack([np.bincount(near, profile[:, d] * sizes, minlength=groups) for d in range(profile.shape[1])], axis=1)
        centers = np.where(weight[:, None] > 0, sums / np.maximum(weight, 1)[:, None], centers)
    return near


def _counted(batches):
    """(hash, bucket, count) of a task's words; a word may come more than once from a long task."""

    def out(parts):
        hashes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([p[2] for p in parts])).astype(np.int64)
        buckets = np.empty(len(hashes), np.int64)
        buckets[at] = np.concatenate([p[1] for p in parts])
        return hashes, buckets, counts

    def batch(part):
        return pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), pa.array(part[1]), pa.array(part[2])], ["h", "bucket", "c"])

    waiting, size = [], 0
    for b in batches:
        for _, hashes, buckets, _ in tokens(b.column(0)):
            waiting.append(out([(hashes, buckets, np.ones(len(hashes)))]))
            size += len(waiting[-1][0])
            if size > 1 << 21:
                waiting = [out(waiting)]
                size = len(waiting[0][0])
                if size > 1 << 20:
                    yield batch(waiting.pop())
                    size = 0
    if waiting:
        yield batch(out(waiting))
    del waiting
    release_memory()


def word_counts(docs, text_col="text"):
    """(h, bucket, c): how often each word, and the end, occurs in the documents."""
    bounded_batches(docs.sparkSession)
    parts = docs.select(F.col(text_col)).mapInArrow(_counted, "h bigint, bucket bigint, c bigint")
    return parts.groupBy("h").agg(F.max("bucket").alias("bucket"), F.sum("c").alias("c"))


def _preceded(head):
    """For each bucket how often each frequent word stands up to three words before."""
    codes = Codes(head, None)

    def run(batches):
        total = np.zeros((BUCKETS, max(1, len(head))), np.int64)
        for b in batches:
            for _, hashes, buckets, bounds in tokens(b.column(0)):
                code = codes.of(hashes, buckets)
                for k in (1, 2, 3):
                    earlier = before(code, bounds, codes.start, k)
                    both = (code > codes.start) & (earlier < len(head))
                    cells = (code[both] - codes.start - 1) * total.shape[1] + earlier[both]
                    total += np.bincount(cells, minlength=total.size).reshape(total.shape)
        rows = np.flatnonzero(total.any(axis=1))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, total.shape[1] * len(rows) + 1, total.shape[1]), pa.int32()), pa.array(total[rows].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(rows), lists], ["bucket", "n"])
        release_memory()

    return run


def _learned(shared):
    """The sums of a task by weight row: (row, seen, scale, expected in steps of the scale).

    Rows are of DIGIT outcomes; a learner with more has several for each of its own. They are numbered on from
    learner to learner.
    """

    def run(batches):
        codes, given = shared.value
        learners = [kind(*start) for kind, *start in given]
        for b in batches:
            learn(learners, b.column(0), codes)
        release_memory()
        first = 0
        while learners:
            learner = learners.pop(0)
            seen, sums = learner.seen.reshape(-1, DIGIT), learner.expected.reshape(-1, DIGIT)
            # all outcomes of a row that was met, as those not seen were expected, too
            touched = np.flatnonzero(np.repeat(learner.seen.any(axis=1), learner.start.shape[1] // DIGIT))
            for a in range(0, len(touched), 1 << 15):
                rows = touched[a : a + (1 << 15)]
                expected = sums[rows].astype(np.float64)
                # in steps of a 32,767th of the row's largest sum, as each task sends most rows
                scale = np.maximum(expected.max(axis=1), 1e-30) / 32_767
                steps = np.rint(expected / scale[:, None]).astype(np.int16)
                at = pa.array(np.arange(0, DIGIT * len(rows) + 1, DIGIT), pa.int32())
                columns = [pa.ListArray.from_arrays(at, pa.array(v.ravel())) for v in (seen[rows].astype(np.int32), steps)]
                yield pa.RecordBatch.from_arrays([pa.array(first + rows), columns[0], pa.array(scale), columns[1]], ["row", "seen", "scale", "expected"])
            first += len(seen)
            del learner, seen, sums
        release_memory()

    return run


def _round(texts, weights, tokens_read, codes, given):
    """The learners' weights after one round's step, from the sums of all tasks; ``given`` is what makes each learner."""
    shared = texts.sparkSession.sparkContext.broadcast((codes, given))
    parts = texts.coalesce(max(1, -(-tokens_read // TASK_TOKENS)))
    learned = parts.mapInArrow(_learned(shared), "row bigint, seen array<int>, scale double, expected array<smallint>")
    learned = learned.repartition("row")  # before the sums, which are wider
    step = [
        (STEP * F.log((F.sum(F.col("seen")[k]) + PRIOR) / (F.sum(F.col("scale") * F.col("expected")[k]) + PRIOR))).cast("float").alias(f"d{k}")
        for k in range(DIGIT)
    ]
    moved = learned.groupBy("row").agg(*step).toArrow()
    after = np.concatenate([w.reshape(-1, DIGIT) for w in weights])
    if len(moved):
        after[moved["row"].to_numpy()] += np.stack([moved[f"d{k}"].to_numpy() for k in range(DIGIT)], axis=1)
    ends = np.cumsum([w.size // DIGIT for w in weights])
    return [part.reshape(w.shape) for part, w in zip(np.split(after, ends[:-1]), weights, strict=True)]


class Model(NamedTuple):
    """What scoring needs on every task; its size is fixed."""

    codes: Codes
    weights: np.ndarray
    bias: np.ndarray
    mass: np.ndarray  # by class: the sum of (c + 1) of its words, with one share for unseen ones
    known: np.ndarray  # sorted hashes of the KNOWN most frequent words
    known_counts: np.ndarray
    tokens: int
    distinct: int


def _parts(docs, text_col, rounds):
    """The texts of each round: disjoint parts, by hash, which together are all documents."""
    part = F.pmod(F.xxhash64(text_col), F.lit(rounds))
    return [docs.select(text_col).filter(part == number) for number in range(rounds)]


def _trained(docs, model, within, text_col, rounds, factors):
    """The model and its second factor after all rounds; ``factors`` are those trained, "first", "second" or both, in one pass."""
    for texts in _parts(docs, text_col, rounds):
        starts = {"first": (Learner, model.weights, model.bias), "second": (WithinLearner, within)}
        weights = {"first": model.weights, "second": within.weights if within else None}
        moved = _round(texts, [weights[f] for f in factors], model.tokens // rounds, model.codes, [starts[f] for f in factors])
        weights |= dict(zip(factors, moved, strict=True))
        model = model._replace(weights=weights["first"])
        within = within and within._replace(weights=weights["second"])
    return model, within


def fit(docs, counts, text_col="text", rounds=ROUNDS):
    """A model from all ``docs``; ``counts`` is their written table of word counts."""
    return _trained(docs, _untrained(docs, counts, text_col), None, text_col, rounds, ["first"])[0]


def _untrained(docs, counts, text_col):
    """A model with its codes, shares and counts, whose weights are zero."""
    top = counts.orderBy(F.desc("c"), "h").limit(KNOWN).toArrow()
    hashes, frequency = top["h"].to_numpy().view(np.uint64), top["c"].to_numpy()
    head = np.sort(hashes[hashes != END][:HEAD])
    sums = counts.agg(F.count("*").alias("v"), F.sum("c").alias("n")).first()
    together = np.zeros((BUCKETS, max(1, len(head))))
    for r in docs.select(text_col).mapInArrow(_preceded(head), "bucket bigint, n array<bigint>").select(
        "bucket", F.posexplode("n")
    ).groupBy("bucket", "pos").agg(F.sum("col").alias("n")).toArrow().to_pylist():
        together[r["bucket"], r["pos"]] = r["n"]
    groups = group_buckets(together, CLASSES - HEAD - 1)
    codes = Codes(head, np.concatenate((np.arange(len(head)), [HEAD, 0], HEAD + 1 + groups)).astype(np.int64))
    # sums of (c + 1) by class: by bucket over all words, less the frequent ones, which have their own
    mass = np.zeros(CLASSES)
    mass[HEAD + 1 :] = 1
    for r in counts.groupBy("bucket").agg(F.sum(F.col("c") + 1).alias("m")).toArrow().to_pylist():
        mass[codes.classes[codes.start + 1 + r["bucket"]] if r["bucket"] >= 0 else HEAD] += r["m"]
    own = counts.filter(F.col("h").isin([int(h) for h in head.view(np.int64)])).collect() if len(head) else []
    for r in own:
        mass[codes.classes[codes.start + 1 + r["bucket"]]] -= r["c"] + 1
        mass[np.searchsorted(head, np.array([r["h"]], np.int64).view(np.uint64)[0])] += r["c"] + 1
    mass[: HEAD + 1] = np.maximum(mass[: HEAD + 1], 1)
    weights, bias = np.zeros((ROWS, CLASSES), np.float32), np.log(np.maximum(mass, 1) / np.maximum(mass, 1).sum()).astype(np.float32)
    order = np.argsort(hashes)
    return Model(codes, weights, bias, mass, hashes[order], frequency[order], int(sums["n"] or 0), int(sums["v"]))


def _cells(codes, digits):
    """(cell, n): the sums of (c + 1) of infrequent words by their cells, from a table of word counts."""
    empty = Within(digits, None, None, None)

    def run(batches):
        for b in batches:
            hashes, buckets, c = (b.column(k).to_numpy() for k in range(3))
            classes = codes.classes[codes.of(hashes.view(np.uint64), buckets.copy())]
            inside = classes > HEAD
            cells = empty.places(hashes.view(np.uint64)[inside], classes[inside] - HEAD - 1)[2]
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(c[inside] + 1)], ["cell", "n"])

    return run


def fit_within(docs, model, counts, text_col="text", rounds=ROUNDS):
    """The second factor of a model, trained on the same ``docs``."""
    return _trained(docs, model, _untrained_within(model, counts), text_col, rounds, ["second"])[1]


def fit_both(docs, counts, text_col="text", rounds=ROUNDS):
    """What ``fit`` and ``fit_within`` give, as (model, second factor); each round reads its documents once for both."""
    model = _untrained(docs, counts, text_col)
    return _trained(docs, model, _untrained_within(model, counts), text_col, rounds, ["first", "second"])


def _untrained_within(model, counts):
    """A second factor whose weights are zero."""
    groups, digits = CLASSES - HEAD - 1, 1
    while digits < MOST_DIGITS and groups * DIGIT**digits < model.distinct:
        digits += 1
    found = counts.select("h", "bucket", "c").mapInArrow(_cells(model.codes, digits), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells = np.zeros(groups * DIGIT**digits)
    cells[found["cell"].to_numpy()] = found["n"].to_numpy()
    sums, offsets = cells, []
    for _ in range(digits):
        sums = sums.reshape(-1, DIGIT)
        offsets.insert(0, np.where(sums > 0, np.log(np.maximum(sums, 1)), -1e4).astype(np.float32))
        sums = sums.sum(axis=1)
    size = 1
    while size < min(MOST_ROWS, digits * model.tokens):
        size *= 2
    return Within(digits, np.concatenate(offsets), cells, np.zeros((size, DIGIT), np.float32))


def _scored(shared, names):
    """Rows with what a task can tell of each text, and the words whose counts it lacks."""

    def run(batches):
        from pyspark import TaskContext

        model, within = shared.value
        if within:
            within = within._replace(weights=within.weights.copy())  # numpy asks for huge pages for it, pickle does not
        row = TaskContext.get().partitionId() << 36
        codes, places = model.codes, _finder(model.known)
        for batch in batches:
            at = 0
            for first, hashes, buckets, bounds in tokens(batch.column(0)):
                code = codes.of(hashes, buckets)
                classes, rows = codes.classes[code], features(code, bounds, codes.start)
                factor = np.empty(len(code))
                for a in range(0, len(code), BATCH):
                    p = _chosen(model.weights, model.bias, rows[:, a : a + BATCH], classes[a : a + BATCH])
                    factor[a : a + BATCH] = np.log10(np.maximum(p, 1e-30))
                factor -= np.log10(model.mass[classes])
                trained = within.log10(hashes, classes, contexts(hashes, bounds), model.mass) if within else np.zeros(len(code))
                if len(model.known):
                    place = places(hashes)
                    found = model.known[place] == hashes
                    seen = np.where(found, model.known_counts[place], 0)
                else:
                    found, seen = np.zeros(len(hashes), bool), np.zeros(len(hashes))
                factor[found] += trained[found]
                of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                # the others: each distinct word of a text once, with its number
                rest = np.flatnonzero(~found)
                order = rest[np.lexsort((hashes[rest], of[rest]))]
                new = np.ones(len(order), bool)
                new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of[order][1:] != of[order][:-1])
                start = np.flatnonzero(new)
                words, times = hashes[order[start]], np.diff(np.append(start, len(order)))
                paths = np.add.reduceat(trained[order], start) if len(start) else np.zeros(0)
                cuts = np.searchsorted(of[order[start]], np.arange(len(bounds)))
                cuts = pa.array(cuts, pa.int32())
                n = len(bounds) - 1
                sums = [np.add.reduceat(v, bounds[:-1]) if n else np.zeros(0) for v in (factor, np.log10(seen + 1), found)]
                columns = [batch.column(1 + i).slice(first, n) for i in range(len(names))]
                columns += [pa.array(row + at + np.arange(n)), pa.array(np.diff(bounds)), *map(pa.array, (sums[0], sums[1], sums[2].astype(np.int64)))]
                columns += [pa.ListArray.from_arrays(cuts, pa.array(words.view(np.int64))), pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int64)))]
                columns.append(pa.ListArray.from_arrays(cuts, pa.array(paths)))
                at += n
                yield pa.RecordBatch.from_arrays(columns, [*names, "lm_row", "n_tokens", "lm_factor", "lm_log", "lm_known", "lm_words", "lm_times", "lm_paths"])
            row += at
            release_memory()

    return run


def score(df, model, counts, keep, text_col="text", within=None):
    """The columns ``keep`` with n_tokens, n_known, train_tokens, base_score and score of each text.

    Without ``within`` the second factor is the closed form.
    """
    shared = df.sparkSession.sparkContext.broadcast((model, within))
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    kinds += ", lm_row bigint, n_tokens bigint, lm_factor double, lm_log double, lm_known bigint, lm_words array<bigint>, lm_times array<bigint>, lm_paths array<double>"
    rows = written(df.select(F.col(text_col), *keep).mapInArrow(_scored(shared, list(keep)), kinds), "lm-rows")
    rare = rows.select("lm_row", F.explode(F.arrays_zip("lm_words", "lm_times", "lm_paths")).alias("w"))
    rare = rare.select("lm_row", F.col("w.lm_words").alias("h"), F.col("w.lm_times").alias("times"), F.col("w.lm_paths").alias("path")).join(counts, "h")
    rare = rare.groupBy("lm_row").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("rare_log"), F.sum("path").alias("rare_path"), F.sum("times").alias("rare_known"))
    rows = rows.drop("lm_words", "lm_times", "lm_paths").join(rare, "lm_row", "left")
    log = F.col("lm_log") + F.coalesce("rare_log", F.lit(0.0))
    uniform = float(np.log10(model.tokens + model.distinct + 1))
    return rows.select(
        *keep,
        "n_tokens",
        (F.col("lm_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (log - F.col("n_tokens") * F.lit(uniform)).alias("base_score"),
        (log + F.col("lm_factor") + F.coalesce("rare_path", F.lit(0.0))).alias("score"),
    )


def op6_maxent_lm(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 7) == HELD_OUT
    training = docs.filter(~held_out)
    counts = written(word_counts(training), "lm-counts")
    model, within = fit_both(training, counts)
    scored = score(docs, model, counts, ["doc_id"], within=within)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
