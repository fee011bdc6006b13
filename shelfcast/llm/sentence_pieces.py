"""SentencePiece encoding and decoding with weighted finite-state transducers.

Three transducers are compiled from a model file. The normaliser maps a space to the meta symbol
and writes one in front of a text (as the model's specification says); the piece transducer reads
characters and writes a piece's id; the fallback reads a character that no piece holds and writes
the ids of its UTF-8 bytes (or the unknown id). An input is composed with them position by
position, and the shortest path in the tropical semiring (weights add along a path, the smallest
total wins) gives the ids.

Models of merges (BPE) do not choose the path of the best score: they merge the best neighbours
first. A sequence of pieces is what merging gives exactly if it does so for every two adjacent
ones. So for these models the piece transducer keeps the last piece as its state, and has an arc
only to pieces that may follow it (an arc's absence is the weight infinity); whether one may follow
is worked out by merging the two, when it is first asked. Models of unigrams have one state.

Between two characters that stand side by side in no piece all paths pass one state. So a path is
the concatenation of the paths of the chunks between such places (a space begins one), and a worker
works out each distinct chunk once.

Defined cases: a null text encodes and decodes like an empty one, to no ids and an empty text; the
meta symbol in a text is a space; decoding replaces each byte that is not UTF-8 by U+FFFD, and ids
outside the model are an error; models with a character map, or with user-defined or unused
pieces, are refused.
"""

from __future__ import annotations

import codecs
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from shelfcast.llm.chunks import ChunkEncoder
from shelfcast.llm.tables import bounded_batches, documents, without
from shelfcast.llm.textops import keep, release_memory

META = "▁"
#: Kinds of pieces and of models in the file format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
INFINITE = float("inf")
UNKNOWN_WEIGHT = 100.0  # of a character without a piece, in a model of unigrams
MOST_PAIRS = 500_000  # that a worker keeps in mind
MOST_CHUNKS = 700_000  # likewise; an argument of encode, ids do not depend on it
SLICE_BYTES = 1 << 19
SLICE_IDS = 1 << 16  # that are decoded at once
codecs.register_error("each_byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))


def _fields(data):
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = varint() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
            yield key >> 3, data[at : at + size]
            at += size


def read_model(data):
    """What the transducers are compiled from: pieces as (text, score, kind), and the settings."""
    pieces, kind, unknown, byte_fallback = [], UNIGRAM, 0, False
    settings = {"prefix": True, "squeeze": True, "meta": True}
    for number, value in _fields(data):
        if number == 1:
            piece = {"text": "", "score": 0.0, "kind": NORMAL}
            for n, v in _fields(value):
                if n == 1:
                    piece["text"] = bytes(v).decode()
                elif n == 2:
                    piece["score"] = float(np.frombuffer(v, "<f4")[0])
                elif n == 3:
                    piece["kind"] = v
            pieces.append((piece["text"], piece["score"], piece["kind"]))
        elif number == 2:
            spec = dict(_fields(value))
            kind, byte_fallback, unknown = spec.get(3, UNIGRAM), bool(spec.get(35, 0)), spec.get(40, 0)
        elif number == 3:
            spec = dict(_fields(value))
            if spec.get(2):
                raise ValueError("models with a character map are not supported")
            settings = {"prefix": bool(spec.get(3, 1)), "squeeze": bool(spec.get(4, 1)), "meta": bool(spec.get(5, 1))}
    if kind not in (UNIGRAM, BPE) or not settings["meta"] or any(k in (USER_DEFINED, UNUSED) for _, _, k in pieces):
        raise ValueError("unigram and BPE models with escaped spaces and without user-defined or unused pieces only")
    return {"pieces": pieces, "merges": kind == BPE, "bytes": byte_fallback, "unknown": unknown, **settings}


class Transducer:
    """The composed transducer of a model."""

    def __init__(self, model, most_chunks=MOST_CHUNKS):
        self.pieces = model["pieces"]
        self._merges, self._prefix, self._squeeze, self._unknown = (model[k] for k in ("merges", "prefix", "squeeze", "unknown"))
        self._arcs = {}  # a trie of pieces; None holds (id, weight)
        self._scores = {}
        alphabet = set()
        for i, (text, score, kind) in enumerate(self.pieces):
            if kind != NORMAL:
                continue
            self._scores[text] = score
            alphabet.update(text)
            node = self._arcs
            for c in text:
                node = node.setdefault(c, {})
            node[None] = (i, -score)
        self._byte_ids = {int(t[3:5], 16): i for i, (t, _, kind) in enumerate(self.pieces) if kind == BYTE} if model["bytes"] else {}
        self._follows, self._known = {}, {}
        # pieces that score as well as another one: their order depends on places, so they are merged in full
        times = Counter(self._scores.values())
        self._level = {text for text, score in self._scores.items() if times[score] > 1}
        # pairs of bytes that stand side by side in a piece; inside a character all may
        beside = np.zeros((256, 256), bool)
        beside[:, 0x80:0xC0] = True
        for text in self._scores:
            raw = text.replace(META, " ").encode()
            beside[list(raw[:-1]), list(raw[1:])] = True
        self._beside = beside.ravel()
        learn = lambda chunks: [self.shortest(c) for c in chunks]
        self.encoder = ChunkEncoder(self._begins, learn, most=most_chunks, slice_bytes=SLICE_BYTES)

    def _begins(self, data, offsets):
        """Where chunks begin: between bytes that no piece holds side by side."""
        out = np.zeros(len(data), bool)
        out[1:] = ~self._beside[data[:-1].astype(np.uint16) << 8 | data[1:]]
        return out

    def _merged(self, text):
        """What merging makes of a text: the best-scored pair first, the left one of equals.

        Each result is (its left spine, its right spine): itself, the part at its left (right) end
        that it was merged from, that part's part, and so on to a character.
        """
        symbols, scores = [([c], [c]) for c in text], self._scores
        while len(symbols) > 1:
            best, at = -INFINITE, -1
            for k in range(len(symbols) - 1):
                score = scores.get(symbols[k][0][0] + symbols[k + 1][0][0])
                if score is not None and score > best:
                    best, at = score, k
            if at < 0:
                break
            (l0, _), (_, r1) = symbols[at : at + 2]
            both = l0[0] + symbols[at + 1][0][0]
            symbols[at : at + 2] = [([both, *l0], [both, *r1])]
        return symbols

    def _spines(self, piece):
        """The spines of a piece; None for one that merging never makes."""
        if piece not in self._known:
            made = self._merged(self.pieces[piece][0])
            self._known[piece] = made[0] if len(made) == 1 else None
        return self._known[piece]

    def _may_follow(self, left, right):
        """Whether merging both texts together never merges across their border.

        The symbols beside the border climb the left text's right spine and the right text's left
        spine, the better score first. They merge with each other if that scores best at some point.
        """
        a, b, scores = self._spines(left), self._spines(right), self._scores
        if a is None or b is None:
            return False
        ups, downs = a[1], b[0]
        i, j = len(ups) - 1, len(downs) - 1
        if self._level & {*ups[:-1], *downs[:-1]}:
            return [s[0][0] for s in self._merged(ups[0] + downs[0])] == [ups[0], downs[0]]
        while True:
            across = scores.get(ups[i] + downs[j], -INFINITE)
            up = scores[ups[i - 1]] if i else -INFINITE
            down = scores[downs[j - 1]] if j else -INFINITE
            if across > up and across >= down and across > -INFINITE:
                return False
            if not i and not j:
                return True
            if i and up >= down:
                i -= 1
            else:
                j -= 1

    def _fallback(self, character):
        if self._byte_ids:
            return [self._byte_ids[b] for b in character.encode()]
        return [self._unknown]

    def shortest(self, chunk):
        """Ids on the shortest path of a normalised chunk."""
        text = chunk.replace(" ", META)
        steps = self._only_path(text) if self._merges else self._best_path(text)
        out = []
        for piece, character in steps:
            if piece >= 0:
                out.append(piece)
            else:
                out += self._fallback(character)
        return out

    def _arcs_at(self, text, at):
        """(end, piece, weight) of the pieces that begin at a position, the longest last."""
        out, node = [], self._arcs
        for to in range(at, len(text)):
            node = node.get(text[to])
            if node is None:
                break
            if None in node:
                out.append((to + 1, *node[None]))
        return out

    def _only_path(self, text):
        """The path of a model of merges, whose states are (position, last piece).

        Exactly one path is accepted, so the first that reaches the end is the shortest. Arcs are
        tried from the longest, and states that lead nowhere are remembered.
        """
        size, follows, trie = len(text), self._follows, self._arcs
        if len(follows) > MOST_PAIRS:
            follows.clear()
        arcs, dead, path = {}, set(), []
        at, last, left = 0, -1, None
        while at < size:
            if left is None:
                here = arcs.get(at)
                if here is None:
                    here, node = [], trie
                    for to in range(at, size):
                        node = node.get(text[to])
                        if node is None:
                            break
                        if None in node:
                            here.append((to + 1, node[None][0]))
                    here = arcs[at] = here or [(at + 1, -1)]
                left = len(here)
            else:
                here = arcs[at]
            while left:
                left -= 1
                to, piece = here[left]
                if dead and (to, piece) in dead:
                    continue
                if piece >= 0:
                    key = last << 32 | piece if last >= 0 else ~piece
                    fits = follows.get(key)
                    if fits is None:
                        fits = follows[key] = self._spines(piece) is not None if last < 0 else self._may_follow(last, piece)
                    if not fits:
                        continue
                path.append((at, last, left, piece))
                at, last, left = to, piece, None
                break
            else:
                dead.add((at, last))
                at, last, left, _ = path.pop()
        return [(piece, text[start]) for start, _, _, piece in path]

    def _best_path(self, text):
        """The path of a model of unigrams, which has one state: the smallest total at each position."""
        size = len(text)
        total, step = [0.0] + [INFINITE] * size, [None] * (size + 1)
        for at in range(size):
            arcs = self._arcs_at(text, at)
            if not arcs or arcs[0][0] > at + 1:
                arcs.append((at + 1, -1, UNKNOWN_WEIGHT))
            for to, piece, weight in arcs:
                if total[at] + weight < total[to]:
                    total[to], step[to] = total[at] + weight, (at, piece)
        out, at = [], size
        while at:
            at, piece = step[at]
            out.append((piece, text[at]))
        return out[::-1]

    def normalise(self, column):
        """The normaliser's output for an Arrow column, with spaces for meta symbols."""
        column = pc.replace_substring(pc.fill_null(column.cast(pa.large_string()), ""), META, " ")
        if self._squeeze:
            column = pc.utf8_trim(pc.replace_substring_regex(column, " +", " "), " ")
        if self._prefix:
            column = pc.if_else(pc.equal(column, ""), column, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), column, pa.scalar("", pa.large_string())))
        return column

    def parts(self, column):
        """(first row, ids, number of ids of each row) of consecutive rows of an Arrow column."""
        return self.encoder.parts(self.normalise(column))

    def encode(self, texts):
        """(ids of all texts, number of ids of each) of a list."""
        parts = list(self.parts(pa.array(texts, pa.string())))
        none = (0, np.zeros(0, np.uint32), np.zeros(0, np.int64))
        return tuple(np.concatenate([p[k] for p in [none, *parts]]) for k in (1, 2))

    def _inverse(self):
        """What each id writes: its bytes, one after the other, and their bounds."""
        if not hasattr(self, "_written"):
            parts = []
            for text, _, kind in self.pieces:
                if kind == BYTE:
                    parts.append(bytes([int(text[3:5], 16)]))
                elif kind == UNKNOWN:
                    parts.append(" ⁇ ".encode())
                else:
                    parts.append(b"" if kind == CONTROL else text.replace(META, " ").encode())
            self._written = np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return self._written

    def decode(self, ids, counts):
        """The texts of ids, ``counts`` of them each."""
        ends = np.concatenate(([0], np.cumsum(counts)))
        texts, at = [], 0
        while at < len(counts):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_IDS, "right")) - 1)
            texts += self._decode(np.asarray(ids[ends[at] : ends[to]], np.int64), ends[at : to + 1] - ends[at])
            at = to
        return texts

    def _decode(self, ids, places):
        data, bounds = self._inverse()
        lengths = bounds[ids + 1] - bounds[ids]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        flat = data[np.arange(ends[-1]) + np.repeat(bounds[ids] - ends[:-1], lengths)].tobytes()
        cuts = ends[places]
        texts = [flat[a:b].decode("utf-8", "each_byte") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        if self._prefix:
            unknown = np.array([kind == UNKNOWN for _, _, kind in self.pieces])
            for k, text in enumerate(texts):
                if text.startswith(" "):
                    own, written = ids[places[k] : places[k + 1]], lengths[places[k] : places[k + 1]] > 0
                    # the prefix is the space of a piece, not the one that an unknown id writes
                    texts[k] = text if unknown[own[written.argmax()]] else text[1:]
        return texts


_compiled: dict[tuple, Transducer] = {}


def transducer(shared, most_chunks=MOST_CHUNKS):
    """The worker's transducer of a broadcast model; compiled once in a stage, with what it has learnt."""
    model = shared.value
    keep("transducer", _compiled.clear)
    key = zlib.crc32(model), most_chunks
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = Transducer(read_model(model), most_chunks)
    return _compiled[key]


def _share(df, model):
    bounded_batches(df.sparkSession)
    with open(model, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(df, model, text_col="text", name="ids", most_chunks=MOST_CHUNKS):
    """The table with a column ``name``: the ids of each whole text. ``model`` is a path; the driver reads it.

    A worker keeps the ids of up to ``most_chunks`` chunks (about 200 bytes each).
    """
    shared = _share(df, model)

    def run(texts):
        flat, counts = [], []
        for _, ids, sizes in transducer(shared, most_chunks).parts(texts):
            flat.append(ids.astype(np.int32))
            counts.append(sizes)
        release_memory()
        ends = np.concatenate(([0], np.cumsum(np.concatenate([*counts, np.zeros(0, np.int64)]))))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*flat, np.zeros(0, np.int32)])))

    return without(df, name).withColumn(name, F.arrow_udf(run, "array<int>")(F.col(text_col)))


def decode(df, model, ids_col="ids", name="decoded", most_chunks=MOST_CHUNKS):
    """The table with a column ``name``: the text of each row's ids (null ids: empty).

    With the same ``most_chunks`` as encode a worker uses one compiled model for both.
    """
    shared = _share(df, model)

    def run(ids):
        ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
        counts = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        out = pa.array(transducer(shared, most_chunks).decode(ids.flatten().to_numpy(zero_copy_only=False), counts), pa.string())
        release_memory()
        return out

    return without(df, name).withColumn(name, F.arrow_udf(run, "string")(F.col(ids_col)))


def ids_crc32(ids):
    """crc32 of each row's ids as little-endian unsigned 32-bit integers."""

    def run(ids):
        ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
        ends = np.concatenate(([0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        return pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.int64())

    return F.arrow_udf(run, "bigint")(ids)


def normalised(text):
    """What decoding gives back: the text with spaces for meta symbols."""
    return F.translate(F.coalesce(text, F.lit("")), META, " ")


def op5_sentence_pieces(spark, sf_dir):
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = decode(encode(documents(spark, sf_dir).select("doc_id", "text"), model), model)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        ids_crc32(F.col("ids")).alias("ids_crc32"),
        (F.col("decoded") == normalised(F.col("text"))).alias("round_trip"),
    )
