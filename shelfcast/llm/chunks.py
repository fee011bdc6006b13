"""Encoding of texts by way of their distinct chunks."""

from __future__ import annotations

from itertools import chain, repeat

import numpy as np
import pyarrow as pa

from shelfcast.llm.textops import slices

MOST_CHUNKS = 1_200_000
LEARNT_AT_ONCE = 10_000
SLICE_BYTES = 8 << 20


class ChunkEncoder:
    """Ids of texts that can be cut into chunks which encode independently.

    ``begins`` marks the bytes of a slice at which a chunk begins (each text begins one anyway),
    ``learn`` gives the ids of each of a list of chunks. A text with a chunk that is ``odd`` is
    encoded by ``whole``. What was learnt is kept, and cleared when it exceeds ``most`` chunks; ids
    do not depend on it.
    """

    def __init__(self, begins, learn, odd=None, whole=None, most=MOST_CHUNKS, slice_bytes=SLICE_BYTES):
        self._slice_bytes = slice_bytes
        self._begins, self._learn_ids, self._odd, self._whole, self._most = begins, learn, odd, whole, most
        self._clear()

    def _clear(self):
        self._place, self._ids, self._used = {}, np.zeros(1 << 16, np.uint32), 0
        self._start, self._length = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)

    def _learn(self, chunks):
        texts = [c.decode() for c in chunks]
        lists = self._learn_ids(texts)
        flat = np.fromiter(chain.from_iterable(lists), np.uint32)
        base, n = len(self._place), len(lists)
        while self._used + len(flat) > len(self._ids):
            self._ids = np.concatenate((self._ids, np.zeros_like(self._ids)))
        while base + n > len(self._start):
            self._start, self._length = (np.concatenate((x, np.zeros_like(x))) for x in (self._start, self._length))
        self._ids[self._used : self._used + len(flat)] = flat
        lengths = np.fromiter(map(len, lists), np.int64, n)
        self._start[base : base + n] = self._used + np.concatenate(([0], np.cumsum(lengths)[:-1]))
        self._length[base : base + n] = lengths
        if self._odd is not None:
            self._length[base : base + n][np.fromiter(map(self._odd, texts), bool, n)] = -1
        self._place.update(zip(chunks, range(base, base + n), strict=True))
        self._used += len(flat)

    def _slice(self, data, offsets):
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        if len(self._place) > self._most:
            self._clear()
        begins = self._begins(data, offsets)
        begins[offsets[offsets < len(data)]] = True
        at = np.flatnonzero(begins)
        ends = pa.py_buffer(np.append(at, len(data)).astype(np.int32))
        chunks = pa.Array.from_buffers(pa.binary(), len(at), [None, ends, pa.py_buffer(np.ascontiguousarray(data))])
        coded = chunks.dictionary_encode()
        kinds = coded.dictionary.to_pylist()
        places = np.fromiter(map(self._place.get, kinds, repeat(-1)), np.int64, len(kinds))
        new = np.flatnonzero(places < 0)
        places[new] = len(self._place) + np.arange(len(new))
        for k in range(0, len(new), LEARNT_AT_ONCE):
            self._learn([kinds[i] for i in new[k : k + LEARNT_AT_ONCE]])
        places = places[coded.indices.to_numpy()]
        lengths, starts = self._length[places], self._start[places]
        bounds = np.searchsorted(at, offsets)
        whole = {int(np.searchsorted(bounds, i, "right")) - 1 for i in np.flatnonzero(lengths < 0)}
        if whole:
            lengths = np.maximum(lengths, 0)
        ends = np.cumsum(lengths, dtype=np.int64)
        from_place = (starts - (ends - lengths)).astype(np.int32)
        ids = self._ids[np.repeat(from_place, lengths) + np.arange(ends[-1], dtype=np.int32)]
        sums = np.concatenate(([0], ends))[bounds]
        if not whole:
            return ids, np.diff(sums)
        texts = {k: data[offsets[k] : offsets[k + 1]].tobytes().decode() for k in whole}
        parts = [np.array(self._whole(texts[k]), np.uint32) if k in whole else ids[sums[k] : sums[k + 1]] for k in range(len(offsets) - 1)]
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def parts(self, column):
        """(first row, ids, number of ids of each row) of consecutive rows of an Arrow column; null is empty."""
        for at, _, data, offsets in slices(column, self._slice_bytes):
            yield at, *self._slice(data, offsets)

    def encode(self, texts):
        """(ids of all texts, number of ids of each) of a list."""
        parts = list(self.parts(pa.array(texts, pa.string())))
        none = (0, np.zeros(0, np.uint32), np.zeros(0, np.int64))
        return tuple(np.concatenate([p[k] for p in [none, *parts]]) for k in (1, 2))
