"""Vectorised text primitives over Arrow batches, shared by the operators of this package.

All of them work on the UTF-8 bytes of whole texts. A word is a run of bytes other than the six
ASCII white space characters (0x20, 0x09-0x0D); no other byte is white space, so cutting at bytes
is cutting at characters.
"""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD_RE = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 19


def mix64(x):
    """SplitMix64's finaliser: spreads 64-bit values."""
    x = np.asarray(x, np.uint64).copy()
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def stream64(n, seed):
    """n pseudo-random 64-bit values; longer streams extend shorter ones."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


def utf8(column):
    """An Arrow string or binary array as (bytes, offsets); null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column, most=SLICE_BYTES):
    """(first row, last row + 1, bytes, offsets): consecutive rows of at most ``most`` bytes.

    A longer text is a slice of its own, so working memory follows the longest text, not the batch.
    """
    data, offsets = utf8(column)
    at, rows = 0, len(offsets) - 1
    while at < rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_bounds(data, offsets, space=None):
    """(starts, ends, first): byte bounds of words; row r has words first[r] to first[r + 1]."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~(SPACE[data] if space is None else space)
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    edges = offsets[offsets < len(data)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[offsets[offsets > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_LANE = stream64(1 << 10, 1)
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def hash_spans(data, starts, ends):
    """A 64-bit hash of each span of bytes: mixed sums of its 8-byte lanes and its length."""
    lengths = ends - starts
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    lanes = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(data) + 1,), (1,))
    total = lengths.astype(np.uint64)
    todo = np.arange(len(starts))
    with np.errstate(over="ignore"):
        for k in range(int(lengths.max(initial=0) + 7) // 8):
            if k and len(todo) < 8:
                break
            todo = todo[lengths[todo] > 8 * k] if k else todo
            part = lanes[starts[todo] + 8 * k] & _MASKS[np.minimum(lengths[todo] - 8 * k, 8)]
            total[todo] += mix64(part + _lane(k, k + 1)[0])
        else:
            return mix64(total)
        for i in todo:  # a few long ones are left
            rest = int(lengths[i]) - 8 * k
            if rest > 0:
                part = lanes[starts[i] + 8 * k : ends[i] : 8].copy()
                part[-1] &= _MASKS[(rest - 1) % 8 + 1]
                total[i] += mix64(part + _lane(k, k + len(part))).sum()
    return mix64(total)


def _lane(at, to):
    """Constants of the lanes from ``at`` to ``to``."""
    return _LANE[at:to] if to <= len(_LANE) else stream64(to, 1)[at:]


def per_row(values, first):
    """Sums of ``values`` for each row, of the run first[r] to first[r + 1]; an empty run is 0."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[first[1:]] - total[first[:-1]]


def repeat_rows(first):
    """The row of each element, from the bounds of the rows."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


_kept = {}  # what this process keeps between tasks: by name, the stage that used it last and what lets go of it


def _stage():
    from pyspark import TaskContext

    task = TaskContext.get()
    return task.stageId() if task else None


def keep(name, forget):
    """Something is kept between the tasks of a stage; ``forget`` lets go of it when another stage has the worker."""
    _kept[name] = _stage(), forget


def release_memory():
    """Gives memory back to the system, and what other stages kept: a worker, or the driver, goes on with other work."""
    now = _stage()
    others = [n for n, (stage, _) in _kept.items() if stage != now]
    for name in others:
        _kept.pop(name)[1]()
    if others:
        gc.collect()  # what is kept may hold itself
        pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def crc_mod(column, modulus):
    """crc32 of the column as text, modulo ``modulus``; null counts as empty text."""
    from pyspark.sql import functions as F

    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
