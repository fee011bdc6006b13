"""Token-ID output as wavelet matrices: one succinct, compressed file per shard.

Documents are range-partitioned and sorted by id, tokenised in their tasks and cut into shards of
MOST_TOKENS. A shard's ids, each document followed by the end id, become a wavelet matrix: one bit
plane per bit of the largest id, from the highest. A plane is cut into blocks of BLOCK_BITS, each
compressed on its own, beside a directory of the ones before each block. So one file gives

* ``access(i)`` the token at a position,
* ``count(token, lo, hi)`` its occurrences in a range (rank),
* ``locate(token, n)`` the position of its n-th occurrence (select),

each from one block a plane, and ``decode()`` all ids. Files are written by Spark's own writer
(one record each), so that failed and repeated tasks leave no parts behind, in any file system.

File: the magic, eight little-endian 64-bit numbers (length of the body, part, number in the part,
tokens, documents, planes, end id, 0), then the body of sections, each with its length: document ids, marks of null
ids, tokens by document, zeros by plane, then for each plane the block ends, the ones before each
block, and the blocks. The last byte is the writer's line feed.

Tokenising uses the tokenizers library. The byte-level pre-tokeniser always cuts where white space
follows a character that is none, and where a mark follows a letter, so texts are cut there and a
worker encodes each distinct chunk once; texts with unusual white space are encoded whole.

Defined cases: a null text is empty and holds the end id only; rows with equal ids stay, ordered by
text; null ids come first; an empty table gives no files and no rows.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.llm.chunks import ChunkEncoder
from shelfcast.llm.tables import bounded_batches, documents, written
from shelfcast.session import shared_dir

MOST_TOKENS = 4 << 20
BLOCK_BITS = 1 << 16
END_ID = 2
MAGIC = b"WAVELET1"
ODD_SPACE = re.compile(r"[^\S \t\n\r]")
OTHER, BLANK, LETTER, MARK = range(4)
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t\n\r")] = BLANK
KIND[[*range(65, 91), *range(97, 123)]] = LETTER
KIND[list(b".,;:!?")] = MARK


def plane_count(ids):
    return max(1, int(ids.max(initial=0)).bit_length())


def build_planes(ids, planes):
    """The wavelet matrix: for each plane its bits in the order that the planes above leave."""
    kind = np.uint16 if planes <= 16 else np.uint32
    out, zeros, now = [], [], np.asarray(ids).astype(kind)
    for level in range(planes - 1, -1, -1):
        bits = now & kind(1 << level) != 0
        out.append(np.packbits(bits, bitorder="little"))
        zeros.append(int(len(now) - np.count_nonzero(bits)))
        now = np.concatenate((np.compress(~bits, now), np.compress(bits, now)))
    return out, zeros


def _section(data):
    return len(data).to_bytes(8, "little") + data


def encode_file(ids, doc_ids, nulls, lengths, part=0, number=0, end_id=END_ID):
    """The bytes of a shard's file."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    count = plane_count(ids)
    planes, zeros = build_planes(ids, count)
    body = [
        _section(squeeze(np.asarray(doc_ids, "<i8").tobytes())),
        _section(squeeze(np.asarray(nulls, np.uint8).tobytes())),
        _section(squeeze(np.asarray(lengths, "<i8").tobytes())),
        _section(np.asarray(zeros, "<i8").tobytes()),
    ]
    step = BLOCK_BITS // 8
    for plane in planes:
        blocks, ends, before, ones = [], [], [0], 0
        for at in range(0, len(plane), step):
            block = plane[at : at + step]
            blocks.append(squeeze(block.tobytes()))
            ones += int(np.bitwise_count(block).sum())
            ends.append(len(blocks[-1]) + (ends[-1] if ends else 0))
            before.append(ones)
        body += [_section(np.asarray(ends, "<i8").tobytes()), _section(np.asarray(before, "<i8").tobytes()), _section(b"".join(blocks))]
    body = b"".join(body)
    head = np.array([len(body), part, number, len(ids), len(doc_ids), count, end_id, 0], "<i8")
    return MAGIC + head.tobytes() + body


class WaveletFile:
    """Reads a shard's file; blocks are decompressed as they are needed."""

    def __init__(self, data):
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a wavelet file")
        at = len(MAGIC) + 64
        size, self.part, self.number, self.tokens, self.documents, self.planes, self.end_id, _ = (
            int(x) for x in np.frombuffer(data, "<i8", 8, len(MAGIC))
        )
        if len(data) < at + size:
            raise ValueError("the file is cut short")
        self._data, self._at = data, at
        self._unpack = zstandard.ZstdDecompressor().decompress
        self.doc_ids = np.frombuffer(self._unpack(self._next()), "<i8")
        self.nulls = np.frombuffer(self._unpack(self._next()), np.uint8) != 0
        self.lengths = np.frombuffer(self._unpack(self._next()), "<i8")
        self.zeros = np.frombuffer(self._next(), "<i8")
        self._levels = []
        for _ in range(self.planes):
            ends, before = np.frombuffer(self._next(), "<i8"), np.frombuffer(self._next(), "<i8")
            self._levels.append((ends, before, self._next()))

    def _next(self):
        size = int.from_bytes(self._data[self._at : self._at + 8], "little")
        self._at += 8 + size
        return memoryview(self._data)[self._at - size : self._at]

    def _bits(self, level, block):
        ends, _, blocks = self._levels[level]
        packed = self._unpack(blocks[int(ends[block - 1]) if block else 0 : int(ends[block])])
        return np.frombuffer(packed, np.uint8)

    def _ones(self, level, i):
        """Ones before position i of a plane."""
        block, inside = divmod(int(i), BLOCK_BITS)
        before = self._levels[level][1]
        if not inside:
            return int(before[block])
        bits = self._bits(level, block)
        whole, rest = divmod(inside, 8)
        tail = int(bits[whole]) & ((1 << rest) - 1) if rest else 0
        return int(before[block]) + int(np.bitwise_count(bits[:whole]).sum()) + tail.bit_count()

    def _bit(self, level, i):
        block, inside = divmod(int(i), BLOCK_BITS)
        return (int(self._bits(level, block)[inside // 8]) >> (inside % 8)) & 1

    def _select(self, level, bit, n):
        """Position of the n-th (from 0) bit of this value in a plane."""
        before = self._levels[level][1]
        counts = before if bit else np.minimum(np.arange(len(before)) * BLOCK_BITS, self.tokens) - before
        block = int(np.searchsorted(counts, n, "right")) - 1
        bits = np.unpackbits(self._bits(level, block), bitorder="little")
        return block * BLOCK_BITS + int(np.flatnonzero(bits == bit)[n - int(counts[block])])

    def access(self, i):
        """The token at position i."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        token = 0
        for level in range(self.planes):
            bit, ones = self._bit(level, i), self._ones(level, i)
            token = token << 1 | bit
            i = int(self.zeros[level]) + ones if bit else i - ones
        return token

    def _range(self, token, lo, hi):
        for level in range(self.planes):
            if lo >= hi:
                break
            a, b = self._ones(level, lo), self._ones(level, hi)
            if token >> (self.planes - 1 - level) & 1:
                lo, hi = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token, lo=0, hi=None):
        """Occurrences of a token in positions lo to hi."""
        hi = self.tokens if hi is None else min(hi, self.tokens)
        if token < 0 or token >> self.planes or lo >= hi:
            return 0
        lo, hi = self._range(token, max(0, lo), hi)
        return max(0, hi - lo)

    def locate(self, token, n):
        """Position of the n-th (from 0) occurrence of a token; None if there are fewer."""
        if n < 0 or n >= self.count(token):
            return None
        i = self._range(token, 0, self.tokens)[0] + n
        for level in range(self.planes - 1, -1, -1):
            bit = token >> (self.planes - 1 - level) & 1
            i = self._select(level, bit, i - int(self.zeros[level]) if bit else i)
        return i

    def decode(self):
        """All ids: planes are undone from the lowest."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        now = np.zeros(self.tokens, kind)
        for level in range(self.planes - 1, -1, -1):
            zero, one = 0, int(self.zeros[level])
            now[one:] |= kind(1 << (self.planes - 1 - level))
            out = np.empty_like(now)
            for block in range(len(self._levels[level][0])):
                part = out[block * BLOCK_BITS : (block + 1) * BLOCK_BITS]
                bits = np.unpackbits(self._bits(level, block), count=len(part), bitorder="little").view(bool)
                ones = np.flatnonzero(bits)
                part[np.flatnonzero(~bits)] = now[zero : zero + len(part) - len(ones)]
                part[ones] = now[one : one + len(ones)]
                zero, one = zero + len(part) - len(ones), one + len(ones)
            now = out
        return now.astype(np.uint32)


def chunk_begins(data, offsets):
    """Where chunks begin: white space after none, and marks after letters."""
    kind, out = KIND[data], np.zeros(len(data), bool)
    now, earlier = kind[1:], kind[:-1]
    out[1:] = (now == BLANK) & (earlier != BLANK) | (now == MARK) & (earlier == LETTER)
    return out


def chunk_encoder(definition):
    """An encoder of a tokenizers definition (JSON), by chunks."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)

    def learn(chunks):
        return [e.ids for e in tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def whole(text):
        return tokenizer.encode(text, add_special_tokens=False).ids

    return ChunkEncoder(chunk_begins, learn, lambda c: ODD_SPACE.search(c) is not None, whole)


_encoders: dict[int, ChunkEncoder] = {}


def _encoder(definition):
    """The task's worker keeps one encoder, with what it has learnt."""
    key = hash(definition)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = chunk_encoder(definition)
    return _encoders[key]


def _with_ends(ids, counts, end_id):
    """The ids with ``end_id`` after each text."""
    ends = np.cumsum(counts + 1)
    out = np.empty(len(ids) + len(counts), np.uint32)
    last = np.zeros(len(out), bool)
    last[ends - 1] = True
    out[last], out[~last] = end_id, ids
    return out, counts + 1


def _gathered(batches, least=8 << 20):
    """The batches, joined to tables of at least so many bytes: more of their chunks are the same."""
    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += batch.nbytes
        if size >= least:
            yield pa.Table.from_batches(waiting)
            waiting, size = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def _shards(definition, end_id, most_tokens):
    """Files of the sorted documents of a partition."""

    def run(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        ids, lengths, docs, size = [], [], [], 0

        def close():
            doc_ids = pa.array(docs, pa.int64())
            flat = doc_ids.fill_null(0).to_numpy()
            data = encode_file(np.concatenate(ids), flat, doc_ids.is_null().to_numpy(False), lengths, part, number, end_id)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["content"])

        for batch in _gathered(batches):
            names = batch.column(0).to_pylist()
            for at, flat, counts in _encoder(definition.value).parts(batch.column(1)):
                flat, counts = _with_ends(flat, counts, end_id)
                bounds = np.concatenate(([0], np.cumsum(counts)))
                first = 0
                while first < len(counts):
                    # as many documents as fit; at least one in an empty shard
                    room = bounds[first] + most_tokens - size
                    to = int(np.searchsorted(bounds, room, "right")) - 1
                    to = max(to, first + 1 if not size else first)
                    if to > first:
                        ids.append(flat[bounds[first] : bounds[to]])
                        lengths.extend(counts[first:to].tolist())
                        docs.extend(names[at + first : at + to])
                        size += int(bounds[to] - bounds[first])
                        first = to
                    if first < len(counts):
                        yield close()
                        number += 1
                        ids, lengths, docs, size = [], [], [], 0
        if docs:
            yield close()

    return run


def write_tokens(df, path, tokenizer, id_col="doc_id", text_col="text", end_id=END_ID, most_tokens=MOST_TOKENS):
    """Writes the files of all documents, in ascending order of their ids, to ``path``.

    ``tokenizer`` is the path of a tokenizers file with a byte-level pre-tokeniser; the driver reads it.
    """
    bounded_batches(df.sparkSession)
    with open(tokenizer, encoding="utf-8") as file:
        definition = df.sparkSession.sparkContext.broadcast(file.read())
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text").alias("tie")
    rows = rows.select("id", "text", tie).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    files = rows.mapInArrow(_shards(definition, end_id, most_tokens), "content binary")
    files.select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


def _digests(batches):
    for batch in batches:
        for content in batch.column(0):
            file = WaveletFile(content.as_py())
            ids = file.decode().astype("<u4")
            bounds = np.concatenate(([0], np.cumsum(file.lengths)))
            sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            n = len(sums)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, file.part)),
                    pa.array(np.full(n, file.number)),
                    pa.array(file.doc_ids, mask=file.nulls),
                    pa.array(bounds[:-1]),
                    pa.array(file.lengths),
                    pa.array(sums, pa.int64()),
                ],
                ["part", "number", "doc_id", "at", "n_tokens", "ids_crc32"],
            )


def token_files(spark, path):
    """The files below ``path``, one binary row each; none if there are none."""
    return spark.read.format("binaryFile").load(path).filter(F.col("length") > len(MAGIC)).select("content")


def read_digests(spark, path):
    """For each document in the files: doc_id, start, n_tokens, ids_crc32.

    Starts are distributed prefix sums: within a file, over the files of a part, over the parts.
    """
    kind = "part bigint, number bigint, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint"
    rows = written(token_files(spark, path).mapInArrow(_digests, kind), "digests")
    files = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("n"))
    earlier = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    in_part = files.withColumn("file_at", F.coalesce(F.sum("n").over(earlier("part", "number")), F.lit(0)))
    parts = files.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier("part")), F.lit(0)).alias("part_at"))
    starts = in_part.join(parts, "part").select("part", "number", (F.col("file_at") + F.col("part_at")).alias("base"))
    placed = rows.join(starts, ["part", "number"])
    return placed.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op2_token_files(spark, sf_dir):
    import public_tokenizers

    path = shared_dir(spark, "tokens")
    write_tokens(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_digests(spark, path)
