"""MinHash near-duplicate detection with odd sketches.

1. A text's shingles become a set of 64-bit hashes. Equal sets are one class, named by a 128-bit
   digest of the set; the graph's nodes are these classes, ids come in at the end.
2. SAMPLES MinHash values of a set; the first BANDS * ROWS are banded into bucket keys, and all of
   them are folded into an odd sketch: sample j with value v flips one of SKETCH_BITS bits. The
   population count of two sketches' XOR estimates how many samples differ, most precisely where
   few do.
3. Buckets first link in stars: each member is held against the bucket's pivot, its member with
   the most bucket mates (the middle of a group of copies). Pairs whose sketches and sizes allow
   the similarity are confirmed on their full sets.
4. A bucket whose members are then in one component is done. In the others, members of different
   components are compared in blocks: a block pair is one unit of work of at most 2 * BLOCK
   sketches, whatever the size of the bucket, and gives only pairs whose sketches and sizes allow
   the similarity, in the first bucket they share. Here a second odd sketch decides, of the set
   itself, with 8 to 16 bits a shingle: the population count of two XORs never exceeds the size of
   the symmetric difference, so it rejects no similar pair, and is close to it. What is left is
   confirmed on full sets, too. So every pair that shares a bucket is linked, or in one component,
   or known to be below the threshold.

A pair at the threshold shares no bucket with a chance of 3e-6 and fails the sketch test with
less; both shrink quickly above it. A group of copies takes work in proportion to its size. Where
many documents share buckets and yet stay apart (below the threshold), sketches meet in pairs;
only there does the work grow with the square, as numpy operations on blocks, not as rows.

Defined cases: texts without words have an empty set and are linked with nothing; rows with equal
ids and different texts are different nodes, each with its own links (two components may then have
the same smallest id; ``group`` tells them apart); null ids stay alone, with a null component; an
empty table has no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from shelfcast.llm.components import components
from shelfcast.llm.tables import ROWS_A_TASK, bounded_batches, documents, gathered, written
from shelfcast.llm.textops import LOWER, hash_spans, mix64, release_memory, slices, stream64, word_bounds

WIDTH = 5
PERCENT = 80
BANDS, ROWS = 32, 5
SAMPLES = 320
SKETCH_BITS = 1024
MOST_DIFFERENT = 172  # sketch bits; at 80 % similarity 113 are expected, with a deviation of 12
BLOCK = 1_024
MOST_BITS = 1 << 20  # of the bitmap of one set
PARITY_BYTES = 1 << 22  # of bitmaps that are compared together
SETS_A_TASK = 1_024
SORTED_AT_ONCE = 1 << 15  # hashes of pairs that are compared together
_SCALE = (stream64(SAMPLES, 21) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFT = (stream64(SAMPLES, 22) >> np.uint64(32)).astype(np.uint32)
_PLACE = stream64(SAMPLES, 23)


def shingle_sets(column, width):
    """For each text of an Arrow column the sorted distinct 64-bit hashes of its shingles.

    A shingle is ``width`` words, lower-cased (A-Z); fewer words make one shingle of all of them.
    """
    for _, _, data, offsets in slices(column):
        data = LOWER[data]
        starts, ends, first = word_bounds(data, offsets)
        words = hash_spans(data, starts, ends)
        room = max(0, len(words) - width + 1)
        with np.errstate(over="ignore"):
            rolled = np.zeros(room, np.uint64)
            for k in range(width):
                rolled += mix64(words[k : room + k] + np.uint64(k + 1))
            rolled = mix64(rolled)
            for a, b in zip(first[:-1], first[1:], strict=True):
                if b - a >= width:
                    yield np.unique(rolled[a : b - width + 1])
                elif b > a:
                    yield mix64(mix64(words[a:b] + np.arange(1, b - a + 1, dtype=np.uint64)).sum(keepdims=True) + np.uint64(b - a))
                else:
                    yield np.zeros(0, np.uint64)


def minhashes(shingles):
    """SAMPLES minima of a non-empty set under as many hash functions."""
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(high), 128):
        np.minimum(out, (high[at : at + 128, None] * _SCALE + _SHIFT).min(axis=0), out=out)
    return out


def band_keys(samples):
    with np.errstate(over="ignore"):
        mixed = mix64(samples[: BANDS * ROWS].astype(np.uint64) + _PLACE[: BANDS * ROWS]).reshape(BANDS, ROWS)
        return mix64(mixed.sum(axis=1) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def odd_sketch(samples):
    """Parity of how many samples fall on each bit, as 64-bit words."""
    places = (mix64(samples.astype(np.uint64) ^ _PLACE) >> np.uint64(32)) % np.uint64(SKETCH_BITS)
    odd = np.bincount(places.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _lists(arrays, kind):
    if not arrays:
        return pa.array([], pa.list_(kind))
    width = len(arrays[0])
    return pa.ListArray.from_arrays(pa.array(range(0, width * len(arrays) + 1, width), pa.int32()), pa.array(np.concatenate(arrays), kind))


def _signatures(column, width):
    sizes, prints, keys, sketches = [], [], [], []
    none = (np.zeros(BANDS, np.int64), np.zeros(SKETCH_BITS // 64, np.int64))
    for shingles in shingle_sets(column, width):
        sizes.append(len(shingles))
        prints.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
        samples = minhashes(shingles) if len(shingles) else None
        keys.append(band_keys(samples) if len(shingles) else none[0])
        sketches.append(odd_sketch(samples) if len(shingles) else none[1])
    release_memory()
    parts = [pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), _lists(keys, pa.int64()), _lists(sketches, pa.int64())]
    return pa.StructArray.from_arrays(parts, ["n", "print", "keys", "sketch"])


def _common(a, b):
    """Sizes of the intersections of two Arrow columns of sets."""
    out, size = np.zeros(len(a), np.int64), pc.add(pc.binary_length(a), pc.binary_length(b)).to_numpy(zero_copy_only=False) // 8
    at = 0
    while at < len(a):  # some pairs at once, sorted together by pair
        to = max(at + 1, at + int(np.searchsorted(np.cumsum(size[at:]), SORTED_AT_ONCE, "right")))
        both = np.frombuffer(b"".join(x.as_buffer() for i in range(at, to) for x in (a[i], b[i])), np.uint64)
        pair = np.repeat(np.arange(to - at), size[at:to])
        order = np.lexsort((both, pair)) if to > at + 1 else np.argsort(both)
        both, pair = both[order], pair[order]
        same = (both[1:] == both[:-1]) & (pair[1:] == pair[:-1])
        out[at:to] = np.bincount(pair[1:][same], minlength=to - at)
        at = to
    release_memory()
    return pa.array(out)


def _with_nodes(pairs, nodes, column):
    """Pairs (a, b) of prints with the nodes' n and another column, as n_a, n_b and x_a, x_b."""
    for end in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("print").alias(end), F.col("n").alias(f"n_{end}"), F.col(column).alias(f"x_{end}")), end)
    return pairs


def _linked(pairs, nodes, percent):
    """Those of the pairs (a, b) whose full sets reach the similarity."""
    both = F.arrow_udf(_common, "bigint")("x_a", "x_b")
    met = _with_nodes(pairs, nodes, "shingles").select("a", "b", "n_a", "n_b", both.alias("met"))
    return met.filter(F.lit(100) * F.col("met") >= percent * (F.col("n_a") + F.col("n_b") - F.col("met"))).select("a", "b")


def _possible(pairs, nodes, percent):
    """Those of the pairs whose sizes and sketches allow the similarity."""
    sized = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    bits = F.zip_with("x_a", "x_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    different = F.aggregate(bits, F.lit(0), lambda x, y: x + y)
    return _with_nodes(pairs, nodes, "sketch").filter(sized).filter(different <= MOST_DIFFERENT).select("a", "b")


def parity_bits(shingles):
    """Parity bitmap of a set, of 8 to 16 bits a shingle (a power of two, from 64 up to MOST_BITS)."""
    size = min(MOST_BITS, max(64, 1 << (8 * len(shingles) - 1).bit_length()))
    odd = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _differences(a, b):
    """Population counts of the XORs of parity bitmaps, pair by pair; the larger is folded to the smaller."""
    out, sizes = np.zeros(len(a), np.int64), np.array([[len(x), len(y)] for x, y in zip(a, b, strict=True)]).reshape(-1, 2)
    for one, other in np.unique(sizes, axis=0):
        pairs, least = np.flatnonzero((sizes == (one, other)).all(axis=1)), min(one, other)
        step = max(1, PARITY_BYTES // int(max(one, other)))
        for at in range(0, len(pairs), step):
            part = pairs[at : at + step]
            sides = [
                np.bitwise_xor.reduce(np.frombuffer(b"".join(side[i] for i in part), np.uint64).reshape(len(part), -1, least // 8), axis=1)
                for side in (a, b)
            ]
            out[part] = np.bitwise_count(sides[0] ^ sides[1]).sum(axis=1)
    return out


def _block_pairs(left, right, same, key, percent):
    """Indices of the pairs of two blocks that are in different components and may be similar."""
    most = np.uint16(MOST_DIFFERENT)
    different = np.zeros((len(left["n"]), len(right["n"])), np.uint16)
    for word in range(SKETCH_BITS // 64):
        different += np.bitwise_count(left["sketch"][:, None, word] ^ right["sketch"][None, :, word])
    small = np.minimum(left["n"][:, None], right["n"][None, :])
    large = np.maximum(left["n"][:, None], right["n"][None, :])
    may = (different <= most) & (100 * small >= percent * large) & (left["root"][:, None] != right["root"][None, :])
    if same:
        may = np.triu(may, 1)
    i, j = np.nonzero(may)
    shared = left["keys"][i] == right["keys"][j]
    first = left["keys"][i, shared.argmax(axis=1)] if len(i) else np.zeros(0, np.int64)
    i, j = i[first == key], j[first == key]
    if len(i):  # 100 * both >= percent * (both + different), and both = (n_i + n_j - different) / 2
        different = _differences([left["parity"][k] for k in i], [right["parity"][k] for k in j])
        near = (100 - percent) * (left["n"][i] + right["n"][j]) >= (100 + percent) * different
        i, j = i[near], j[near]
    return i, j


def _compare_blocks(percent):
    """For rows sorted by (key, x, y): the pairs of each block pair, as (a, b)."""

    def pairs_of(table):
        key, x, y = (table[c][0].as_py() for c in ("key", "x", "y"))
        block = table["block"].to_numpy()
        first, second = np.flatnonzero(block == x), np.flatnonzero(block == y)
        columns = {
            "n": table["n"].to_numpy(),
            "root": table["place"].to_numpy(),
            "keys": table["keys"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS),
            # unsigned: numpy counts the bits of a negative number's absolute value
            "sketch": table["sketch"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH_BITS // 64),
        }
        left, right = ({name: c[rows] for name, c in columns.items()} for rows in (first, second))
        parity = table["parity"].to_pylist()
        prints = table["print"].combine_chunks()
        left, right = ({**c, "parity": [parity[k] for k in rows]} for c, rows in ((left, first), (right, second)))
        i, j = _block_pairs(left, right, x == y, key, percent)
        return pa.RecordBatch.from_arrays([prints.take(pa.array(first[i])), prints.take(pa.array(second[j]))], ["a", "b"])

    def run(batches):
        waiting = None  # rows of the last block pair, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if waiting is not None:
                table = pa.concat_tables([waiting, table])
            marks = np.stack([table[c].to_numpy() for c in ("key", "x", "y")])
            changes = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            starts = np.concatenate(([0], changes))
            for at, to in zip(starts[:-1], starts[1:], strict=True):
                yield pairs_of(table.slice(at, to - at))
            waiting = table.slice(starts[-1])
        if waiting is not None:
            yield pairs_of(waiting)
        release_memory()

    return run


def signatures(df, id_col="doc_id", text_col="text", width=WIDTH):
    """(id, digest, n, print, keys, sketch) of every row; the digest is of the text as it is."""
    bounded_batches(df.sparkSession)
    kind = "struct<n: bigint, print: binary, keys: array<bigint>, sketch: array<bigint>>"
    sign = F.arrow_udf(lambda t: _signatures(t, width), kind)
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), sign(F.col(text_col)).alias("s"))
    return rows.select("id", "digest", "s.n", "s.print", "s.keys", "s.sketch")


def _prints_and_sets(width):
    def run(column):
        prints, sets, parity = [], [], []
        for shingles in shingle_sets(column, width):
            sets.append(shingles.tobytes())
            parity.append(parity_bits(shingles))
            prints.append(hashlib.blake2b(sets[-1], digest_size=16).digest())
        release_memory()
        return pa.StructArray.from_arrays([pa.array(c, pa.binary()) for c in (prints, sets, parity)], ["print", "shingles", "parity"])

    return F.arrow_udf(run, "struct<print: binary, shingles: binary, parity: binary>")


def groups(df, id_col="doc_id", text_col="text", width=WIDTH, percent=PERCENT):
    """For each row its id, digest, n_shingles, class_id (smallest id with an equal set), component_id and group.

    ``group`` names the component (null: linked with nothing); ``digest`` is xxhash64 of the text.
    """
    signed = written(signatures(df, id_col, text_col, width), "signatures")
    rows = signed.count()
    values = [F.any_value(c).alias(c) for c in ("n", "keys", "sketch")]  # equal in all rows of a print
    heads = signed.filter("n > 0 AND id IS NOT NULL").groupBy("print").agg(F.min("id").alias("class_id"), *values)
    heads = written(gathered(heads, rows), "heads")
    # buckets of two and more
    all_keys = written(heads.select("print", F.explode("keys").alias("key")), "buckets")
    counted = all_keys.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    sets_in_all = heads.count()
    members = written(gathered(all_keys.join(counted, "key"), BANDS * sets_in_all, BANDS * ROWS_A_TASK), "members")
    mates = written(gathered(members.groupBy("print").agg(F.sum("m").alias("mates")), sets_in_all), "mates")
    with_mates = mates.count()
    some = heads.join(mates, "print").select("class_id").distinct()
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = texts.join(some, F.col("id") == F.col("class_id"), "left_semi")
    sets = texts.select(_prints_and_sets(width)("text").alias("s")).select("s.*")
    sets = sets.groupBy("print").agg(F.any_value("shingles").alias("shingles"), F.any_value("parity").alias("parity"))
    nodes = gathered(heads.select("print", "n", "keys", "sketch").join(sets, "print"), with_mates, SETS_A_TASK)
    nodes = written(nodes, "nodes")
    # stars
    ranked = members.join(mates, "print")
    pivots = ranked.groupBy("key").agg(F.min(F.struct((-F.col("mates")).alias("few"), "print"))["print"].alias("pivot"))
    stars = members.join(pivots, "key").filter("print <> pivot").select(F.col("pivot").alias("a"), F.col("print").alias("b"))
    roots = components(_linked(_possible(stars.distinct(), nodes, percent), nodes, percent), with_mates)
    # what is left: buckets with several components
    named = members.join(roots.withColumnRenamed("id", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    mixed = named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("key")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    named = named.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("print"), blocks).cast("int"))
    others = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    units = named.select("key", "print", F.xxhash64("root").alias("place"), "block", others)
    units = units.select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "place", "print")
    units = units.join(nodes.select("print", "n", "keys", "sketch", "parity"), "print")
    units = units.select("key", "x", "y", "block", "place", "print", "n", "keys", "sketch", "parity")
    units = units.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    rest = units.mapInArrow(_compare_blocks(percent), "a binary, b binary")
    more = _linked(rest, nodes, percent)
    for end in ("a", "b"):  # links of the components so far, whose root is their smallest print
        root = roots.select(F.col("id").alias(end), F.col("root").alias("to"))
        more = more.join(root, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    further = components(more, with_mates).select(F.col("id").alias("root"), F.col("root").alias("further"))
    # ids: the smallest of a component, by way of one row for each class
    placed = heads.select("print", "class_id").join(roots.withColumnRenamed("id", "print"), "print", "left")
    placed = placed.withColumn("root", F.coalesce("root", "print")).join(further, "root", "left")
    placed = placed.select("print", "class_id", F.coalesce("further", "root").alias("group"))
    firsts = placed.groupBy("group").agg(F.min("class_id").alias("component_id"))
    placed = written(gathered(placed.join(firsts, "group"), rows), "components")
    found = gathered(signed.select("id", "digest", "n", "print").join(placed, "print", "left"), rows)
    alone, named = F.col("n") == 0, F.col("id").isNotNull()
    return found.select(
        "id",
        "digest",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("id")).when(named, F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("id")).when(named, F.col("component_id")).alias("component_id"),
        F.when(named, F.col("group")).alias("group"),
    )


def op4_near_dups(spark, sf_dir):
    found = groups(documents(spark, sf_dir), width=2)
    kept = (F.col("id") == F.col("component_id")).alias("kept")
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", kept, "class_id")
