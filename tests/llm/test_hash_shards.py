import hashlib

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import hash_shards as H


def brute(rows, limit):
    """Splits buckets bit by bit until they fit."""
    bits = {i: bin(int(hashlib.md5(str(i).encode()).hexdigest(), 16))[2:].zfill(128) for i, _ in rows}
    out, todo = {}, [("", rows)]
    while todo:
        prefix, bucket = todo.pop()
        if sum(n for _, n in bucket) <= limit or len(bucket) == 1:
            out.update({i: (prefix, sum(n for _, n in bucket)) for i, _ in bucket})
            continue
        for bit in "01":
            todo.append((prefix + bit, [r for r in bucket if bits[r[0]][len(prefix)] == bit]))
    return out


@pytest.mark.parametrize("limit", [1 << 30, 60_000, 9_000, 700])
def test_splits_as_bit_by_bit(docs, limit):
    got = H.assign(docs, limit=limit).collect()
    want = brute([(r["doc_id"], len(r["text"].encode())) for r in docs.collect()], limit)
    assert {r["doc_id"]: (r["shard"], r["shard_bytes"]) for r in got} == want
    assert all(r["depth"] == len(r["shard"]) for r in got)


def test_equal_ids_and_equal_rows_split_too(spark):
    one_id = spark.range(300).selectExpr("7L AS doc_id", "repeat(cast(id % 3 AS string), 50) AS text")
    got = H.assign(one_id, limit=1_000).collect()
    sizes = {}
    for r in got:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["n_bytes"]
    assert len(got) == 300 and max(sizes.values()) <= 1_000
    assert all(r["shard_bytes"] == sizes[r["shard"]] for r in got)


def test_odd_rows_and_writing(spark, odd_docs, no_docs, tmp_path):
    assigned = H.assign(odd_docs, limit=90_000)
    rows = assigned.collect()
    assert len(rows) == odd_docs.count() and "level" in assigned.columns
    for shard in {r["shard"] for r in rows}:
        own = [r for r in rows if r["shard"] == shard]
        assert sum(r["n_bytes"] for r in own) <= 90_000 or len(own) == 1
    H.write_shards(assigned, f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.count() == len(rows)
    assert back.select("shard").distinct().count() == len({r["shard"] for r in rows})
    assert H.assign(no_docs).collect() == []


def test_native(docs):
    plan = H.assign(docs, limit=9_000).agg(F.max("depth"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_shards_hold_what_they_were_given(spark, docs, tmp_path):
    path = str(tmp_path / "shards")
    assigned = H.assign(docs, limit=60_000)
    H.write_shards(assigned.drop("n_bytes", "depth", "shard_bytes"), path)
    back = H.read_shards(spark, path)
    columns = ["doc_id", "text", "lang", "source", "n_chars", *H.ADDED]
    assert sorted(map(tuple, back.select(*columns).collect())) == sorted(map(tuple, assigned.select(*columns).collect()))
    assert len({r["depth"] for r in back.select("depth").distinct().collect()}) > 1
