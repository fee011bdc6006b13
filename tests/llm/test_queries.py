import duckdb
import pytest

from shelfcast.llm.queries import ORACLES, QUERIES

from .conftest import SF

COLUMNS = {
    "op1_": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2_": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op3_": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op4_": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op5_": {"doc_id": "bigint", "n_tokens": "bigint", "round_trip": "boolean"},
    "op6_": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op7_": {"doc_id": "bigint", "shard": "string", "depth": "int"},
    "op8_": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op9_": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op10_": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op11_": {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"},
    "op12_": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op13_": {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"},
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_rows_and_sql(spark, name):
    df = QUERIES[name](spark, SF)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = next(v for k, v in COLUMNS.items() if name.startswith(k))
    assert {k: types.get(k) for k in want} == want
    rows = df.collect()
    if name not in ORACLES:
        assert len(rows) == {"op3_url_filter": 50, "op11_whitening": 500 * 16}.get(name, 200)
        return
    con = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    order = [names.index(c) for c in df.columns]
    assert sorted(tuple(r) for r in rows) == sorted(tuple(r[i] for i in order) for r in result.fetchall())
