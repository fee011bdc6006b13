import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfcast.llm import token_files as T

MODEL = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(MODEL)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=300))
def test_wavelet_round_trip(ids):
    ids = np.array(ids, np.uint32)
    file = T.WaveletFile(T.encode_file(ids, [5], [0], [len(ids)], 2, 3))
    assert (file.decode() == ids).all() and (file.part, file.number, file.tokens) == (2, 3, len(ids))
    for token in {*ids.tolist()[:20], 0, 99, 1 << 20}:
        at = np.flatnonzero(ids == token)
        assert file.count(token) == len(at) and file.count(token, 3, 40) == (ids[3:40] == token).sum()
        assert [file.locate(token, n) for n in range(len(at))] == at.tolist() and file.locate(token, len(at)) is None
    assert [file.access(i) for i in range(len(ids))] == ids.tolist()


def test_wavelet_across_blocks():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 50_257, 3 * T.BLOCK_BITS + 11).astype(np.uint32)
    ids[rng.random(len(ids)) < 0.4] = 13
    file = T.WaveletFile(T.encode_file(ids, [1], [0], [len(ids)]))
    assert (file.decode() == ids).all()
    for i in (0, T.BLOCK_BITS - 1, T.BLOCK_BITS, 2 * T.BLOCK_BITS + 5, len(ids) - 1):
        assert file.access(i) == ids[i]
    at = np.flatnonzero(ids == 13)
    for n in (0, 1, len(at) // 2, len(at) - 1):
        assert file.locate(13, n) == at[n]
    assert file.count(13, 70_000, 150_001) == (ids[70_000:150_001] == 13).sum()
    with pytest.raises(IndexError):
        file.access(len(ids))
    with pytest.raises(ValueError):
        T.WaveletFile(T.encode_file(ids, [1], [0], [len(ids)])[:-9])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab'st é日1.\n\t \x0b\x85\u00a0\u2003\x1c", max_size=25), max_size=6))
def test_chunks_encode_as_whole_texts(texts):
    encoder = T._encoder(open(MODEL).read())
    library = Tokenizer.from_file(MODEL) if not hasattr(T, "_library") else T._library
    T._library = library
    ids, counts = encoder.encode(texts)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_special_strings(library):
    texts = ["<|endoftext|>", "a  <|endoftext|> b<|endoftext|>", " <|endoftext|>\n"]
    ids, counts = T._encoder(open(MODEL).read()).encode(texts)
    assert ids.tolist() == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids] and len(counts) == 3


def expected(library, rows):
    at, out = 0, []
    for i, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("most", [T.MOST_TOKENS, 5_000, 300])
def test_files_of_the_table(spark, docs, library, tmp_path, most):
    path = f"{tmp_path}/tokens"
    T.write_tokens(docs.repartition(4), path, MODEL, most_tokens=most)
    got = sorted(tuple(r) for r in T.read_digests(spark, path).collect())
    assert got == expected(library, sorted((r["doc_id"], r["text"]) for r in docs.collect()))
    sizes = [T.WaveletFile(r["content"]).tokens for r in T.token_files(spark, path).collect()]
    assert sum(sizes) == sum(r[2] for r in got)
    longest = max(r[2] for r in got)
    assert max(sizes) <= max(most, longest)


def test_odd_rows(spark, odd_docs, no_docs, library, tmp_path):
    T.write_tokens(odd_docs, f"{tmp_path}/odd", MODEL, most_tokens=50)
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"]) for r in T.read_digests(spark, f"{tmp_path}/odd").collect()))
    assert [r[1] for r in got] == [None, None, 1, 2, 3, 4, 5, 6, 7, 7, 8]
    assert [r[0] for r in got] == np.concatenate(([0], np.cumsum([r[2] for r in got])))[:-1].tolist()
    assert [r[2] for r in got if r[1] in (1, 2)] == [1, 1]
    T.write_tokens(no_docs, f"{tmp_path}/none", MODEL)
    assert T.read_digests(spark, f"{tmp_path}/none").collect() == []
