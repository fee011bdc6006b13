import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import textops as T

from .conftest import words

texts = st.lists(st.none() | st.text(alphabet="ab é日 \t\n\x0b\x1c", max_size=30), max_size=8)


@settings(max_examples=80, deadline=None)
@given(texts)
def test_words_and_their_hashes(rows):
    found, named = [], {}
    for at, to, data, offsets in T.slices(pa.array(rows, pa.string()), most=16):
        starts, ends, first = T.word_bounds(data, offsets)
        hashes = T.hash_spans(data, starts, ends)
        for r in range(to - at):
            here = range(first[r], first[r + 1])
            found.append([data[starts[i] : ends[i]].tobytes().decode() for i in here])
            for i in here:
                assert named.setdefault(found[-1][i - first[r]], hashes[i]) == hashes[i]
    assert found == [words(r) for r in rows]
    assert len(set(named.values())) == len(named)


def test_long_spans_hash_alike_alone_and_among_others():
    data = np.frombuffer(b" ".join([b"q" * 50_000] * 3 + [b"q" * 49_999 + b"r", b"z" * 77] + [b"a" * 77] * 20 + [b"z" * 77]), np.uint8)
    starts, ends, _ = T.word_bounds(data, np.array([0, len(data)]))
    hashes = T.hash_spans(data, starts, ends)
    assert len(set(hashes[:3].tolist())) == 1 and hashes[3] != hashes[0]
    alone = T.hash_spans(np.frombuffer(b"z" * 77, np.uint8), np.array([0]), np.array([77]))
    assert hashes[4] == alone[0] == hashes[-1]
