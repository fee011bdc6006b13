import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.llm import sentence_pieces as S
from shelfcast.llm import textops

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
OWN = S.Transducer(S.read_model(open(MODEL, "rb").read()))


def test_a_worker_lets_go_of_the_transducer_in_another_stage(monkeypatch):
    class Shared:
        value = open(MODEL, "rb").read()

    stage = [1]
    monkeypatch.setattr(textops, "_stage", lambda: stage[0])
    S.transducer(Shared)
    textops.release_memory()
    assert S._compiled
    stage[0] = 2
    textops.release_memory()
    assert not S._compiled


def same(texts):
    ids, counts = OWN.encode(texts)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert got == LIBRARY.encode(texts, num_threads=1)
    assert OWN.decode(ids, counts) == [t.replace(S.META, " ") for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="  \n\tabcdeinrsthé▁<0x>日😀.,\x00", max_size=40), max_size=5))
def test_encodes_as_the_library(texts):
    same(texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_any_characters(texts):
    same(texts)


def test_table_and_runs_of_spaces(docs):
    same([r["text"] for r in docs.collect()])
    same([" " * n + "x" + " " * (n % 5) for n in range(40)] + ["=" * n for n in range(1, 40)])


def test_decode_of_broken_bytes_and_controls():
    for ids in ([3 + 0xFF], [1, 2], [3 + 0xE6, 3 + 0x97], [3 + 0xC3, 3 + 0xA9, 3 + 0x80], [], [0]):
        assert OWN.decode(np.array(ids, np.int64), [len(ids)]) == [LIBRARY.decode(ids)]


def test_unigram_models_take_the_best_total():
    pieces = [("<unk>", 0.0, S.UNKNOWN), ("▁", -2.0, S.NORMAL), ("a", -3.0, S.NORMAL), ("b", -3.0, S.NORMAL), ("ab", -5.0, S.NORMAL), ("▁ab", -8.5, S.NORMAL), ("abab", -11.0, S.NORMAL)]
    model = {"pieces": pieces, "merges": False, "bytes": False, "unknown": 0, "prefix": True, "squeeze": True, "meta": True}
    own = S.Transducer(model)

    def brute(text):
        best = {0: (0.0, [])}
        for i in range(len(text)):
            if i in best:
                for k, (piece, score, kind) in enumerate(pieces):
                    if kind == S.NORMAL and text.startswith(piece, i):
                        total = best[i][0] - score
                        if total < best.get(i + len(piece), (1e9,))[0]:
                            best[i + len(piece)] = (total, best[i][1] + [k])
        return best[len(text)][1]

    for text in ("ab", "abab", "ababab", "a b", "aab"):
        ids, _ = own.encode([f"  {text} "])
        assert ids.tolist() == brute("▁" + text.replace(" ", "▁"))


def test_refuses_other_models():
    good = open(MODEL, "rb").read()
    with pytest.raises(ValueError):
        S.read_model(good + bytes([0x0A, 5, 0x0A, 1, 0x7E, 0x18, S.USER_DEFINED]))


def test_spark_columns(odd_docs, no_docs):
    rows = S.decode(S.encode(odd_docs, MODEL, name="ids"), MODEL)
    rows = rows.withColumn("crc", S.ids_crc32(F.col("ids"))).withColumn("back", F.col("decoded") == S.normalised(F.col("text")))
    for r in rows.collect():
        ids = LIBRARY.encode(r["text"] or "")
        assert r["ids"] == ids and r["back"] and r["crc"] == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert S.decode(S.encode(no_docs, MODEL), MODEL).collect() == []
    nulls = no_docs.sparkSession.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")
    assert [r["decoded"] for r in S.decode(nulls, MODEL).orderBy("k").collect()] == ["", ""]
