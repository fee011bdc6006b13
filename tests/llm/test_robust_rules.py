import collections
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.llm import robust_rules as R

from .conftest import DOC, words


def brute(text):
    w = words(text)
    windows = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    marked = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i : i + 3])] > 1:
            marked |= {i, i + 1, i + 2}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(marked)


def counted(texts):
    got = R.text_statistics(pa.array(texts, pa.string()))
    return list(zip(*[got[n].tolist() for n in R.STATISTICS], strict=True))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="ab é#|\n \r", max_size=60), max_size=6))
def test_statistics(texts):
    assert counted(texts) == [brute(t) for t in texts]


def test_statistics_of_the_table(docs):
    texts = [r["text"] for r in docs.collect()]
    assert counted(texts) == [brute(t) for t in texts]


def test_chi_square():
    assert R.chi_square_quantile(0.5, 2) == pytest.approx(1.386294, abs=1e-5)
    assert R.chi_square_quantile(0.05, 4) == pytest.approx(9.487729, abs=1e-5)
    assert R.chi_square_quantile(0.01, 6) == pytest.approx(16.811894, abs=1e-5)


def scattered(spark, n=1_200):
    """Statistics of clean documents, with a fifth of the small group far off."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        group = "hot" if i % 3 else f"s{i % 4}"
        words_ = int(rng.integers(100, 400))
        bad = i % 15 == 0
        chars = int(words_ * np.exp(rng.normal(1.6, 0.04)))
        rows.append((i, "en", group, words_, chars, words_ * 2 if bad else 0, 0, 0, False, bad))
    names = ["doc_id", "lang", "source", *R.STATISTICS, "base_failed", "bad"]
    return spark.createDataFrame(rows, names)


def test_contaminated_groups_do_not_move_the_estimate(spark):
    rows = scattered(spark)
    estimates = R.fit(rows)
    center = {r["g_source"]: r["center"] for r in estimates.collect()}
    assert all(c[0] == pytest.approx(1.6, abs=0.03) and abs(c[1]) < 0.01 for c in center.values())
    judged = R.judge(rows, estimates)
    assert judged.filter(F.col("kept") == F.col("bad")).count() == 0


def test_distances_equal_the_formula(spark):
    rows = scattered(spark, 300)
    estimates = R.fit(rows)
    by = {(r["g_lang"], r["g_source"]): r for r in estimates.collect()}
    for r in R.judge(rows, estimates).collect():
        e = by[r["lang"], r["source"]]
        x = [np.log(r["word_chars"] / r["n_words"])] + [np.log1p(100 * r[c] / r["n_words"]) for c in R.STATISTICS[2:]]
        off = np.array(x) - e["center"]
        assert r["distance"] == pytest.approx(off @ np.reshape(e["precision"], (4, 4)) @ off)


def test_odd_rows(odd_docs, no_docs):
    rows = R.with_statistics(odd_docs)
    judged = R.judge(rows, R.fit(rows)).collect()
    assert len(judged) == odd_docs.count()
    assert all(not r["kept"] for r in judged if r["n_words"] < 50)
    empty = R.with_statistics(no_docs)
    assert R.judge(empty, R.fit(empty)).collect() == []


def test_groups_with_nulls_and_single_documents(rows):
    text = " ".join(f"word{i} here" for i in range(60))
    df = rows([(i, text + f" {i}", lang, source, 0) for i, (lang, source) in enumerate([(None, None), (None, "a"), ("en", None), ("en", "a")] * 3)], DOC)
    stats = R.with_statistics(df)
    assert R.judge(stats, R.fit(stats)).filter("kept").count() == 12


def test_junk_alone_in_its_source_is_rejected(spark):
    """A group too small for an estimate of its own is measured by its language's, or that of all."""
    rows = scattered(spark, 600).filter("not bad")
    extra = [(10_000 + i, lang, f"alone{i}", 200, 990, symbols, 0, 0, False, symbols > 0) for i, (lang, symbols) in enumerate(
        [("en", 600), ("en", 0), ("de", 600), ("fr", 0), (None, 600), ("en", 600), ("en", 0)]
    )]
    rows = rows.union(spark.createDataFrame(extra, rows.schema))
    estimates = R.fit(rows)
    assert estimates.count() == rows.select("lang", "source").distinct().count()
    judged = R.judge(rows, estimates)
    assert judged.filter("distance is null").count() == 0
    assert judged.filter(F.col("kept") == F.col("bad")).count() == 0


def test_a_group_without_an_estimate_is_an_error(spark):
    rows = scattered(spark, 300)
    estimates = R.fit(rows.filter("source <> 's0'"))
    with pytest.raises(Exception, match="no estimate"):
        R.judge(rows, estimates).collect()


def graded(spark, column, per_hundred):
    """A clean document of 200 words with so many of a statistic."""
    row = dict.fromkeys(R.STATISTICS, 0) | {"n_words": 200, "word_chars": 990, column: 2 * per_hundred}
    values = [(7, "en", "hot", *[row[c] for c in R.STATISTICS], False, False)]
    return spark.createDataFrame(values, ["doc_id", "lang", "source", *R.STATISTICS, "base_failed", "bad"])


def test_each_statistic_rejects_alone(spark):
    estimates = R.fit(scattered(spark).filter("not bad")).cache()

    def kept(column, share):
        return R.judge(graded(spark, column, share), estimates).first()["kept"]

    for column in ("n_symbols", "n_dup_lines", "n_repeat_words"):
        assert kept(column, 1)
        assert not kept(column, 15)
    assert not kept("word_chars", 300) and not kept("word_chars", 800) and kept("word_chars", 500)


def test_a_tail_that_clean_documents_have_is_not_rejected(spark):
    """Where one text in twenty repeats a fifth of its words, the estimate lets such a text pass."""
    rows = scattered(spark).filter("not bad")
    rows = rows.withColumn("n_repeat_words", F.expr("IF(doc_id % 20 = 1, n_words DIV 5, 0)"))
    judged = R.judge(rows, R.fit(rows))
    assert judged.filter("not kept").count() == 0


def numpy_estimate(x, words):
    """The estimate of one group that is all there is, so that blending changes nothing."""
    upper, d = R._upper_tail, R.DIMENSIONS

    def distances(center, precision, points):
        off = points - center
        return np.einsum("ij,jk,ik->i", off, precision, off)

    def moments(points, factor, least):
        cov = factor * np.cov(points.T, bias=True)
        diagonal = np.maximum(np.diag(cov), np.square(least))
        cov = R.DAMP * cov
        np.fill_diagonal(cov, diagonal)
        return points.mean(0), np.linalg.inv(cov), np.linalg.slogdet(cov)[1]

    def median(values):
        return np.sort(values, axis=0)[(len(values) + 1) // 2 - 1]

    middle = median(x)
    first = np.diag(1 / ((1.4826 * median(np.abs(x - middle))) ** 2 + np.square(R.START_SPREAD)))
    length = np.sqrt(distances(middle, first, x))[:, None]
    sphere = middle + (x - middle) / np.where(length > 0, length, np.inf)
    def concentrated(center, precision):
        dist = distances(center, precision, x)
        limit = np.sort(dist)[int(np.ceil(R.HALF * len(x))) - 1]
        factor = R.HALF / (1 - upper(R.chi_square_quantile(1 - R.HALF), d + 2))
        return moments(x[dist <= limit], factor, R.START_SPREAD)

    starts = ((middle, first), moments(x, 1.0, R.START_SPREAD)[:2], moments(sphere, float(d), R.START_SPREAD)[:2])
    center, precision, _ = min((concentrated(*s) for s in starts), key=lambda f: f[2])
    for _ in range(R.STEPS - 1):
        center, precision, _ = concentrated(center, precision)
    dist = distances(center, precision, x)
    off = x[dist <= R.chi_square_quantile(R.TAIL)] - center
    ends = np.sort(np.abs(off), axis=0)[int(np.ceil(0.99 * len(off))) - 1] / 2.575829
    one = [R.LEAST_LENGTH, *[np.log1p(100 / median(words))] * (d - 1)]
    least = np.maximum(np.maximum(np.sqrt((off**2).mean(0)), ends), one)
    near = R.chi_square_quantile(0.025)
    return moments(x[dist <= near], 0.975 / (1 - upper(near, d + 2)), least)[:2]


def test_one_group_equals_numpy(spark):
    rng = np.random.default_rng(8)
    data = []
    for i in range(400):
        n = int(rng.integers(80, 300))
        chars = int(n * np.exp(rng.normal(1.6, 0.1)))
        repeats = int(rng.integers(0, n // 5)) if i % 3 else 0
        data.append((i, "en", "a", n, chars, int(rng.integers(0, 9)) + (2 * n if i % 9 == 0 else 0), i % 4, repeats, False))
    rows = spark.createDataFrame(data, ["doc_id", "lang", "source", *R.STATISTICS, "base_failed"])
    got = R.fit(rows).first()
    counts = np.array([r[3:8] for r in data], float)
    x = np.c_[np.log(counts[:, 1] / counts[:, 0]), np.log1p(100 * counts[:, 2:] / counts[:, :1])]
    center, precision = numpy_estimate(x, counts[:, 0])
    assert got["center"] == pytest.approx(center, rel=1e-6)
    assert np.reshape(got["precision"], (4, 4)) == pytest.approx(precision, rel=1e-6, abs=1e-6)


def test_no_document_passes_the_base_rules(spark):
    rows = scattered(spark, 30).withColumn("base_failed", F.lit(True))
    assert R.judge(rows, R.fit(rows)).filter("not kept and distance is null").count() == 30
