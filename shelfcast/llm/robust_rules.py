"""Quality rules: robust multivariate outliers.

Four transformed statistics of each text (log of the mean word length, and log(1 + x) of symbols,
duplicate lines and repeated words per 100 words) are held against a minimum-covariance-determinant
estimate of their language and source. A document is rejected if a base rule fails, or if its
squared Mahalanobis distance is above the chi-square quantile CUTOFF.

The estimate covers all documents that pass the base rules. It is made from three starts: medians
with median deviations, the plain moments, and the moments of directions from the medians (spatial
signs). From each, a concentration step keeps, in each language and source, the HALF share of
documents that are nearest to the last estimate and takes their mean and covariance; each group goes
on with the one of least determinant, for STEPS steps in all. A last step reweighs: it keeps all
within the 97.5 % quantile. Every step is two grouped aggregates over a narrow written table, so a
source that holds most rows is combined on the map side like any other, and the number of sources
may grow. Estimates are never made from nothing: a group's moments are joined by those of its
language with the weight of PRIOR documents, and a language's by those of all.

Most clean texts have no symbols and no duplicate lines, where a covariance of the nearest is 0. So
no variance is taken below that of all groups together: over the documents within the final limit
of the chosen estimates, the larger of the second moment about their group's center and the normal
spread with the same 99 % quantile. And none is below what one symbol, line or word is in the
median text, or LEAST_LENGTH for the word length. START_SPREAD stands in for these until the
starts are compared.

A group of fewer than SMALLEST documents is too small for an estimate of its own: medians and
limits are then those of its language, or of all if the language is as small, and its own moments
are left out of its estimate, so that a document alone in its source is not measured by itself. A
group of which no document is kept has the estimate of the level above.

Defined cases: a null or empty text has no words and fails the base rules; null languages and
sources are groups of their own; copies count as often as they occur; an empty table gives an
empty result; columns of the input with names of added ones are replaced; judging a group without
an estimate is an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelfcast.llm.tables import bounded_batches, documents, own_name, without, written
from shelfcast.llm.textops import SPACE, hash_spans, mix64, per_row, release_memory, repeat_rows, slices, word_bounds

LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent
HALF = 0.75
STEPS = 3
PRIOR = 30
SMALLEST = 20  # five documents for each statistic
TAIL = 1e-6
START_SPREAD = (0.08, 0.5, 0.5, 0.8)
LEAST_LENGTH = 0.02
DAMP = 0.9  # share of the covariances that counts: a matrix is never singular
DIMENSIONS = len(START_SPREAD)
KEYS = ["g_lang", "g_source"]
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True


def _repeats(keys):
    """(whether a key equals an earlier one, whether it equals any other one)."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    later, other = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    other[order[1:]] |= same
    other[order[:-1]] |= same
    return later, other


def text_statistics(column):
    """The five counts of each text of an Arrow column, as a dictionary of arrays."""
    out = {name: np.zeros(len(column), np.int64) for name in STATISTICS}
    for at, to, data, offsets in slices(column):
        here = slice(at, to)
        if not len(data):
            continue
        space = SPACE[data]
        starts, ends, first = word_bounds(data, offsets, space)
        words = np.diff(first)
        out["n_words"][here] = words
        out["word_chars"][here] = per_row(~space & ((data & 0xC0) != 0x80), offsets)
        out["n_symbols"][here] = per_row(SYMBOL[data], offsets)
        row = repeat_rows(first)
        hashes = hash_spans(data, starts, ends)
        if len(hashes) >= 3:
            with np.errstate(over="ignore"):
                three = hashes[:-2] + mix64(hashes[1:-1] + np.uint64(1)) + mix64(hashes[2:] ^ np.uint64(0xA5A5A5A5))
                three += mix64(row[:-2] + 1)
            inside = np.flatnonzero(row[2:] == row[:-2])
            twice = inside[_repeats(three[inside])[1]]
            marked = np.zeros(len(hashes), bool)
            for step in range(3):
                marked[twice + step] = True
            out["n_repeat_words"][here] = per_row(marked, first)
        # a line ends before a line feed or at the end of its row
        breaks = np.flatnonzero(data == 0x0A)
        begin = np.union1d(offsets[:-1], breaks + 1)
        begin = begin[begin < len(data)]
        end = np.append(begin[1:], len(data))
        end = end - ((end > begin) & (data[end - 1] == 0x0A))
        spoken = np.add.reduceat(~space, begin, dtype=np.int64) > 0
        begin, end = begin[spoken], end[spoken]
        line_row = np.searchsorted(offsets, begin, "right") - 1
        with np.errstate(over="ignore"):
            later = _repeats(hash_spans(data, begin, end) + mix64(line_row + 1))[0]
        out["n_dup_lines"][here] = np.bincount(line_row[later], minlength=to - at)
    return out


def _struct(column):
    counts = text_statistics(column)
    release_memory()
    return pa.StructArray.from_arrays([pa.array(counts[n]) for n in STATISTICS], list(STATISTICS))


def with_statistics(df, text_col="text"):
    """The table with the five counts and ``base_failed``."""
    bounded_batches(df.sparkSession)
    df = without(df, *STATISTICS, "base_failed")
    name = own_name(df, "statistics")
    kind = ", ".join(f"{n}: bigint" for n in STATISTICS)
    rows = df.withColumn(name, F.arrow_udf(_struct, f"struct<{kind}>")(F.col(text_col)))
    rows = rows.select(*df.columns, *[F.col(f"{name}.{n}").alias(n) for n in STATISTICS])
    few = F.col("n_words") < LEAST_WORDS
    return rows.withColumn("base_failed", few | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def vector():
    """The transformed statistics; all 0 without words."""
    per = [F.log1p(100 * F.col(c) / F.col("n_words")) for c in STATISTICS[2:]]
    parts = [F.log(F.col("word_chars") / F.col("n_words")), *per]
    return [F.when(F.col("n_words") > 0, p).otherwise(F.lit(0.0)) for p in parts]


def chi_square_quantile(upper, degrees=DIMENSIONS):
    """The value that a chi-square variable of even degrees exceeds with probability ``upper``."""
    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _upper_tail(mid, degrees) > upper else (low, mid)
    return low


def _upper_tail(x, degrees):
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(degrees // 2))


def _inverse(covariance):
    """Inverse matrices and log determinants of an Arrow column of covariances, row by row of each matrix."""
    flat = np.array(covariance.to_pylist(), float).reshape(-1, DIMENSIONS, DIMENSIONS)
    inverse = pa.array(list(np.linalg.inv(flat).reshape(len(flat), -1)), pa.list_(pa.float64()))
    return pa.StructArray.from_arrays([inverse, pa.array(np.linalg.slogdet(flat)[1])], ["precision", "volume"])


def _distance():
    """Squared Mahalanobis distance of x0.. to the joined center and precision."""
    off = [F.col(f"x{i}") - F.col("center")[i] for i in range(DIMENSIONS)]
    return sum((off[i] * off[j] * F.col("precision")[i * DIMENSIONS + j] for i in range(DIMENSIONS) for j in range(DIMENSIONS)), F.lit(0.0))


def _moments(rows, *keys):
    sums = [F.sum(f"x{i}").alias(f"s{i}") for i in range(DIMENSIONS)]
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]
    return rows.groupBy(*keys).agg(F.count("*").cast("double").alias("n"), *sums, *products)


def _blend(table, above, keys=()):
    """Adds the moments of the level above, scaled to PRIOR documents; without keys ``above`` is one row."""
    names = [c for c in table.columns if c not in ("g_lang", "g_source")]
    groups = [c for c in table.columns if c not in names]
    if keys:
        above = above.select(*[F.col(c).alias(f"{c}_above") for c in above.columns])
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"{k}_above"))
        table, upper = table.join(above, on), {c: F.col(f"{c}_above") for c in names}
    else:
        upper = {c: F.lit(above[c]).cast("double") for c in names}
    return table.select(*groups, *[(F.col(c) + F.lit(float(PRIOR)) * upper[c] / upper["n"]).alias(c) for c in names])


def _levels(good):
    """(g_lang, g_source, level): 0 for groups with an estimate of their own, 1 for their language's, 2 for that of all."""
    sizes = good.groupBy(*KEYS).agg(F.count("*").alias("n"))
    languages = sizes.groupBy("g_lang").agg(F.sum("n").alias("m")).withColumnRenamed("g_lang", "l_lang")
    level = F.when(F.col("n") >= SMALLEST, 0).when(F.col("m") >= SMALLEST, 1).otherwise(2)
    return sizes.join(languages, F.col("g_lang").eqNullSafe(F.col("l_lang"))).select(*KEYS, level.alias("level"))


def _by_level(rows, groups, aggregate):
    """(g_lang, g_source, value) for each group: the aggregate over the group, its language or all, as its level says."""
    own = rows.groupBy(*KEYS).agg(aggregate.alias("own")).withColumnsRenamed({"g_lang": "o_lang", "g_source": "o_source"})
    language = rows.groupBy("g_lang").agg(aggregate.alias("of_lang")).withColumnRenamed("g_lang", "l_lang")
    table = groups.join(own, F.col("g_lang").eqNullSafe(F.col("o_lang")) & F.col("g_source").eqNullSafe(F.col("o_source")))
    table = table.join(language, F.col("g_lang").eqNullSafe(F.col("l_lang"))).crossJoin(F.broadcast(rows.agg(aggregate.alias("of_all"))))
    value = F.when(F.col("level") == 0, F.col("own")).when(F.col("level") == 1, F.col("of_lang")).otherwise(F.col("of_all"))
    return table.select(*KEYS, value.alias("value"))


def _estimate(moments, groups, factor, least=START_SPREAD):
    """Center, precision and log determinant of every group from the moments of its kept documents; None if none is kept at all.

    No variance is below the square of its ``least`` spread.
    """
    names = [c for c in moments.columns if c not in KEYS]
    named = moments.withColumnsRenamed({"g_lang": "m_lang", "g_source": "m_source"})
    on = F.col("g_lang").eqNullSafe(F.col("m_lang")) & F.col("g_source").eqNullSafe(F.col("m_source"))
    kept = groups.join(named, on, "left").select(*KEYS, "level", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in names])
    kept = written(kept, "mcd-moments")
    languages = kept.groupBy("g_lang").agg(F.max("level").alias("level"), *[F.sum(c).alias(c) for c in names])
    whole = languages.agg(*[F.sum(c).alias(c) for c in names]).first()
    if not whole["n"]:
        return None

    def own(table, least):
        return table.select(*[k for k in KEYS if k in table.columns], *[F.when(F.col("level") < least, F.col(c)).otherwise(0.0).alias(c) for c in names])

    table = _blend(own(kept, 1), _blend(own(languages, 2), whole), ["g_lang"])
    center = [F.col(f"s{i}") / F.col("n") for i in range(DIMENSIONS)]
    cell = []
    for i in range(DIMENSIONS):
        for j in range(DIMENSIONS):
            spread = F.col(f"p{min(i, j)}{max(i, j)}") / F.col("n") - center[i] * center[j]
            cell.append(F.greatest(factor * spread, F.lit(float(least[i]) ** 2)) if i == j else DAMP * factor * spread)
    table = table.select("g_lang", "g_source", F.array(*center).alias("center"), F.array(*cell).alias("covariance"))
    inverse = F.arrow_udf(_inverse, "struct<precision: array<double>, volume: double>")
    return written(table.withColumn("inverse", inverse("covariance")).select(*KEYS, "center", "inverse.*"), "mcd")


def _at(rows, estimates):
    """The rows beside their group's estimate."""
    named = estimates.withColumnsRenamed({"g_lang": "e_lang", "g_source": "e_source"})
    on = F.col("g_lang").eqNullSafe(F.col("e_lang")) & F.col("g_source").eqNullSafe(F.col("e_source"))
    return rows.join(named, on, "left").drop("e_lang", "e_source")


def _measured(good, estimates):
    return _at(good, estimates.select(*KEYS, "center", "precision")).withColumn("distance", _distance()).drop("precision")


def _starts(good, groups):
    """Three first estimates: medians and their deviations, plain moments, moments of directions."""
    xs = [f"x{i}" for i in range(DIMENSIONS)]
    middle = _by_level(good, groups, F.array(*[F.percentile_approx(x, 0.5) for x in xs])).withColumnRenamed("value", "center")
    middle = written(middle, "mcd-middle")
    off = [F.col(x) - F.col("center")[i] for i, x in enumerate(xs)]
    deviation = _by_level(_at(good, middle), groups, F.array(*[F.percentile_approx(F.abs(o), 0.5) for o in off]))
    variance = [(F.col("value")[i] * 1.4826) ** 2 + START_SPREAD[i] ** 2 for i in range(DIMENSIONS)]
    cells = [1 / variance[i] if i == j else F.lit(0.0) for i in range(DIMENSIONS) for j in range(DIMENSIONS)]
    medians = written(_at(deviation, middle).select(*KEYS, "center", F.array(*cells).alias("precision")), "mcd")
    length = F.sqrt(_distance())
    to_sphere = F.when(length > 0, 1 / length).otherwise(0.0)
    signs = _at(good, medians).withColumn("shrink", to_sphere)
    signs = signs.select(*KEYS, *[(F.col("center")[i] + o * F.col("shrink")).alias(x) for i, (x, o) in enumerate(zip(xs, off, strict=True))])
    return medians, _estimate(_moments(good, *KEYS), groups, 1.0), _estimate(_moments(signs, *KEYS), groups, float(DIMENSIONS))


def concentrate(good, groups, estimates):
    """One concentration step: estimates of the HALF share that is nearest to the given ones."""
    measured = _measured(good, estimates).drop("center")
    limit = _by_level(measured, groups, F.percentile_approx("distance", HALF)).withColumnRenamed("value", "limit")
    factor = HALF / (1 - _upper_tail(chi_square_quantile(1 - HALF), DIMENSIONS + 2))
    return _estimate(_moments(_at(measured, limit).filter("distance <= limit"), *KEYS), groups, factor)


def _least_spread(good, measured, tail):
    """The least spread of each statistic, from the documents of all groups (see the module)."""
    off = [F.col(f"x{i}") - F.col("center")[i] for i in range(DIMENSIONS)]
    normal = 2.575829  # the 99 % quantile of the absolute value of a normal variable
    squares = [F.avg(o * o).alias(f"square{i}") for i, o in enumerate(off)]
    ends = [F.percentile_approx(F.abs(o), 0.99, 100_000).alias(f"end{i}") for i, o in enumerate(off)]
    near = measured.filter(F.col("distance") <= chi_square_quantile(tail)).agg(*squares, *ends).first()
    words = good.agg(F.percentile_approx("n_words", 0.5)).first()[0]
    if words is None or near["square0"] is None:
        return START_SPREAD
    one = [LEAST_LENGTH] + [math.log1p(100 / words)] * (DIMENSIONS - 1)
    return tuple(max(one[i], math.sqrt(near[f"square{i}"]), near[f"end{i}"] / normal) for i in range(DIMENSIONS))


def fit(rows, lang_col="lang", source_col="source", tail=TAIL):
    """Estimates for each language and source, from a table with the statistics and ``base_failed``."""
    xs = [f"x{i}" for i in range(DIMENSIONS)]
    good = rows.filter(~F.col("base_failed"))
    values = [v.alias(x) for x, v in zip(xs, vector(), strict=True)]
    good = written(good.select(F.col(lang_col).alias("g_lang"), F.col(source_col).alias("g_source"), "n_words", *values), "mcd-vectors")
    groups = written(_levels(good), "mcd-groups")
    found = None
    for start, estimates in enumerate(_starts(good, groups)):
        estimates = estimates and concentrate(good, groups, estimates)
        if estimates is not None:
            one = estimates.select(*KEYS, F.struct("volume", F.lit(start).alias("start"), "center", "precision").alias("one"))
            found = one if found is None else found.union(one)
    if found is None:  # no document passes the base rules
        return good.select(*KEYS, F.array(F.lit(0.0)).alias("center"), F.array(F.lit(0.0)).alias("precision"))
    best = written(found.groupBy(*KEYS).agg(F.min("one").alias("one")).select(*KEYS, "one.*"), "mcd")
    for _ in range(STEPS - 1):
        best = concentrate(good, groups, best) or best
    measured = _measured(good, best)
    least = _least_spread(good, measured, tail)
    factor = 0.975 / (1 - _upper_tail(chi_square_quantile(0.025), DIMENSIONS + 2))
    near = measured.filter(F.col("distance") <= chi_square_quantile(0.025))
    estimates = _estimate(_moments(near, *KEYS), groups, factor, least)
    return (best if estimates is None else estimates).select(*KEYS, "center", "precision")


def judge(rows, estimates, lang_col="lang", source_col="source", tail=TAIL):
    """The table with ``distance`` (squared; null where the base rules fail) and ``kept``."""
    rows = without(rows, "distance", "kept")
    taken = {own: own_name(rows, own) for own in ("g_lang", "g_source", "e_lang", "e_source", "center", "precision")}
    named = estimates.withColumnsRenamed({"g_lang": taken["e_lang"], "g_source": taken["e_source"], "center": taken["center"], "precision": taken["precision"]})
    on = F.col(lang_col).eqNullSafe(F.col(taken["e_lang"])) & F.col(source_col).eqNullSafe(F.col(taken["e_source"]))
    x, center, precision = vector(), F.col(taken["center"]), F.col(taken["precision"])
    pairs = [(i, j) for i in range(DIMENSIONS) for j in range(DIMENSIONS)]
    distance = sum(((x[i] - center[i]) * (x[j] - center[j]) * precision[i * DIMENSIONS + j] for i, j in pairs), F.lit(0.0))
    measured = rows.join(named, on, "left").select(*rows.columns, F.when(~F.col("base_failed"), distance).alias("distance"))
    near = F.coalesce(F.col("distance") <= chi_square_quantile(tail), F.raise_error(F.lit("no estimate for a document's language and source")).cast("boolean"))
    return measured.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(near))


def op9_robust_rules(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    rows = written(with_statistics(docs).drop("text"), "statistics")
    return judge(rows, fit(rows)).select("doc_id", *STATISTICS, "base_failed", "kept", "distance")
