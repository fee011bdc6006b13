"""URL filters: rules first, then logistic regression on hashed character n-grams.

A rule is a host and a path prefix; it fits its host and all subdomains, and the longest fitting
rule decides. URLs that no rule fits get the verdict of a logistic regression on the character
n-grams (3 to 6 bytes, lower-cased) of host and path, hashed into a table for each; a field's
n-grams are scaled to length 1. The model is fitted in numpy from a small table of labelled URLs (an
argument; of a larger one MOST_LABELLED rows are taken), so nothing grows with the input: URLs are
judged one by one, without a shuffle, and a long one in pieces.

Defined cases: a null URL, or one without ``://``, has an empty host and path, which no rule fits
and the model judges by its bias; repeated rows are judged alike; of fitting rules of equal length
the first in code point order decides; columns of the input with names of added ones are replaced.
"""

from __future__ import annotations

import csv
import math
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.tables import bounded_batches, without
from shelfcast.llm.textops import LOWER, SPACE, release_memory, slices, utf8
from shelfcast.llm.toxicity import BUCKET_BITS, SIZES, grams, spaced

SHARE = 0.1
MOST_LABELLED = 20_000  # labelled URLs that a fit takes
PIECE = 1 << 18  # bytes of a URL that are looked at together
ADDED = ("host", "path", "rule", "verdict", "block_score")
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

#: Labelled URLs (url, label; 1 to block, 0 to allow), for callers that have no table of their own.
LABELLED_FILE = os.path.join(os.path.dirname(__file__), "labelled_urls.csv")


def labelled_urls(path=LABELLED_FILE):
    """(url, label) pairs of a CSV file with these columns."""
    with open(path, newline="", encoding="utf-8") as file:
        return [(r["url"], int(r["label"])) for r in csv.DictReader(file)]


def sampled_urls(labelled, most=MOST_LABELLED):
    """(url, label) pairs of a table: all of them, or the ``most`` of the smallest hashes.

    Rows without a url or a label, or with a label other than 0 and 1, are left out.
    """
    rows = labelled.select(F.col("url").cast("string").alias("url"), F.col("label").cast("int").alias("label"))
    rows = rows.filter("url IS NOT NULL AND label IN (0, 1)").distinct()
    return [tuple(r) for r in rows.orderBy(F.xxhash64("url"), "url", "label").limit(int(most)).collect()]


def split_url(url):
    """(host, path) columns of a URL column."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host, path, rules):
    """The text of the longest rule that fits; null without one."""
    fits = []
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        of, slash, prefix = rule.partition("/")
        on_host = (host == of) | host.endswith(f".{of}")
        fits.append(F.when(on_host & path.startswith(slash + prefix), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def field_grams(column):
    """(row, bucket) of every n-gram of an Arrow column of texts, and their number by row."""
    data, offsets = utf8(column)
    stream, bounds = spaced(data, offsets)
    rows, buckets = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for bucket, valid in grams(stream):
        at = np.flatnonzero(valid)
        rows.append(np.searchsorted(bounds[:-1], at + 1, "right") - 1)
        buckets.append(bucket[at].astype(np.int64))
    rows, buckets = np.concatenate(rows), np.concatenate(buckets)
    return rows, buckets, np.bincount(rows, minlength=len(column))


def _parts(column):
    rows, buckets, counts = field_grams(column)
    return rows, buckets, 1.0 / np.sqrt(np.maximum(counts, 1))


def _pieces(data):
    """(stream, positions that start n-grams) of one long text, as ``spaced`` has it, in overlapping pieces."""
    size, more = len(data) + 2, max(SIZES) - 1
    for at in range(0, size, PIECE):
        to = min(size, at + PIECE + more)
        piece = np.full(to - at, 0x20, np.uint8)
        inside = LOWER[data[max(at - 1, 0) : min(to - 1, len(data))]]
        begin = 1 if at == 0 else 0
        piece[begin : begin + len(inside)] = inside
        piece[SPACE[piece]] = 0x20
        yield piece, min(PIECE, size - at)


def field_sums(column, table):
    """Sum of the n-grams' weights of each text of an Arrow column, scaled to length 1."""
    sums, counts = np.zeros(len(column)), np.zeros(len(column), np.int64)
    for at, to, data, offsets in slices(column, PIECE):
        if to - at == 1:
            for stream, starts in _pieces(data):
                for bucket, valid in grams(stream):
                    valid = valid[:starts]
                    sums[at] += table[bucket[:starts][valid]].sum(dtype=np.float64)
                    counts[at] += np.count_nonzero(valid)
            continue
        stream, bounds = spaced(data, offsets)
        for bucket, valid in grams(stream):
            begin = np.flatnonzero(valid)
            row = np.searchsorted(bounds[:-1], begin + 1, "right") - 1
            sums[at:to] += np.bincount(row, table[bucket[begin]], minlength=to - at)
            counts[at:to] += np.bincount(row, minlength=to - at)
    return sums / np.sqrt(np.maximum(counts, 1))


def url_scores(host, path, model):
    """Probabilities of ``block`` for Arrow columns of hosts and paths."""
    bias, *tables = model
    logit = bias + sum(field_sums(column, table) for column, table in zip((host, path), tables, strict=True))
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def fit(labelled=None, rounds=2000, rate=5.0, decay=1e-5, share=SHARE):
    """Weights from (url, label) pairs (by default those of LABELLED_FILE) by gradient descent over all of them.

    ``share`` is the share of URLs to block that is expected among those to judge, and so the score of one
    without a known n-gram; the classes weigh the same in the fit.
    """
    labelled = labelled_urls() if labelled is None else list(labelled)
    parts = [_split(u) for u, _ in labelled]
    y = np.array([label for _, label in labelled], float)
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, len(y) - y.sum()))
    fields = [_parts(pa.array([p[i] for p in parts], pa.string())) for i in (0, 1)]
    used, cells = zip(*[np.unique(buckets, return_inverse=True) for _, buckets, _ in fields], strict=True)
    weights = [np.zeros(len(u)) for u in used]
    for _ in range(rounds):
        logit = np.zeros(len(y))
        for own, cell, (rows, _, scale) in zip(weights, cells, fields, strict=True):
            logit += np.bincount(rows, own[cell], minlength=len(y)) * scale
        off = (1 / (1 + np.exp(-logit)) - y) * weight
        for own, cell, (rows, _, scale) in zip(weights, cells, fields, strict=True):
            own *= 1 - rate * decay
            own -= rate * np.bincount(cell, off[rows] * scale[rows], minlength=len(own))
    tables = [np.zeros(1 << BUCKET_BITS, np.float32) for _ in used]
    for table, at, own in zip(tables, used, weights, strict=True):
        table[at] = own
    return (math.log(share / (1 - share)), *tables)


def _split(url):
    rest = url.partition("://")[2]
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host, path = rest[:cut].lower(), rest[cut:]
    return host, path[: min([path.find(c) for c in "?#" if c in path] + [len(path)])]


def judge(df, url_col="url", rules=RULES, labelled=None, threshold=0.5):
    """The table with host, path, rule, block_score and verdict (the rule's, else the model's).

    ``labelled`` is a table with url and label, or (url, label) pairs; without it LABELLED_FILE is read.
    """
    df = without(df, *ADDED)
    spark = df.sparkSession
    bounded_batches(spark)
    model = spark.sparkContext.broadcast(fit(sampled_urls(labelled) if isinstance(labelled, DataFrame) else labelled))

    def scores(host, path):
        found = pa.array(url_scores(host, path, model.value))
        release_memory()
        return found

    score = F.arrow_udf(scores, "double")
    host, path = split_url(F.col(url_col))
    rows = df.withColumns({"host": host, "path": path})
    rows = rows.withColumns({"rule": longest_rule(F.col("host"), F.col("path"), rules), "block_score": score("host", "path")})
    verdicts = F.create_map(*[F.lit(x) for r in rules for x in r]) if rules else F.lit(None).cast("map<string,string>")
    by_model = F.when(F.col("block_score") >= threshold, "block").otherwise("allow")
    return rows.withColumn("verdict", F.coalesce(F.element_at(verdicts, F.col("rule")), by_model))


def op3_url_filter(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages).select("page_id", *ADDED)
