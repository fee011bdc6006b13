"""From documents to training token ids, in five stages.

Each stage is a function of (spark, docs, sf_dir) and works on all that its predecessor kept; all
but the last return the columns of ``docs``. ``run`` writes each stage's result as Parquet to the
shared folder and reads it back, so a lost executor costs a re-read.

1. toxicity: documents that score THRESHOLD or more go; the model learns from the table ``labels``.
2. quality_rules: documents that fail a base rule or are outliers of their language and source go.
3. near_duplicates: of the documents that five-word shingles link at 80 %, the smallest id stays.
4. source_mix: sources are repeated and cut to their targets; a document that is cut keeps its first words.
5. sentence_pieces: texts become ids, and ids are decoded to see that they give the text back.

Defined cases: what the operators define; documents without an id are never near-duplicates; the
near-duplicate stage keeps one row of each group of texts (the smallest id), so rows that share an
id and differ in their texts stay, and rows that share both count once; documents without words do
not pass the quality rules; further columns are passed on, except by the last stage. Empty tables
stay empty.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.llm import mixing, near_dups, robust_rules, sentence_pieces, toxicity
from shelfcast.llm.tables import documents, own_name, set_aside, written


WORKER_CHUNKS = 200_000  # that a Python worker keeps: after four other stages there is less memory left


def tokenizer_path():
    """The SentencePiece model; a parameter of the last stage."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def reject_toxic(spark, docs, sf_dir):
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = own_name(docs, "toxicity")
    return toxicity.score(docs, model, name=name).filter(F.col(name) < toxicity.THRESHOLD).select(*docs.columns)


def reject_outliers(spark, docs, sf_dir):
    docs, back = set_aside(docs, [*robust_rules.STATISTICS, "base_failed", "distance", "kept"])
    rows = written(robust_rules.with_statistics(docs), "statistics")
    return back(robust_rules.judge(rows, robust_rules.fit(rows)).filter("kept"))


def drop_near_duplicates(spark, docs, sf_dir):
    found = near_dups.groups(docs).filter("id IS NOT NULL")
    one = F.min(F.struct("id", "digest")).alias("one")
    stay = found.filter("group IS NOT NULL").groupBy("group").agg(one).select("one.*")
    stay = stay.union(found.filter("group IS NULL").select("id", "digest").distinct())  # without words: linked with nothing
    digest, place = own_name(docs, "digest"), own_name(docs, "place")
    rows = docs.withColumn(digest, F.xxhash64("text")).join(stay.toDF("doc_id", digest), ["doc_id", digest], "left_semi")
    others = [c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    same = Window.partitionBy("doc_id", digest).orderBy(F.xxhash64(*others))  # rows that repeat
    rows = rows.withColumn(place, F.row_number().over(same)).filter(F.col(place) == 1)
    return rows.select(*docs.columns).union(docs.filter("doc_id IS NULL"))


def mix_sources(spark, docs, sf_dir):
    docs, back = set_aside(docs, mixing.ADDED)
    mixed = mixing.materialise(mixing.mix(docs))
    return back(mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)))


def to_sentence_pieces(spark, docs, sf_dir):
    model = tokenizer_path()
    size = {"most_chunks": WORKER_CHUNKS}
    rows = sentence_pieces.decode(sentence_pieces.encode(docs, model, **size), model, **size)
    return rows.select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == sentence_pieces.normalised(F.col("text"))).alias("round_trip"),
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("quality_rules", reject_outliers),
    ("near_duplicates", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("sentence_pieces", to_sentence_pieces),
]

#: SQL cannot express the trained and the tokenising stages.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
