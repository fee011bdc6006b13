import corpus_pipeline
import __spark_entry__ as entry
from pyspark.sql import functions as F
from shelfcast.llm import near_dups, robust_rules
from shelfcast.llm.tables import written

from .conftest import SF, words


def test_stages_follow_each_other(spark, docs):
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        last = now
        now = written(stage(spark, now, SF), name)
        if name != "sentence_pieces":
            assert now.columns == docs.columns
        if name in ("toxicity", "quality_rules", "near_duplicates"):
            assert now.exceptAll(last).isEmpty() and 0.5 * last.count() < now.count() < last.count()
        if name == "quality_rules":
            checked = robust_rules.with_statistics(now)
            assert checked.filter("base_failed").isEmpty()
        if name == "near_duplicates":
            groups = {r["component_id"] for r in near_dups.groups(last).collect()}
            assert {r["doc_id"] for r in now.collect()} == groups
        if name == "source_mix":
            before = sum(len(words(r["text"])) for r in last.collect())
            after = sum(len(words(r["text"])) for r in now.collect())
            assert 1.45 * before < after <= 1.5 * before
            assert now.filter(F.length("text") != F.col("n_chars")).isEmpty()
    assert now.count() == last.count() and now.filter("NOT round_trip OR n_tokens <> size(ids)").isEmpty()


def test_run_is_registered(spark):
    assert entry.queries()["pipeline"] is corpus_pipeline.run or callable(entry.queries()["pipeline"])
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "lang", "source", "n_chars", "ids", "n_tokens", "round_trip"]


def test_odd_and_empty_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= 2 * docs.count()
    kept = corpus_pipeline.drop_near_duplicates(spark, odd_docs, SF)
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([1, 2, 3, 4, 5, 6, 7, None, None], key=str)


def test_texts_that_share_an_id_stay(spark):
    """Also beside columns that cannot be ordered or hashed."""
    texts = ["one two three four five six", "seven eight nine ten eleven twelve", "one two three four five six"]
    rows = [(1, texts[0], "en", "s", 1), (1, texts[1], "en", "s", 1), (1, texts[1], "en", "s", 1), (2, texts[2], "en", "s", 1), (3, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("tags", F.create_map(F.lit("a"), F.lit(1)))
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(1, texts[0]), (1, texts[1]), (3, "")])


def test_every_operator_has_its_query():
    names = entry.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14))
