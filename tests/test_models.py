"""The fitted model path, linear per-document work, and the batch job with both methods."""

import os
import time

import pytest
from pyspark.sql import functions as F

from blogscope.operators import phrases, terms, topics
from blogscope.plans import batch_job, lda_topics
from blogscope.plans import segment_topics as st
from blogscope.sources import testdata
from blogscope.sources.tables import read_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fitted(spark):
    segs = lda_topics.semantic_segments(st.english_blogs(spark, SF))
    vecs = testdata.hashed_lookup(read_table(spark, SF, "embeddings"))
    return segs, vecs, lda_topics.fit(spark, segs, vecs, max_iter=5)


def test_lda_fit(spark, fitted):
    segs, vecs, (table, shares, k) = fitted
    assert 2 <= k <= 6
    rows = table.collect()
    assert len(rows) == k and all(len(r["words"]) == 20 == len(r["weights"]) for r in rows)
    assert all(list(r["weights"]) == sorted(r["weights"], reverse=True) and r["weights"][0] > 0 for r in rows)
    again = lda_topics.fit(spark, segs, vecs, max_iter=5)
    assert again[2] == k and [r["words"][:3] for r in again[0].collect()] == [r["words"][:3] for r in rows]
    assert shares.groupBy("doc_id").count().where(F.col("count") > k).count() == 0


def test_model_vocabulary_is_not_cut(spark, fitted):
    weighted = lda_topics.weighted_terms(fitted[0])
    assert weighted.select("term").distinct().count() > 1000
    norms = weighted.groupBy("doc_id", "seg_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n"))
    assert norms.where(F.abs(F.col("n") - 1) > 1e-9).count() == 0


def test_blog_topics_and_summary(spark, fitted):
    _, vecs, (table, shares, _) = fitted
    described = lda_topics.describe(table, vecs)
    for r in described.collect():
        assert 0 <= r["topic_quality"] <= 1 and len(r["words"]) <= 10
    kept = topics.blog_topics(shares, described)
    assert kept.groupBy("doc_id").count().where(F.col("count") > 3).count() == 0
    summary = topics.blog_summary(kept).collect()
    assert summary and all(1 <= r["num_topics"] <= 3 for r in summary)


def test_batch_job_with_both_methods(spark, tmp_path):
    written = batch_job.run(spark, SF, str(tmp_path))
    assert len(written) == 8 and all(os.path.isdir(p) for p in written.values())


def long_blog(spark, sentences):
    text = " ".join(f"Word{k % 97} stands beside lamp{k % 13} and river{k % 7} here." for k in range(sentences))
    return spark.createDataFrame([(1, text)], "doc_id long, text string")


@pytest.mark.parametrize("work", ["segments", "ngrams", "merge"])
def test_work_is_linear_in_a_long_document(spark, work):
    def run(sentences):
        df = long_blog(spark, sentences)
        if work == "segments":
            return topics.semantic_segments(df, "doc_id", "text").agg(F.count("*"), F.sum(F.size("tokens"))).collect()
        toks = df.select(terms.topic_tokens("text").alias("t"))
        if work == "ngrams":
            return toks.select(F.size(terms.ngrams(F.col("t")))).collect()
        flags = F.transform("t", lambda t: F.length(t) > 4)
        return toks.select(F.size(phrases.greedy_merge(F.col("t"), flags))).collect()

    def seconds(sentences):
        best = 1e9
        for _ in range(3):
            t = time.perf_counter()
            run(sentences)
            best = min(best, time.perf_counter() - t)
        return best

    run(500)
    assert seconds(12_000) < 6 * max(seconds(3_000), 0.15)


def test_unpunctuated_text_goes_through(spark):
    text = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26 % 26)} lamp" for k in range(10_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    segs = topics.semantic_segments(df, "doc_id", "text")
    assert segs.count() > 100
    assert terms.segment_tfidf(segs, ["doc_id", "seg_id"], ["doc_id"]).count() > 100
    toks = df.select("doc_id", F.lit(0).alias("sent_id"), terms.topic_tokens("text").alias("tokens"))
    out = phrases.detect_phrases(toks, ["doc_id", "sent_id"], ["doc_id"]).first()
    assert " ".join(out["phrased"]).replace("_", " ") == " ".join(toks.first()["tokens"])
