"""Streaming twin equals batch; incremental runs never reprocess."""

import os

from pyspark.sql import functions as F

from blogscope.streaming import topic_stream as ts

SF = "/root/testdata/sf0.001"


def test_event_windows_stream_equals_batch(spark, tmp):
    events = spark.read.parquet(f"{SF}/events.parquet")
    src = os.path.join(tmp, "src")
    events.write.parquet(src)
    q = ts.start_event_windows(spark, src, events.schema, os.path.join(tmp, "out"), os.path.join(tmp, "ck"),
                               watermark="0 seconds")
    q.awaitTermination()
    streamed = spark.read.parquet(os.path.join(tmp, "out"))
    batch = ts.event_windows(events)
    # append mode emits only windows closed by the watermark: all but the last one
    last = batch.agg(F.max("window_start")).first()[0]
    assert streamed.exceptAll(batch).count() == 0
    assert batch.where(F.col("window_start") < last).exceptAll(streamed).count() == 0


def test_incremental_topics_add_no_rows_on_rerun(spark, tmp):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    src = os.path.join(tmp, "docs")
    docs.where("doc_id < 100").write.parquet(src)
    out, ck = os.path.join(tmp, "topics"), os.path.join(tmp, "ck")
    ts.incremental_topics(spark, src, docs.schema, out, ck)
    n1 = spark.read.parquet(out).count()
    ts.incremental_topics(spark, src, docs.schema, out, ck)
    assert spark.read.parquet(out).count() == n1 == 100
    docs.where("doc_id >= 100").write.mode("append").parquet(src)
    ts.incremental_topics(spark, src, docs.schema, out, ck)
    assert spark.read.parquet(out).count() == docs.count()


def test_resume_batch(spark, tmp):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    out = os.path.join(tmp, "res")
    ts.resume_batch(spark, docs.where("doc_id < 50"), out)
    all_ = ts.resume_batch(spark, docs, out)
    assert all_.count() == docs.count() and all_.select("doc_id").distinct().count() == docs.count()


def test_incremental_blog_topics(spark, tmp):
    import os

    from blogscope.streaming.topic_stream import incremental_blog_topics
    described = spark.createDataFrame(
        [(0, 0.9, "river_stone", ["river", "stone"], [0.6, 0.4], [0.5, 0.5], 0.5), (1, 0.8, "cloud_storm", ["cloud", "storm"], [0.6, 0.4], [0.5, 0.5], 0.5)],
        "topic_id int, topic_quality double, label string, words array<string>, weights array<double>, coherence_scores array<double>, semantic_coherence double")
    src, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")

    def put(rows):
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("append").parquet(src)

    def run():
        incremental_blog_topics(spark, src, "doc_id long, text string", described, out, os.path.join(tmp, "ck"))
        return sorted((r["doc_id"], r["topic_id"]) for r in spark.read.parquet(out).collect())

    put([(1, "the river bank"), (2, "nothing here")])
    assert run() == [(1, 0)]
    put([(3, "storm over a stone")])
    assert run() == [(1, 0), (3, 0), (3, 1)]
    assert run() == [(1, 0), (3, 0), (3, 1)]
