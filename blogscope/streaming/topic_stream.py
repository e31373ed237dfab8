"""Incremental and streaming variants.

* ``event_windows``: E5, "real-time topic tracking" as tumbling-window counts per
  event type; the same function serves a static DataFrame (batch twin) and a
  streaming one (with a watermark, so state is dropped once a window is final).
* ``topics_over_time``, ``terms_over_time``: E6, of topics and of texts.
* ``incremental_topics``: I1(b), the resumable extraction as a file-source stream
  with ``trigger(availableNow=True)``: each run processes only files it has not
  seen (the checkpoint records them) and appends results; re-running adds nothing.
* ``incremental_blog_topics``: the same for the topic model, from a fixed topic table.
* ``incremental_topic_model``: the model itself learns file by file, its state durable.
* ``resume_batch``: I1(a), the same contract for a plain batch job: skip ids that
  already have output (left anti join), append the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import bags
from ..operators import terms, topic_factors, topics
from ..functions import text as tx
from ..sources.tables import skip_processed, stage_exists


def event_windows(events: DataFrame, window: str = "1 hour", watermark: str | None = None,
                  key: str = "event_type") -> DataFrame:
    """E5: counts and value sums per tumbling window and key (event time as
    TIMESTAMP: watermarks need it; the session time zone is UTC)."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if watermark:
        events = events.withWatermark("ts", watermark)
    g = events.groupBy(F.window("ts", window).alias("w"), key).agg(
        F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    key, "events", "value")


def topics_over_time(rows: DataFrame, ts: str, topic: str) -> DataFrame:
    """Per month and topic the rows, their share of the month, the topic's rank in it
    (ties by name) and the change of its share since the month before it appeared in."""
    month = F.date_format(F.date_trunc("month", F.col(ts).cast("timestamp")), "yyyy-MM")
    n = rows.groupBy(month.alias("month"), F.col(topic).alias("topic")).agg(F.count(F.lit(1)).alias("n"))
    n = n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("month")))
    rank = F.row_number().over(Window.partitionBy("month").orderBy(F.col("n").desc(), "topic"))
    change = F.col("share") - F.lag("share").over(Window.partitionBy("topic").orderBy("month"))
    return n.select("month", "topic", "n", F.round("share", 6).alias("share"), rank.cast("long").alias("rank"),
                    F.round(change, 6).alias("change"))


def terms_over_time(rows: DataFrame, ts: str, tokens: str, top_n: int = 10) -> DataFrame:
    """E6 on text: per month the ``top_n`` terms by count x idf, where the idf knows only the
    months before, ``ln((1 + texts before) / (1 + texts before with the term)) + 1``, so that a
    month's terms never change when later ones arrive. Weights are rounded to 6 digits, ties go
    to the smaller term; texts without a date or a token count nothing.

    Texts become (month, term, count, texts) inside partial aggregates; the running sum per
    term sees at most one row a month, and the months themselves are one small array."""
    month = F.date_format(F.date_trunc("month", F.col(ts).cast("timestamp")), "yyyy-MM")
    docs = rows.where(F.col(ts).isNotNull() & (F.size(tokens) > 0)).select(
        month.alias("month"), F.explode(bags.term_counts(F.col(tokens))).alias("b"))
    n = docs.groupBy("month", F.col("b.term").alias("term")).agg(
        F.sum(F.col("b.cnt")).cast("long").alias("cnt"), F.count(F.lit(1)).alias("texts"))
    sizes = (rows.where(F.col(ts).isNotNull() & (F.size(tokens) > 0)).groupBy(month.alias("month"))
                 .agg(F.count(F.lit(1)).alias("n")))
    months = sizes.agg(F.sort_array(F.collect_list(F.struct("month", "n"))).alias("m"))  # one row a month
    before = months.select(F.explode(F.transform("m", lambda x, i: F.struct(
        x["month"].alias("month"), F.aggregate(F.slice("m", 1, i), F.lit(0).cast("long"), lambda a, y: a + y["n"]).alias("before")))).alias("x")).select("x.*")
    earlier = Window.partitionBy("term").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    seen = n.withColumn("seen", F.coalesce(F.sum("texts").over(earlier), F.lit(0)))
    weight = F.col("cnt") * (F.log((F.lit(1.0) + F.col("before")) / (F.lit(1.0) + F.col("seen"))) + 1)
    weighed = seen.join(before, "month").withColumn("weight", F.round(weight, 6))
    rank = F.row_number().over(Window.partitionBy("month").orderBy(F.col("weight").desc(), "term"))
    return (weighed.withColumn("rank", rank).where(F.col("rank") <= top_n)
                   .select("month", F.col("rank").cast("long").alias("rank"), "term", "cnt", "texts", "weight"))


def start_event_windows(spark: SparkSession, source_dir: str, schema, sink_dir: str, checkpoint: str,
                        window: str = "1 hour", watermark: str = "10 minutes", available_now: bool = True):
    """E5 as a stream: parquet files arriving in ``source_dir`` -> windowed counts
    appended (final windows only, after the watermark passes) to ``sink_dir``."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    agg = event_windows(stream, window, watermark)
    w = (agg.writeStream.outputMode("append").format("parquet")
            .option("path", sink_dir).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def topics_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """T8 on one batch of documents (row-local): (doc_id, words, weights, topic_quality)."""
    toks = terms.topic_tokens(tx.clean_html_if_needed(tx.clean_content(F.col(text_col))))
    t = df.select(F.col(id_col).alias("doc_id"), terms.tfidf_topic(toks).alias("t"))
    return t.select("doc_id", "t.words", "t.weights", "t.topic_quality", "t.label")


def incremental_topics(spark: SparkSession, source_dir: str, schema, out_dir: str, checkpoint: str):
    """I1(b): process the files of ``source_dir`` not processed before; append topics."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    q = (topics_of(stream).writeStream.format("parquet").outputMode("append")
         .option("path", out_dir).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def incremental_blog_topics(spark: SparkSession, source_dir: str, schema, described: DataFrame, out_dir: str,
                            checkpoint: str):
    """I1 for the topic model: blogs of files not processed before get their topics from a
    fixed, described topic table (a topic is a candidate if it holds one of the blog's terms),
    thresholded and de-duplicated. Each micro-batch overwrites its own folder, so that a batch
    which is run again after a failure adds nothing."""
    words = described.select("topic_id", F.explode("words").alias("term"))

    def write(batch: DataFrame, number: int) -> None:
        toks = batch.select("doc_id", F.explode(F.array_distinct(terms.topic_tokens_of_clean(tx.clean_content("text")))).alias("term"))
        shares = toks.join(words, "term").select("doc_id", "topic_id")
        topics.blog_topics(shares, described).write.mode("overwrite").parquet(f"{out_dir}/batch={number}")

    q = (spark.readStream.schema(schema).parquet(source_dir).writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def incremental_topic_model(spark: SparkSession, source_dir: str, schema, state_dir: str, checkpoint: str, k: int = 6,
                            files_per_batch: int = 1):
    """M1 x I1: the topic model learns from the files of ``source_dir`` not processed before,
    ``files_per_batch`` to a mini-batch: blogs become segments (W6, W7), their term counts update
    the factors in ``state_dir`` (``topic_factors.learn_batch``). A micro-batch that Spark runs
    again finds its state complete, or makes it anew from the one before."""
    key = ["doc_id", "seg_id"]

    def learn(batch: DataFrame, number: int) -> None:
        segs = topics.semantic_segments(batch, "doc_id", "text")
        counts = terms.exploded_counts(segs, key, "tokens").withColumn("weight", F.col("cnt").cast("double"))
        topic_factors.learn_batch(counts, key, state_dir, number, k)

    q = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source_dir)
         .writeStream.foreachBatch(learn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def resume_batch(spark: SparkSession, todo: DataFrame, out_dir: str, key: str = "doc_id") -> DataFrame:
    """I1(a) + J2 + U1: compute topics only for ids without output yet, append them,
    and return previous + new results."""
    if stage_exists(spark, out_dir):
        todo = skip_processed(todo, spark.read.parquet(out_dir), key)
    topics_of(todo).write.mode("append").parquet(out_dir)
    return spark.read.parquet(out_dir)
