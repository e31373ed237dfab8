"""The TF-IDF path end to end: blogs -> English, cleaned -> top terms per blog ->
taxonomy scores per blog -> scores and specificity per demographic segment.

Shuffle boundaries: the labels join (document key), the term-to-vector join
(word key), the per-topic vector fold (topic key), the best-key aggregation
(document, key), the per-blog map (document) and the segment aggregation
(segment, classification; partially aggregated). Everything per document in
between (language vote, clean-up, tokens, term counts, TF-IDF, percentile
selection) is row-local.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import language, segments, taxonomy, terms, text_rows
from ..sources import testdata
from ..sources.tables import read_table
from ..session import materialize as materialize_stage

TFIDF_MIN_SIMILARITY = 0.10
LDA_MIN_SIMILARITY = 0.50


def prepare_blogs(blogs: DataFrame, english_only: bool = True) -> DataFrame:
    """P2 (vote) on the raw text, P3 clean-up, P4 industry, P6 English filter."""
    out = language.with_language(blogs, "content")
    if english_only:
        out = out.where(F.col("content_language") == "en")
    return (out.withColumn("content", tx.clean_content("content"))
               .withColumn("industry", tx.clean_industry("industry")))


def english_blogs(spark: SparkSession, sf_dir: str, sentences: bool = True) -> DataFrame:
    """English blogs as later stages read them: (file_id, gender, age, industry, source,
    tokens, sentences), without ``sentences`` where nothing reads them. The raw text is read once, voted on, cleaned and cut here, and the
    stage is written to the shared checkpoint folder; whatever reads it prunes to the columns
    it needs, and a lost executor re-reads files instead of repeating text work."""
    blogs = testdata.blogs_with_demographics(spark, sf_dir).select(
        "file_id", "gender", "age", tx.clean_industry("industry").alias("industry"), "source", "content")
    return materialize_stage(text_rows.texts_of(blogs, "content", sentences=sentences), "english-blogs")


def english_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_id, sentences) of the English blogs, as a stage. What asks for sentences alone needs
    no demographics, so the texts are not joined and never shuffled."""
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file_id"), F.col("text").alias("content"))
    return materialize_stage(text_rows.texts_of(docs, "content", tokens=False), "english-blogs")


def english_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_id, gender, age, industry, tokens) of the English blogs."""
    return english_blogs(spark, sf_dir, sentences=False).select("file_id", "gender", "age", "industry", "tokens")


def tfidf_topics_from_tokens(toks: DataFrame, top_n: int = 5, max_features: int = 1000) -> DataFrame:
    """T8 per blog: one topic (topic_id 0) per blog with at least one term."""
    t = toks.select(F.col("file_id").alias("doc_id"),
                    terms.tfidf_topic(F.col("tokens"), top_n=top_n, max_features=max_features).alias("t"))
    # Blogs without terms leave through the explode (no filter operator: a filter on
    # the derived column would be pushed down and evaluate the TF-IDF twice).
    t = t.select("doc_id", F.explode(F.filter(F.array("t"), lambda x: F.size(x["words"]) > 0)).alias("t"))
    return t.select("doc_id", F.lit(0).alias("topic_id"), F.col("t.label").alias("label"),
                    F.col("t.words").alias("words"), F.col("t.weights").alias("weights"),
                    F.lit(None).cast("array<double>").alias("coherence_scores"),
                    F.col("t.topic_quality").alias("topic_quality"))


def classify_tokens(spark: SparkSession, sf_dir: str, toks: DataFrame,
                    min_similarity: float = TFIDF_MIN_SIMILARITY, top_n: int = 25) -> DataFrame:
    """X4 per blog: (doc_id, classification, pct, rank)."""
    topics = tfidf_topics_from_tokens(toks)
    tax = taxonomy.fallback_taxonomy(spark)
    vecs = testdata.hashed_lookup(read_table(spark, sf_dir, "embeddings"))
    return taxonomy.classify_topics(topics, tax, vecs, top_n=top_n, min_similarity=min_similarity)


def classified(spark: SparkSession, sf_dir: str, min_similarity: float = TFIDF_MIN_SIMILARITY,
               top_n: int = 25) -> DataFrame:
    return classify_tokens(spark, sf_dir, english_tokens(spark, sf_dir), min_similarity, top_n)


def blogs_with_scores(spark: SparkSession, sf_dir: str,
                      min_similarity: float = TFIDF_MIN_SIMILARITY) -> DataFrame:
    """English blogs with demographics and their classification map (NULL if none)."""
    toks = english_tokens(spark, sf_dir)
    maps = taxonomy.classification_map(classify_tokens(spark, sf_dir, toks, min_similarity))
    demo = segments.prepare_demographics(toks.select("file_id", "gender", "age", "industry"))
    return demo.join(maps.withColumnRenamed("doc_id", "file_id"), "file_id", "left")


def segment_report(spark: SparkSession, sf_dir: str, level: str = "category",
                   kind: str = "score") -> DataFrame:
    """Ranked scores (``kind='score'``) or specificity (``kind='specificity'``)
    per segment at category or subcategory ``level``."""
    docs = blogs_with_scores(spark, sf_dir)
    scores = segments.segment_scores(docs, segments.default_segments(), "scores", level)
    if kind == "score":
        return segments.rank_within(scores, "average_weighted_score")
    return segments.rank_within(segments.specificity(scores), "popularity_bias_score")


def with_error(blogs: DataFrame, content: str = "content", tokens: str | None = None) -> DataFrame:
    """Per-row failure reason instead of an exception (NULL when the row is fine):
    no content, or no term left after tokenising."""
    c = F.col(content)
    err = F.when(c.isNull() | (F.length(tx.strip_ws(c)) == 0), F.lit("empty content"))
    if tokens:
        err = err.when(F.size(tokens) == 0, F.lit("no terms"))
    return blogs.withColumn("error", err)
