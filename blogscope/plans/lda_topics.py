"""The topic-model path end to end, at corpus level.

Fit: English blogs -> semantic segments -> bigram/trigram phrases -> 1-3-gram TF-IDF weights
-> number of topics by silhouette over segment vectors -> LDA over the weighted terms.
Use: a topic-word table -> re-ranked, scored topics -> each blog's topics, thresholded and
de-duplicated -> taxonomy -> segment reports on the same functions as the TF-IDF path.

The two halves are separate: any (topic_id, words, weights) table can be used, and the
registered queries of the second half take one that SQL can reproduce. Results differ from
per-blog fits by design (one shared topic space).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import phrases, segment_vectors, segments, split_tree, taxonomy, terms, text_rows, topic_factors, topics
from ..session import drop_stage, last_stage, materialize
from ..sources import testdata
from ..sources.tables import read_table
from . import segment_topics as st

SEGMENT_KEY = ["doc_id", "seg_id"]


def semantic_segments(blogs: DataFrame) -> DataFrame:
    """W6 + W7 of the English blogs, written once."""
    rows = blogs.select(F.col("file_id").alias("doc_id"), "sentences", "tokens")
    return materialize(topics.segments_of(rows), "segments")


def corpus_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The semantic segments of the corpus, for what reads nothing else: the blogs' stage is deleted."""
    blogs = st.english_blogs(spark, sf_dir)
    stage = last_stage()
    segs = semantic_segments(blogs)
    drop_stage(spark, stage)
    return segs


def weighted_terms(segs: DataFrame) -> DataFrame:
    """T4-T7 at corpus scope: (doc_id, seg_id, term, cnt, weight), phrases merged first. All
    terms within the document-frequency bounds, however many."""
    phrased = materialize(phrases.detect_phrases(segs, SEGMENT_KEY, []).select(*SEGMENT_KEY, F.col("phrased").alias("tokens")),
                          "phrased-segments")
    return materialize(terms.segment_tfidf(phrased, SEGMENT_KEY, [], max_features=None), "weighted-terms")


def choose_topic_count(segs: DataFrame, vectors) -> int:
    """M4 over segment vectors (the mean of a segment's word vectors)."""
    words = segs.select(*SEGMENT_KEY, F.explode(F.array_distinct("tokens")).alias("word"))
    hit = taxonomy.lookup_vectors(words, vectors)
    dims = hit.select(F.size("vec").alias("n")).first()
    if dims is None:
        return split_tree.choose_k(segs.limit(0).select(F.array(F.lit(0.0)).alias("v")))[0]
    means = hit.groupBy(*SEGMENT_KEY).agg(*[F.avg(F.get("vec", i)).alias(f"v{i}") for i in range(dims["n"])])
    vecs = means.select(*SEGMENT_KEY, F.array(*[F.col(f"v{i}") for i in range(dims["n"])]).alias("v"))
    return split_tree.choose_k(materialize(vecs.select("v"), "segment-vectors"))[0]


def segment_embeddings(segs: DataFrame, dims: int = 8) -> tuple[DataFrame, int]:
    """M5 -> M4 without word vectors: (doc_id, seg_id, v) by a truncated SVD of the corpus's term
    matrix, and the number of topics that the vectors give."""
    matrix = materialize(terms.segment_tfidf(segs, SEGMENT_KEY, [], max_features=None), "term-matrix")
    vectors = materialize(segment_vectors.truncated_svd(matrix, SEGMENT_KEY, dims)[0], "segment-embeddings")
    return vectors, split_tree.choose_k(vectors.select("v"))[0]


def fit(spark: SparkSession, segs: DataFrame, vectors, max_iter: int = 20, words: int = 20, seed: int = 42):
    """M1-M4: (topic-word table, blog topics (doc_id, topic_id), k) of a model with a distributed
    topic-word table and ``max_iter`` passes over the corpus. A blog's topics are those that
    lead one of its segments."""
    weighted = weighted_terms(segs)
    k = choose_topic_count(segs, vectors)
    model = topic_factors.fit(weighted, SEGMENT_KEY, k, max_iter, seed)
    table = materialize(topic_factors.top_words(model, words), "topic-words")
    mixtures = topic_factors.segment_mixtures(weighted, model, SEGMENT_KEY)
    leading = F.array_position("mixture", F.array_max("mixture")).cast("int") - 1
    return table, mixtures.select("doc_id", leading.alias("topic_id")).distinct(), k


def learn_in_batches(segs: DataFrame, state_dir: str, batches: int = 4, k: int = 6) -> topic_factors.Factors:
    """M1 x I1 on a corpus at hand: its blogs dealt to mini-batches by a hash of the id and
    learned one after the other, as ``incremental_topic_model`` does with arriving files."""
    counts = text_rows.token_counts(segs, SEGMENT_KEY, "tokens").withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))
    counts = materialize(counts, "segment-counts", by="batch")
    model = None
    for n in range(batches):
        model = topic_factors.learn_batch(counts.where(F.col("batch") == n), SEGMENT_KEY, state_dir, n, k, written=True)
    return model


def describe(topic_words: DataFrame, vectors) -> DataFrame:
    """M6-M8 + P16 of a topic-word table."""
    return topics.describe_topics(topics.rerank_topic_words(topic_words, vectors))


def classify(blog_topics: DataFrame, described: DataFrame, vectors, spark: SparkSession,
             min_similarity: float = st.LDA_MIN_SIMILARITY, top_n: int = 25) -> DataFrame:
    """(doc_id, classification, pct, rank) of the blogs that kept topics."""
    members, classes = classify_sets(blog_topics, described, vectors, spark, min_similarity, top_n)
    return members.join(classes, "topics").select("doc_id", "classification", "pct", "rank")


def classify_sets(blog_topics: DataFrame, described: DataFrame, vectors, spark: SparkSession,
                  min_similarity: float = st.LDA_MIN_SIMILARITY, top_n: int = 25) -> tuple[DataFrame, DataFrame]:
    """(doc_id, topics) and (topics, classification, pct, rank). The k described topics are
    scored against the taxonomy once, then joined to the sets of topics that blogs kept; the
    best value per key, the ``top_n`` best keys."""
    once = described.select(F.lit(0).cast("long").alias("doc_id"), "topic_id", "words", "weights", "coherence_scores", "topic_quality")
    tv = taxonomy.topic_vectors(taxonomy.select_topic_words(once), vectors)
    sv = taxonomy.subtopic_vectors(taxonomy.fallback_taxonomy(spark), vectors)
    scored = taxonomy.score_subtopics(tv, sv, min_similarity).select(
        "topic_id", "ord", F.concat_ws(":", "major", "subtopic").alias("classification"),
        F.round(F.col("weighted_similarity") * 100, 2).alias("pct"))
    # blogs with the same topics have the same classes, so these are found once per set of topics
    members = (blog_topics.groupBy("doc_id").agg(F.sort_array(F.collect_set("topic_id")).alias("topics"))
               .where(F.size("topics") > 0))
    sets = members.select("topics").distinct()
    best = (sets.select("topics", F.explode("topics").alias("topic_id")).join(scored, "topic_id").groupBy("topics", "classification")
            .agg(F.max("pct").alias("pct"), F.min("ord").alias("ord")))
    w = Window.partitionBy("topics").orderBy(F.col("pct").desc(), F.col("ord").asc())
    classes = (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)
               .select("topics", "classification", "pct", "rank"))
    return members, classes


def fitted(spark: SparkSession, sf_dir: str):
    """(described topics, kept blog topics, vectors) of the fitted model."""
    segs = corpus_segments(spark, sf_dir)
    vecs = testdata.hashed_lookup(read_table(spark, sf_dir, "embeddings"))
    table, shares, _ = fit(spark, segs, vecs)
    described = materialize(describe(table, vecs), "described")
    return described, topics.blog_topics(shares, described), vecs


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    described, kept, vecs = fitted(spark, sf_dir)
    return classify(kept, described, vecs, spark)


# --- the same use-path on topics that SQL can reproduce ---------------------------

SOURCE_TOPIC_WORDS = 20


def source_topics(blogs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Topic-word table and blog shares without a model: a source's topic are the 20 terms
    with the highest TF-IDF over sources (T9); a blog has every topic that holds one of its
    terms, with the share of its tokens that it covers."""
    words = blogs.select("source", F.explode("tokens").alias("term"))
    per_source = materialize(words.groupBy("source", "term").agg(F.count(F.lit(1)).alias("cnt")), "source-terms")
    top = materialize(terms.corpus_tfidf_top(per_source, ["source"], top_n=SOURCE_TOPIC_WORDS)
                      .withColumn("topic_id", F.substring("source", 4, 10).cast("int")), "source-topics")
    words = top.groupBy("topic_id").agg(F.sort_array(F.collect_list(F.struct("rank", "term", "weight"))).alias("w"))
    table = words.select("topic_id", F.transform("w", lambda x: x["term"]).alias("words"),
                         F.transform("w", lambda x: x["weight"]).alias("weights"))
    own = blogs.select(F.col("file_id").alias("doc_id"), F.explode("tokens").alias("term"))
    hits = own.join(top.select("topic_id", "term"), "term").groupBy("doc_id", "topic_id").agg(F.count(F.lit(1)).alias("cnt"))
    sizes = blogs.groupBy(F.col("file_id").alias("_id")).agg(F.sum(F.size("tokens")).alias("n"))
    shares = hits.join(sizes, F.col("doc_id").eqNullSafe(F.col("_id"))).select("doc_id", "topic_id", (F.col("cnt") / F.col("n")).alias("share"))
    return table, shares


def source_topic_run(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All tables of the use-path on source topics, over letter vectors (a word takes the
    vector of its first letter, so that topics and subtopics can come close)."""
    blogs = st.english_blogs(spark, sf_dir, sentences=False)
    vecs = testdata.hashed_lookup(read_table(spark, sf_dir, "embeddings"), letters=1)
    table, shares = source_topics(blogs)
    reranked = materialize(topics.rerank_topic_words(table, vecs), "reranked")
    described = materialize(topics.describe_topics(reranked), "described")
    kept = topics.blog_topics(shares, described)
    pairs = materialize(kept.select("doc_id", "topic_id"), "blog-topics")
    members, per_set = classify_sets(pairs, described, vecs, spark)
    members, per_set = materialize(members, "topic-sets"), materialize(per_set, "set-classes")
    demo = segments.prepare_demographics(blogs.select("file_id", "gender", "age", "industry"))
    maps = members.join(taxonomy.classification_map(per_set.withColumnRenamed("topics", "doc_id")).withColumnRenamed("doc_id", "topics"), "topics")
    docs = demo.join(maps.select(F.col("doc_id").alias("file_id"), "scores"), "file_id", "left")
    classes = members.join(per_set, "topics").select("doc_id", "classification", "pct", "rank")
    return {"topics": table, "shares": shares, "reranked": reranked, "described": described, "kept": kept,
            "classes": classes, "docs": docs}
