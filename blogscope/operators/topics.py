"""Topic models at corpus level.

The original fits a tiny model per blog inside a Python loop. Here one model is
fitted over the semantic segments of the whole corpus (``topic_factors``), every
blog gets its topics, and the per-topic steps (re-rank, quality, labels) and
per-blog steps (threshold, de-duplication) are column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bags
from ..functions import text as tx
from . import taxonomy, terms, text_rows


def semantic_segments(df: DataFrame, id_col: str, text_col: str, min_topic_size: int = 5,
                      window: int = 30, step: int = 20) -> DataFrame:
    """W6 + W7: sentences (T3, on raw text) grouped 3 at a time starting every 2nd,
    kept when they have >= ``min_topic_size`` words; when a blog has fewer than 3
    such segments, token windows (``window`` wide, every ``step``) of its T2 tokens
    with >= ``min_topic_size`` tokens are appended. Segments are cleaned (P3) and
    tokenised (T2). Blogs with < 2 segments get none (too little text for topics).

    Output (doc_id, seg_id, tokens).
    """
    df = df.select(F.col(id_col).alias("doc_id"), terms.sentences(F.col(text_col)).alias("sentences"),
                   terms.topic_tokens_of_clean(tx.clean_content(F.col(text_col))).alias("tokens"))
    return segments_of(df, min_topic_size, window, step)


def segments_of(blogs: DataFrame, min_topic_size: int = 5, window: int = 30, step: int = 20) -> DataFrame:
    """W6 + W7 from (doc_id, sentences, tokens), in Arrow batches (``text_rows``): a sentence is tokenised
    once, however many segments hold it, and the work is linear in the text."""
    return text_rows.segments(blogs, min_topic_size, window, step)


def cosine(u: Column, v: Column) -> Column:
    """M9: cosine similarity of two equally long arrays."""
    dot = F.aggregate(F.zip_with(u, v, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    nu = F.sqrt(F.aggregate(u, F.lit(0.0), lambda s, x: s + x * x))
    nv = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return dot / (nu * nv)


def rerank_topic_words(topics: DataFrame, vectors, centroid_words: int = 8) -> DataFrame:
    """M6: centroid of the first 8 words' vectors; keep words with similarity
    > 0.25 among the first 15 or > 0.35 anywhere, in LDA order; fewer than 5 kept
    -> the first 8 words with coherence 0.5. Words without a vector have no
    similarity and are not kept. Adds ``coherence_scores``."""
    ex = topics.select("topic_id", F.posexplode("words").alias("pos", "word"))
    vec = taxonomy.lookup_vectors(ex, vectors)
    cen = taxonomy.mean_vectors(vec.where(F.col("pos") < centroid_words), ["topic_id"], "vec") \
        .withColumnRenamed("vec", "centroid")
    sims = (vec.join(cen, "topic_id")
               .select("topic_id", "pos", cosine(F.col("vec").cast("array<double>"), F.col("centroid")).alias("sim")))
    kept = (sims.where(((F.col("sim") > 0.25) & (F.col("pos") < 15)) | (F.col("sim") > 0.35))
                .groupBy("topic_id").agg(F.sort_array(F.collect_list(F.struct("pos", "sim"))).alias("_k")))
    t = topics.join(kept, "topic_id", "left")
    k = F.coalesce(F.col("_k"), F.array().cast("array<struct<pos:int,sim:double>>"))
    enough = F.size(k) >= 5
    return t.select(
        "topic_id",
        F.when(enough, F.transform(k, lambda x: F.get(F.col("words"), x["pos"]))).otherwise(F.slice("words", 1, 8)).alias("words"),
        F.when(enough, F.transform(k, lambda x: F.get(F.col("weights"), x["pos"]))).otherwise(F.slice("weights", 1, 8)).alias("weights"),
        F.when(enough, F.transform(k, lambda x: x["sim"]))
         .otherwise(F.transform(F.slice("words", 1, 8), lambda _: F.lit(0.5))).alias("coherence_scores"))


def topic_quality(words: Column, weights: Column, coherence: Column) -> Column:
    """M7: 0.5 * coherence part (0.5/0.3/0.2 of the best three, else the mean; at
    most 1) + 0.3 * (1 - entropy / max entropy of the first 8 weights) + 0.2 *
    min(1, distinct 4-char stems of the first 6 words longer than 3 / 4)."""
    top = F.reverse(F.sort_array(coherence))
    n = F.size(coherence)
    mean_coh = F.aggregate(coherence, F.lit(0.0), lambda s, x: s + x) / n
    weighted = F.when(n >= 3, 0.5 * F.get(top, 0) + 0.3 * F.get(top, 1) + 0.2 * F.get(top, 2)).otherwise(mean_coh)
    coh_part = F.least(F.lit(1.0), weighted)

    def distinct_part(w8):
        total = F.aggregate(w8, F.lit(0.0), lambda s, x: s + x)
        ent = F.aggregate(w8, F.lit(0.0), lambda s, x: s - (x / total) * F.log(x / total + F.lit(1e-10)))
        mx = F.log(F.size(w8).cast("double"))
        return F.when((F.size(w8) > 1) & (total > 0),
                      F.when(mx > 0, 1 - ent / mx).otherwise(F.lit(0.0))).otherwise(F.lit(0.0))

    stems = F.array_distinct(F.transform(F.filter(F.slice(words, 1, 6), lambda w: F.length(w) > 3),
                                         lambda w: F.substring(w, 1, 4)))
    richness = F.least(F.lit(1.0), F.size(stems) / 4.0)
    q = 0.5 * coh_part + 0.3 * bags.let(F.slice(weights, 1, 8), distinct_part) + 0.2 * richness
    return F.when((F.size(words) == 0) | (F.size(weights) == 0) | (n == 0), F.lit(0.0)).otherwise(q)


def describe_topics(reranked: DataFrame, num_words: int = 10) -> DataFrame:
    """M7 + M8 + P16 per topic; lists cut to ``num_words``."""
    return reranked.select(
        "topic_id",
        tx.topic_label(F.col("words")).alias("label"),
        F.slice("words", 1, num_words).alias("words"),
        F.slice("weights", 1, num_words).alias("weights"),
        F.slice("coherence_scores", 1, num_words).alias("coherence_scores"),
        topic_quality(F.col("words"), F.col("weights"), F.col("coherence_scores")).alias("topic_quality"),
        (F.aggregate("coherence_scores", F.lit(0.0), lambda s, x: s + x) /
         F.size("coherence_scores")).alias("semantic_coherence"))


def filter_meaningful(candidates: Column, max_topics: int = 3, overlap: float = 0.6) -> Column:
    """W11 + W10 + U2 over a blog's candidate topics (ARRAY<STRUCT<topic_quality,
    words, ...>>, bounded by k): adaptive threshold (max > 0.3 -> 0.7 max, else
    max(0.8 max, mean); at least 0.01), then in quality order drop a topic whose
    top-5 words overlap a kept one by more than 60 % of the smaller set; keep 3."""
    def body(c):
        qs = F.transform(c, lambda t: t["topic_quality"])
        mx = F.array_max(qs)
        mean = F.aggregate(qs, F.lit(0.0), lambda s, x: s + x) / F.size(qs)
        thr = F.greatest(F.when(mx > 0.3, 0.7 * mx).otherwise(F.greatest(0.8 * mx, mean)), F.lit(0.01))
        ordered = F.transform(F.reverse(F.sort_array(F.transform(
            c, lambda t, i: F.struct(t["topic_quality"].alias("q"), (-i).alias("neg_i"), t.alias("t"))))),
            lambda x: x["t"])
        above = F.filter(ordered, lambda t: t["topic_quality"] >= thr)

        def keep(acc, t):
            tw = F.array_distinct(F.slice(t["words"], 1, 5))
            dup = F.exists(acc, lambda e: (
                F.size(F.array_intersect(tw, F.array_distinct(F.slice(e["words"], 1, 5))))
                / F.least(F.size(tw), F.size(F.array_distinct(F.slice(e["words"], 1, 5))))) > overlap)
            return F.when(dup, acc).otherwise(F.concat(acc, F.array(t)))
        empty = F.slice(above, 1, 0)
        return F.slice(F.aggregate(above, empty, keep), 1, max_topics)
    return F.when(F.size(candidates) > 0, bags.let(candidates, body)).otherwise(candidates)


def blog_topics(shares: DataFrame, described: DataFrame) -> DataFrame:
    """Per blog: its topics (doc_id, topic_id), described, then W11/W10. At most k topics
    meet per blog."""
    j = shares.select("doc_id", "topic_id").distinct().join(described, "topic_id")
    cand = j.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(
        "topic_id", "topic_quality", "label", "words", "weights", "coherence_scores",
        "semantic_coherence"))).alias("cand"))
    kept = cand.select("doc_id", filter_meaningful(F.col("cand")).alias("topics"))
    return kept.select("doc_id", F.explode("topics").alias("t")).select("doc_id", "t.*")


def blog_summary(topics: DataFrame) -> DataFrame:
    """A12 + P18: topic count, mean quality, valid words and label parts per blog."""
    return topics.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("num_topics"), F.avg("topic_quality").alias("average_topic_quality"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(tx.valid_topic_words(F.col("words")))))).alias("words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(tx.label_parts(F.col("label")))))).alias("topic_labels"))
