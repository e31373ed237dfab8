"""Registered queries over the driver tables, one per operator family of the survey.

Each function takes (spark, sf_dir) and returns a DataFrame whose columns and
rounding match its SQL twin in ``oracle_sql.py``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import text as tx
from ..operators import gram_blocks, language, lemmas, phrases, report_state, segment_vectors, segments, split_tree, taxonomy, terms, topic_factors, topics, word_vectors
from ..sources import blogfiles, testdata
from ..sources.tables import (attach_metadata, decode_json_map, encode_json, first_rows, read_table, require_columns,
                              skip_processed, union_results)
from ..session import checkpoint_dir, materialize
from . import lda_topics
from . import segment_topics as st

# FIXED VALUES: which month-name language renders the dates of each event type.
EVENT_DATE_LANGUAGE = {"view": "en", "error": "fr", "purchase": "de", "click": "es", "signup": "en"}


def s1_file_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dotted name parts (URL host as file name), missing parts NULL, id."""
    p = testdata.pages_as_files(spark, sf_dir)
    out = p.select("page_id", *blogfiles.metadata_from_name("file_name"))
    # md5 here so SQL can reproduce it; the library id is xxhash64 (file_id)
    return out.withColumn("id", F.md5(F.concat_ws(".", *blogfiles.META_PARTS)))


def s3_page_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: inner text of every <p> element, position kept."""
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", F.posexplode(blogfiles.element_texts(F.col("html"), "p")).alias("pos", "content"))


def a1_blogs_from_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: conversation turns as posts -> one blog text per conversation."""
    posts = testdata.posts_from_conversations(spark, sf_dir)
    return blogfiles.blogs_from_posts(posts, date=None)


def p2_language_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", "lang", language.detect_language("text").alias("content_language"))


def a2_language_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_distribution(p2_language_vote(spark, sf_dir))


def p3_clean_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    c = tx.clean_content("text")
    return d.select("doc_id", F.md5(c).alias("clean_md5"), F.length(c).alias("clean_length"))


def p5_clean_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages")
    c = tx.clean_html("html")
    return p.select("page_id", F.md5(c).alias("clean_md5"), F.length(c).alias("clean_length"))


def s11_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON object text -> map -> (key, count, sum)."""
    e = read_table(spark, sf_dir, "events")
    kv = e.select(F.explode(decode_json_map("props")).alias("key", "value"))
    return kv.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))


def p1_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times rendered as ``day,month-name,year`` (language by event type)
    and parsed back."""
    e = read_table(spark, sf_dir, "events")
    names = F.create_map(*[x for et, lang in sorted(EVENT_DATE_LANGUAGE.items())
                           for x in (F.lit(et), F.array(*[F.lit(m) for m in lx.MONTH_NAMES[lang]]))])
    month = F.element_at(F.element_at(names, F.col("event_type")), F.month("ts"))
    text = F.concat_ws(",", F.dayofmonth("ts"), month, F.year("ts"))
    return e.select("event_id", text.alias("date_text")).withColumn(
        "parsed_date", blogfiles.parse_day_first_date("date_text"))


def w8_word_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    wf = terms.word_frequencies(terms.frequency_tokens("text"))
    return d.select("doc_id", wf.alias("wf")).select(
        "doc_id", F.array_join("wf.most_common", ",").alias("most_common"),
        F.array_join("wf.least_common", ",").alias("least_common"))


def t3_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    s = terms.sentences("text")
    return d.select("doc_id", F.size(s).cast("long").alias("n_sentences"),
                    F.aggregate(s, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("total_chars"))


def t9_corpus_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    toks = st.english_tokens(spark, sf_dir).withColumnRenamed("file_id", "doc_id")
    counts = materialize(terms.exploded_counts(toks, ["doc_id"], "tokens"), "document-terms")
    top = terms.corpus_tfidf_top(counts, ["doc_id"], top_n=5)
    return top.select("doc_id", F.col("rank").cast("long").alias("rank"), "term",
                      F.round("weight", 6).alias("weight"))


def _segment_counts(blogs: DataFrame) -> DataFrame:
    """(demographic, term, cnt), written once. Counted per combination of demographics
    first (a few dozen), so only aggregated rows are copied to the segments."""
    docs = segments.prepare_demographics(blogs)
    keys = ["gender", "age_group", "is_student"]
    counts = terms.exploded_counts(docs, [*keys, "file_id"], "tokens").groupBy(*keys, "term").agg(F.sum("cnt").alias("cnt"))
    return materialize(segments.fan_out(counts, segments.default_segments())
                       .groupBy("demographic", "term").agg(F.sum("cnt").alias("cnt")), "segment-terms")


def e2_segment_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = terms.top_terms_by_count(_segment_counts(st.english_blogs(spark, sf_dir, sentences=False)), ["demographic"], n=2)
    return top.select("demographic", F.col("rank").cast("long").alias("rank"), "term", "cnt")


def e3_segment_tfidf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = terms.corpus_tfidf_top(_segment_counts(st.english_blogs(spark, sf_dir, sentences=False)), ["demographic"], top_n=2, few_documents=True)
    return top.select("demographic", F.col("rank").cast("long").alias("rank"), "term",
                      F.round("weight", 6).alias("weight"))


QUERIES = {
    "s1_file_metadata": s1_file_metadata,
    "s3_page_posts": s3_page_posts,
    "a1_blogs_from_posts": a1_blogs_from_posts,
    "p2_language_vote": p2_language_vote,
    "a2_language_distribution": a2_language_distribution,
    "p3_clean_content": p3_clean_content,
    "p5_clean_html": p5_clean_html,
    "s11_json_props": s11_json_props,
    "p1_date_parse": p1_date_parse,
    "w8_word_frequencies": w8_word_frequencies,
    "t3_sentences": t3_sentences,
    "t9_corpus_tfidf": t9_corpus_tfidf,
    "e2_segment_top_terms": e2_segment_top_terms,
    "e3_segment_tfidf_terms": e3_segment_tfidf_terms,
}


# --- model queries (no SQL twin: iterative fits; the driver checks rows only) ----

def m1_lda_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus LDA topics with re-ranked words, quality, coherence."""
    described, _, _ = lda_topics.fitted(spark, sf_dir)
    return described.select("topic_id", "label", F.array_join("words", " ").alias("words_text"),
                            F.round("topic_quality", 6).alias("topic_quality"),
                            F.round("semantic_coherence", 6).alias("semantic_coherence"))


def w10_blog_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 + W11 + W10 + A12: each blog's kept topics (at most 3) and summary."""
    s = topics.blog_summary(lda_topics.fitted(spark, sf_dir)[1])
    return s.select("doc_id", "num_topics", F.round("average_topic_quality", 6).alias("average_topic_quality"),
                    F.array_join("words", " ").alias("words_text"))


def x3_lda_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LDA topics on the taxonomy (min similarity 0.50)."""
    return lda_topics.classified(spark, sf_dir).withColumn("rank", F.col("rank").cast("long"))


def m4_choose_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: silhouette of every stage of the splitting tree over the embedding vectors."""
    emb = read_table(spark, sf_dir, "embeddings").select(F.col("embedding").cast("array<double>").alias("v"))
    best, scores = split_tree.choose_k(emb)
    return spark.createDataFrame([(k, s, k == best) for k, s in scores], "k INT, silhouette DOUBLE, chosen BOOLEAN")


QUERIES.update({
    "m1_lda_topics": m1_lda_topics,
    "w10_blog_topics": w10_blog_topics,
    "x3_lda_taxonomy": x3_lda_taxonomy,
    "m4_choose_k": m4_choose_k,
})


def e5_event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 batch twin: hourly counts per event type (the stream runs the same function)."""
    from ..streaming.topic_stream import event_windows
    return event_windows(read_table(spark, sf_dir, "events")).withColumn("value", F.round("value", 6))


QUERIES["e5_event_windows"] = e5_event_windows


def t5_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-blog bigram then trigram phrases over all sentences of English blogs. A blog
    is a row, so all of it happens inside the row."""
    lists = F.transform("sentences", lambda x: F.filter(F.split(tx.clean_content(x), " "), lambda t: t != ""))
    blogs = st.english_sentences(spark, sf_dir).select(F.col("file_id").alias("doc_id"), lists.alias("lists"))
    out = phrases.phrases_in_rows(blogs, "lists").select("doc_id", F.explode("phrased").alias("p"))
    return out.select("doc_id", F.col("p.pos").cast("long").alias("sent_id"),
                      F.array_join("p.tokens", " ").alias("phrased"))


QUERIES["t5_phrases"] = t5_phrases


def w6_semantic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6 + W7: semantic segments of English blogs as cleaned topic tokens."""
    rows = st.english_blogs(spark, sf_dir).select(F.col("file_id").alias("doc_id"), "sentences", "tokens")
    return topics.segments_of(rows).select("doc_id", F.col("seg_id").cast("long").alias("seg_id"),
                                           F.array_join("tokens", " ").alias("tokens_text"))


def e1_top_term_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per segment, the sentences of its blogs that contain both of the segment's two
    most frequent terms (E2)."""
    blogs = st.english_blogs(spark, sf_dir)
    top = terms.top_terms_by_count(_segment_counts(blogs), ["demographic"], n=2)
    pair = top.groupBy("demographic").agg(F.collect_list("term").alias("pair"))  # 2 terms per segment
    docs = segments.prepare_demographics(blogs)
    own = docs.select("file_id", segments.segment_names(segments.default_segments()).alias("demographics"),
                      F.posexplode("sentences").alias("sent_id", "text"))
    toks = own.withColumn("toks", terms.topic_tokens_of_clean(tx.clean_content(F.col("text"))))
    # the pair table has one row per segment (7): broadcast
    hits = (toks.select("file_id", "sent_id", "text", "toks", F.explode("demographics").alias("demographic"))
                .join(F.broadcast(pair), "demographic")
                .where(F.size(F.array_intersect("toks", "pair")) == F.size("pair")))
    return hits.select("demographic", "file_id", F.col("sent_id").cast("long").alias("sent_id"), "text")


def m1_incremental_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 x I1: the 20 likeliest words of every topic after the blogs were learned in four
    mini-batches (rows only)."""
    segs = lda_topics.corpus_segments(spark, sf_dir)
    model = lda_topics.learn_in_batches(segs, f"{checkpoint_dir(spark).rstrip('/')}/topic-state-{uuid.uuid4().hex}")
    return topic_factors.top_words(model).select("topic_id", F.array_join("words", " ").alias("words_text"),
                                                 F.lit(model.segments).alias("segments"))


QUERIES["m1_incremental_topics"] = m1_incremental_topics
QUERIES["w6_semantic_segments"] = w6_semantic_segments
QUERIES["e1_top_term_sentences"] = e1_top_term_sentences


def _matrix_digest(rows: DataFrame) -> DataFrame:
    """Every row of a term matrix per segment: how many terms, which, and their weights' sum."""
    sums = F.aggregate("entries", F.lit(0.0), lambda s, x: s + x["weight"])
    return rows.select("doc_id", F.col("seg_id").cast("long").alias("seg_id"), F.size("entries").cast("long").alias("n_terms"),
                       F.round(sums, 5).alias("weight_sum"),
                       F.md5(F.array_join(F.sort_array(F.transform("entries", lambda x: x["term"])), ",")).alias("terms_md5"))


def t7_segment_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per blog, 1-3-gram TF-IDF over its semantic segments; the whole matrix."""
    segs = lda_topics.semantic_segments(st.english_blogs(spark, sf_dir))
    return _matrix_digest(gram_blocks.term_rows(segs, lda_topics.SEGMENT_KEY, ["doc_id"], max_features=1000))


def t7_corpus_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 at corpus scope: one vocabulary for all segments, no cut."""
    segs = lda_topics.semantic_segments(st.english_blogs(spark, sf_dir))
    return _matrix_digest(gram_blocks.term_rows(segs, lda_topics.SEGMENT_KEY, []))


def m5_projected_gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: the Gram matrix of the corpus matrix (T7) projected on 16 directions, the numbers
    from which the truncated SVD starts."""
    segs = lda_topics.semantic_segments(st.english_blogs(spark, sf_dir))
    rows = gram_blocks.term_rows(segs, lda_topics.SEGMENT_KEY, [], directions=16)
    return segment_vectors.gram(rows, 16).select("i", "j", F.round("g", 4).alias("g"))


def m5_segment_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 + M4: every segment's vector by the truncated SVD of the corpus matrix, and the number
    of topics that these vectors give (rows only)."""
    segs = lda_topics.corpus_segments(spark, sf_dir)
    vectors, k = lda_topics.segment_embeddings(segs)
    return vectors.select("doc_id", F.col("seg_id").cast("long").alias("seg_id"),
                          F.transform("v", lambda x: F.round(x, 6)).alias("v"), F.lit(k).cast("long").alias("topics"))


QUERIES["m5_projected_gram"] = m5_projected_gram
QUERIES["m5_segment_vectors"] = m5_segment_vectors
QUERIES["t7_corpus_tfidf"] = t7_corpus_tfidf
QUERIES["t7_segment_tfidf"] = t7_segment_tfidf


def e4_method_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agreement of the two term methods (count, TF-IDF) on each segment's top 2."""
    counts = _segment_counts(st.english_blogs(spark, sf_dir, sentences=False))
    by_count = terms.top_terms_by_count(counts, ["demographic"], n=2)
    by_tfidf = terms.corpus_tfidf_top(counts, ["demographic"], top_n=2, few_documents=True)
    return segments.method_agreement(by_count, by_tfidf, "term")


def p2b_language_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 (b): Naive Bayes on character trigrams, trained on four fifths of the documents by
    a hash of the id; agreement with the label per language on the rest (rows only)."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    model = language.fit_language_model(d.where(~held))
    pred = language.predict_language(model, d.where(held))
    return pred.groupBy("lang").agg(F.count(F.lit(1)).alias("documents"),
                                    F.sum((F.col("predicted") == F.col("lang")).cast("long")).alias("agree"))


def m5_word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: Word2Vec vectors from the semantic segments (rows only)."""
    v = word_vectors.word_vectors(lda_topics.corpus_segments(spark, sf_dir))
    return v.select("word", F.size("vec").alias("dims"),
                    F.round(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)), 6).alias("norm"))


QUERIES["e4_method_agreement"] = e4_method_agreement
QUERIES["p2b_language_bayes"] = p2b_language_bayes
QUERIES["m5_word_vectors"] = m5_word_vectors


def m7_topic_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 + P16 on the TF-IDF topics (coherence 0.5 for every word, as on that path)."""
    t = st.tfidf_topics_from_tokens(st.english_tokens(spark, sf_dir))
    coh = F.transform("words", lambda _: F.lit(0.5))
    return t.select("doc_id", tx.topic_label(F.col("words")).alias("label"),
                    F.round(topics.topic_quality(F.col("words"), F.col("weights"), coh), 6).alias("topic_quality"))


QUERIES["m7_topic_quality"] = m7_topic_quality


# --- the model path's use half on topics that SQL can reproduce -------------------


def _source_run(table: str, *columns: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return lda_topics.source_topic_run(spark, sf_dir)[table].selectExpr(*columns)
    return run


def a12_blog_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 + P18 of each blog's kept topics."""
    s = topics.blog_summary(lda_topics.source_topic_run(spark, sf_dir)["kept"])
    return s.select("doc_id", "num_topics", F.round("average_topic_quality", 6).alias("average_topic_quality"),
                    F.array_join("words", " ").alias("words_text"), F.array_join("topic_labels", " ").alias("labels_text"))


def _source_report(level: str, kind: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = lda_topics.source_topic_run(spark, sf_dir)["docs"]
        scores = segments.segment_scores(docs, segments.default_segments(), "scores", level)
        out = (segments.rank_within(scores, "average_weighted_score") if kind == "score"
               else segments.rank_within(segments.specificity(scores), "popularity_bias_score"))
        return out.withColumn("rank", F.col("rank").cast("long"))
    return run


QUERIES.update({
    "m3_topic_shares": _source_run("shares", "doc_id", "topic_id", "round(share, 6) AS share"),
    "m6_reranked_words": _source_run("reranked", "topic_id", "array_join(words, ' ') AS words_text",
                                     "array_join(transform(coherence_scores, x -> format_string('%.4f', round(x, 4))), ' ')"
                                     " AS coherence_text"),
    "m8_described_topics": _source_run("described", "topic_id", "label", "array_join(words, ' ') AS words_text",
                                       "round(topic_quality, 6) AS topic_quality",
                                       "round(semantic_coherence, 6) AS semantic_coherence"),
    "w11_kept_topics": _source_run("kept", "doc_id", "topic_id"),
    "a12_blog_summary": a12_blog_summary,
    "x3_source_taxonomy": _source_run("classes", "doc_id", "classification", "pct", "CAST(rank AS BIGINT) AS rank"),
    "r6_category_scores": _source_report("category", "score"),
    "r6_category_specificity": _source_report("category", "specificity"),
    "r6_subcategory_scores": _source_report("subcategory", "score"),
    "r6_subcategory_specificity": _source_report("subcategory", "specificity"),
})


# --- raw files end to end, and the small operators ---------------------------------


def _conversation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as raw blog files: date and post elements per turn, stray
    ampersands left in, every seventh date unreadable, one date too many at the end."""
    c = read_table(spark, sf_dir, "conversations")
    month = F.get(F.array(*[F.lit(m) for m in lx.MONTH_NAMES["en"]]), F.col("turn").cast("int") % 12)
    day = (F.col("conv_id") % 28 + 1).cast("string")
    date = F.when(F.col("turn") % 7 == 6, F.lit("no date")).otherwise(F.concat_ws(",", day, month, F.lit("2004")))
    element = F.concat(F.lit("<date>"), date, F.lit("</date><post>"), F.col("text"), F.lit(" & more</post>"))
    rows = c.select("conv_id", F.struct("turn", element.alias("e")).alias("x"))
    body = rows.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["e"]), "\n").alias("b"))
    return body.select("conv_id", F.concat("b", F.lit("<date>1,may,2005</date>")).alias("body"))


def s3_post_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 (Q4, Q5) + P1: dates and posts paired by position, stray ampersands, bad dates."""
    posts = blogfiles.posts_from_text(_conversation_files(spark, sf_dir), "conv_id", "body")
    return posts.select("file_id", F.col("pos").cast("long").alias("pos"), "date_text", "content",
                        blogfiles.parse_day_first_date("date_text").alias("date"))


def a1_dated_blogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 -> P1 -> J1 -> A1: posts of raw files, in date order, one blog per file, with the
    file's metadata (here the order of that number) attached."""
    posts = s3_post_pairs(spark, sf_dir)
    files = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("long").alias("id"), F.col("c_mktsegment").alias("industry"))
    blogs = attach_metadata(blogfiles.blogs_from_posts(require_columns(posts, "date", "content")), files)
    return blogs.select("file_id", F.md5("content").alias("content_md5"), "post_count", "total_content_length",
                        "earliest_post_date", "latest_post_date", "industry")


def s8_taxonomy_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 on a taxonomy written from nations and regions: two header lines, short lines."""
    n = read_table(spark, sf_dir, "nation").join(read_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    lines = n.select(F.col("n_nationkey").cast("int").alias("line_no"),
                     F.when(F.col("n_nationkey") % 11 == 10, F.lit("short\tline")).otherwise(
                         F.concat_ws("\t", F.col("n_nationkey").cast("string"), F.lit("x"),
                                     F.concat("n_name", F.lit(" & Co")), "r_name")).alias("value"))
    return taxonomy.parse_taxonomy_tsv(lines)


def x1_subtopic_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 + P19 + J3 + A11 + Q16: vectors of part types as subtopics of brands; a type under
    several brands goes to the last, words without a vector are left out."""
    emb = read_table(spark, sf_dir, "embeddings")
    n = emb.select(F.count(F.lit(1))).scalar()
    p = read_table(spark, sf_dir, "part")
    tax = p.select(F.col("p_partkey").cast("int").alias("ord"), F.col("p_brand").alias("major"),
                   F.translate("p_type", " ", "_").alias("subtopic"))
    words = tax.select(F.explode(tx.phrase_words(tx.normalise_term("subtopic"))).alias("word")).distinct()
    known = (words.where(F.length("word") > 4).withColumn("vec_id", testdata.word_index(F.col("word"), n))
             .join(emb, "vec_id").select("word", F.col("embedding").alias("vec")))
    v = taxonomy.subtopic_vectors(tax, known)
    return v.select("ord", "major", "subtopic", F.round(F.get("vec", 0), 6).alias("v0"),
                    F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 5).alias("v_sum"))


def j2_unprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + A7: customers without an order yet."""
    done = read_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return skip_processed(read_table(spark, sf_dir, "customer"), done, "c_custkey").select("c_custkey", "c_mktsegment")


def j2_no_urgent_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + A7 with rows left: customers without an urgent order yet (a customer repeats in
    ``orders``, and orders without a customer skip nobody)."""
    o = read_table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return skip_processed(read_table(spark, sf_dir, "customer"), o.select(F.col("o_custkey").alias("c_custkey")),
                          "c_custkey").select("c_custkey", "c_mktsegment")


def u1_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers by column name, missing columns as NULL."""
    c = read_table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = read_table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return union_results(c, s)


def p14_first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ordered limit (the operator's feature): the 50 earliest orders."""
    o = read_table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey", "o_totalprice")
    return first_rows(o, 50, "o_orderdate", "o_orderkey")


def p4_industries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blogs per cleaned industry."""
    b = testdata.blogs_with_demographics(spark, sf_dir)
    return b.groupBy(tx.clean_industry("industry").alias("industry")).agg(F.count(F.lit(1)).alias("blogs"))


def i3_row_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reason why a document yields no topic, NULL where it yields one."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    d = d.withColumn("tokens", terms.topic_tokens_of_clean(tx.clean_content("text")))
    return st.with_error(d, "text", "tokens").select("doc_id", "error")


def s11_topic_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11 both ways: market segments' order counts as JSON text and back."""
    c = read_table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    j = c.groupBy("c_nationkey").agg(F.map_from_entries(F.collect_list(F.struct("c_mktsegment", "n"))).alias("m"))
    back = j.select("c_nationkey", F.explode(decode_json_map(encode_json("m"))).alias("segment", "customers"))
    return back.select("c_nationkey", "segment", F.col("customers").cast("long").alias("customers"))


def e6_topics_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly share of every order priority, its rank, and the change since its last month."""
    from ..streaming.topic_stream import topics_over_time
    return topics_over_time(read_table(spark, sf_dir, "orders"), "o_orderdate", "o_orderpriority")


QUERIES.update({
    "s3_post_pairs": s3_post_pairs,
    "a1_dated_blogs": a1_dated_blogs,
    "s8_taxonomy_tsv": s8_taxonomy_tsv,
    "x1_subtopic_vectors": x1_subtopic_vectors,
    "j2_unprocessed": j2_unprocessed,
    "j2_no_urgent_order": j2_no_urgent_order,
    "u1_union": u1_union,
    "p14_first_orders": p14_first_orders,
    "p4_industries": p4_industries,
    "i3_row_errors": i3_row_errors,
    "s11_topic_json": s11_topic_json,
    "e6_topics_over_time": e6_topics_over_time,
})


def t1_lemma_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 with lemmas: how often, and in how many documents, each lemma occurs. Words that
    occur themselves are the known ones that a suffix rule may lead to."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", terms.frequency_tokens("text").alias("toks"))
    counts = materialize(terms.exploded_counts(d, ["doc_id"], "toks"), "word-counts")
    words = materialize(counts.select(F.col("term").alias("word")).distinct(), "words")
    table = lemmas.lemma_table(words, lemmas.irregular_forms(spark), lemmas.noun_rules(spark), words)
    per_doc = lemmas.lemma_counts(counts, ["doc_id"], table)
    return per_doc.groupBy(F.col("term").alias("lemma")).agg(F.sum("cnt").alias("n"), F.count(F.lit(1)).alias("documents"))


def r1_incremental_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 kept up to date: the blogs arrive in four batches, in any order, one of them twice."""
    docs = materialize(st.blogs_with_scores(spark, sf_dir), "scored-blogs")
    state = f"{checkpoint_dir(spark).rstrip('/')}/report-state-{uuid.uuid4().hex}"
    for number in (2, 0, 3, 0, 1):
        batch = docs.where(F.pmod(F.crc32(F.col("file_id").cast("string")), F.lit(4)) == number)
        report_state.add_batch(batch, segments.default_segments(), state, str(number))
    return segments.rank_within(report_state.report(spark, state), "average_weighted_score")


def e6_terms_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 on text: the terms that stand out in each month's posts against the months before."""
    from ..streaming.topic_stream import terms_over_time
    posts = materialize(s3_post_pairs(spark, sf_dir).select("date", terms.topic_tokens("content").alias("tokens")), "dated-tokens")
    return terms_over_time(posts, "date", "tokens")


QUERIES.update({
    "t1_lemma_counts": t1_lemma_counts,
    "r1_incremental_scores": r1_incremental_scores,
    "e6_terms_over_time": e6_terms_over_time,
})
