"""Tokenisers, term counts, word frequencies and TF-IDF.

Per-document steps are row-local array expressions (no shuffle); corpus
statistics are ``groupBy`` jobs with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bags
from ..functions import lexicon as lx
from ..functions import text as tx
from ..session import materialize
from . import gram_blocks, sketch


TASK_ROWS = 1 << 20  # rows that a task sorts, on average


def frequency_tokens(col, stop_words=lx.ENGLISH_STOP_WORDS, lemmas: dict | None = None) -> Column:
    """Lower, keep a-z, split, stop words out, lemma, length > 1."""
    toks = tx.stop_word_filter(tx.letters_lower_tokens(col), stop_words)
    if lemmas:
        lm = F.create_map(*[F.lit(x) for kv in sorted(lemmas.items()) for x in kv])
        toks = F.transform(toks, lambda t: F.coalesce(F.element_at(lm, t), t))
    return F.filter(toks, lambda t: F.length(t) > 1)


def topic_tokens(col, stop_words=lx.ENGLISH_STOP_WORDS, min_len: int = 3,
                 lemmas: dict | None = None) -> Column:
    """Alphabetic tokens, not stop words, longer than ``min_len - 1``; lemma lower-cased (Q26)."""
    sw = list(stop_words)
    toks = F.filter(tx.word_tokens(col),
                    lambda t: (F.length(t) >= min_len) & ~F.lower(t).isin(sw))
    toks = F.transform(toks, F.lower)
    if lemmas:
        lm = F.create_map(*[F.lit(x) for kv in sorted(lemmas.items()) for x in kv])
        toks = F.transform(toks, lambda t: F.lower(F.coalesce(F.element_at(lm, t), t)))
    return toks


def topic_tokens_of_clean(col, stop_words=lx.ENGLISH_STOP_WORDS, min_len: int = 3) -> Column:
    """T2 on P3 output (ASCII letters separated by single spaces): the letter runs
    are exactly the space-separated parts, and P5 is the identity on such text, so
    a plain split replaces the regex extraction."""
    c = F.col(col) if isinstance(col, str) else col
    sw = list(stop_words)
    toks = F.filter(F.split(c, " "), lambda t: (F.length(t) >= min_len) & ~F.lower(t).isin(sw))
    return F.transform(toks, F.lower)


SENTENCE_SPLIT = rf"(?<=[.!?]){tx.WS}+"


def sentences(col, min_chars: int = 21) -> Column:
    """Split after . ! ? followed by whitespace; trimmed; keep >= ``min_chars`` chars."""
    parts = F.transform(F.split(F.col(col) if isinstance(col, str) else col, SENTENCE_SPLIT),
                        tx.strip_ws)
    return F.filter(parts, lambda s: F.length(s) >= min_chars)


def word_frequencies(tokens: Column, n_most: int = 10, n_least: int = 10,
                     min_word_length: int = 2) -> Column:
    """Most common (count desc) and least common among count > 1 (count asc);
    ties by first occurrence. STRUCT<most_common, least_common> of arrays."""
    def body(toks):
        rows = F.transform(F.arrays_zip(bags.term_counts(toks).alias("c"), bags.first_positions(toks).alias("p")),
                           lambda x: F.struct(x["c"]["cnt"].alias("cnt"), x["p"]["pos"].alias("pos"),
                                              x["c"]["term"].alias("term")))

        def pick(r):
            most = F.slice(F.sort_array(F.transform(r, lambda y: F.struct(
                (-y["cnt"]).alias("k"), y["pos"].alias("pos"), y["term"].alias("term")))), 1, n_most)
            least = F.slice(F.sort_array(F.filter(r, lambda y: y["cnt"] > 1)), 1, n_least)
            return F.struct(F.transform(most, lambda y: y["term"]).alias("most_common"),
                            F.transform(least, lambda y: y["term"]).alias("least_common"))
        return bags.let(rows, pick)
    return bags.let(F.filter(tokens, lambda t: F.length(t) >= min_word_length), body)


def tfidf_topic(tokens: Column, top_n: int = 5, max_features: int = 1000, num_words: int = 10) -> Column:
    """Single-document TF-IDF (idf constant, so weight = tf / ||tf||2 over the
    ``max_features`` most frequent terms), top ``top_n`` terms.
    STRUCT<words, weights, label, topic_quality>; empty words when no token."""
    def with_kept(kept):
        def with_norm(nrm):
            weighted = F.transform(kept, lambda x: F.struct((x["cnt"] / nrm).alias("weight"),
                                                            x["term"].alias("term")))
            top = F.slice(F.filter(bags.top_weighted(weighted, top_n), lambda x: x["weight"] > 0), 1, num_words)

            def out(t):
                words = F.transform(t, lambda x: x["term"])
                weights = F.transform(t, lambda x: x["weight"])
                quality = F.aggregate(t, F.lit(0.0), lambda a, x: a + x["weight"]) / F.size(t)
                return F.struct(words.alias("words"), weights.alias("weights"),
                                tx.tfidf_label(words).alias("label"),
                                F.when(F.size(t) > 0, quality).otherwise(F.lit(0.0)).alias("topic_quality"))
            return bags.let(top, out)
        return bags.let(bags.l2_norm(kept), with_norm)
    return bags.let(bags.top_by_count(bags.term_counts(tokens), max_features), with_kept)


def exploded_counts(df: DataFrame, key_cols: list[str], tokens_col: str) -> DataFrame:
    """A8 in long form: (keys..., term, cnt), one row per distinct term of a row."""
    return (df.select(*key_cols, F.explode(bags.term_counts(F.col(tokens_col))).alias("_b"))
              .select(*key_cols, F.col("_b.term").alias("term"), F.col("_b.cnt").alias("cnt")))


def smooth_idf(n_docs: Column, df_col: Column) -> Column:
    """ln((1 + n) / (1 + df)) + 1."""
    return F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + df_col)) + F.lit(1.0)


def row_parts(df: DataFrame, most: int = TASK_ROWS) -> int:
    """Partitions of ``most`` rows on average, where these are more than the session's shuffles
    have; 0 otherwise. What a task sorts is then bounded however large ``df`` is."""
    n = -(-df.count() // most)
    return n if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else 0


def corpus_tfidf_top(counts: DataFrame, doc_cols: list[str], top_n: int = 5,
                     sublinear: bool = False, few_documents: bool = False) -> DataFrame:
    """T9 (and E3 with segments as documents): tf x smooth idf over the corpus, L2 per
    document, top ``top_n`` per document by weight desc, term desc.

    Input (doc..., term, cnt). Document frequencies come from a partially
    aggregated ``groupBy(term)``; AQE broadcasts the idf side when it is small and
    splits skewed terms otherwise. With ``few_documents`` (segments: a handful of
    huge "documents", one of them holding every row) the norms are a partially
    aggregated ``groupBy`` broadcast back (one row per document), so no task ever
    holds a whole document; the top-n cut is then a partial WindowGroupLimit
    applied before the shuffle.
    """
    n_docs = counts.select(*doc_cols).distinct().select(F.count(F.lit(1))).scalar()
    parts = 0 if few_documents else row_parts(counts)
    if parts:
        counts = counts.repartition(parts, "term")
    dfs = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    tf = F.when(F.lit(sublinear), F.log(F.col("cnt")) + 1).otherwise(F.col("cnt"))
    w = counts.join(dfs, "term").withColumn("raw", tf * smooth_idf(n_docs, F.col("df")))
    if few_documents:
        norms = w.groupBy(*doc_cols).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("_norm"))
        normed = w.join(F.broadcast(norms), doc_cols).withColumn("weight", F.col("raw") / F.col("_norm"))
    else:
        if parts:
            w = w.repartition(parts, *doc_cols)
        doc = Window.partitionBy(*doc_cols)
        normed = w.withColumn("weight", F.col("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(doc)))
    rank = Window.partitionBy(*doc_cols).orderBy(F.col("weight").desc(), F.col("term").desc())
    return (normed.withColumn("rank", F.row_number().over(rank))
                  .where(F.col("rank") <= top_n)
                  .select(*doc_cols, "rank", "term", "cnt", "df", "weight"))


def top_terms_by_count(counts: DataFrame, group_cols: list[str], n: int = 2) -> DataFrame:
    """The ``n`` most frequent terms per group (count desc, term asc)."""
    agg = counts.groupBy(*group_cols, "term").agg(F.sum("cnt").alias("cnt"))
    w = Window.partitionBy(*group_cols).orderBy(F.col("cnt").desc(), F.col("term").asc())
    return agg.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def ngrams(tokens: Column, n_min: int = 1, n_max: int = 3) -> Column:
    """All n-grams (n_min..n_max) of a token list, space-joined, in order of n then position."""
    def of(t):
        def grams(n):
            idx = F.filter(F.sequence(F.lit(0), F.greatest(F.size(t) - n, F.lit(0))), lambda i: i <= F.size(t) - n)
            return F.transform(idx, lambda i: F.array_join(F.slice(t, i + 1, n), " "))
        return F.concat(*[grams(n) for n in range(n_min, n_max + 1)])
    return bags.let(tokens, of)


def segment_tfidf(segs: DataFrame, key: list[str], scope: list[str], tokens: str = "tokens",
                  ngram=(1, 3), max_features: int | None = 1000, min_df: int = 2, max_df: float = 0.85,
                  width: int = sketch.WIDTH) -> DataFrame:
    """TF-IDF over the segments of each scope (a blog, or the corpus when ``scope`` is
    empty) with n-grams 1-3: df >= ``min_df`` and <= ``max_df`` x segments (falling back to
    df >= 1 when no term survives), the ``max_features`` terms with the highest total count
    (ties by term; None keeps all), tf = 1 + ln(count), idf = ln((1 + n) / (1 + df)) + 1, L2
    per segment. ``segs`` has one row per key. Output (key..., term, cnt, weight). The work is
    done in blocks of coded tokens (``gram_blocks``); ``width`` is the most buckets in which a
    corpus's n-grams meet and changes no result. A corpus's cut is an ordered limit."""
    out = [*key, "_e.term", "_e.cnt", "_e.weight"]
    cut = max_features if scope else None
    rows = gram_blocks.term_rows(segs, key, scope, tokens, ngram, cut, min_df, max_df, width)
    long = rows.select(*key, F.explode("entries").alias("_e")).select(*out)
    if scope or not max_features:
        return long
    long = materialize(long, "term-matrix")
    top = (long.groupBy("term").agg(F.sum("cnt").alias("total")).orderBy(F.col("total").desc(), F.col("term").asc())
               .limit(max_features).select("term"))  # ``max_features`` rows
    kept = long.join(F.broadcast(top), "term")
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(*key)))
    return kept.select(*key, "term", "cnt", (F.col("weight") / norm).alias("weight"))
