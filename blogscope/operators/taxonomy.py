"""Projection of topics on a two-level taxonomy by word-vector similarity.

Shapes:
  taxonomy      (ord INT, major STRING, subtopic STRING)
  word vectors  (word STRING, vec ARRAY<FLOAT|DOUBLE>)
  topics        (doc_id, topic_id, words ARRAY<STRING>, weights ARRAY<DOUBLE>,
                 coherence_scores ARRAY<DOUBLE> (nullable), topic_quality DOUBLE)

The taxonomy is a bounded dimension (tens of majors, a few hundred subtopics).
Topic x subtopic similarities are a dense matrix product, done per partition
with numpy on Arrow batches against the subtopic matrix shipped as a broadcast
variable, in blocks of a fixed size; nothing is joined pairwise.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lexicon as lx
from ..functions import text as tx
from ..session import materialize

# Subtopics in a block of the taxonomy: their vectors travel to every task (64 doubles each: 25 MB).
BLOCK = 50_000
SLICE = 1 << 20  # cosines computed at a time in a task


def fallback_taxonomy(spark: SparkSession) -> DataFrame:
    """The built-in 8 x 4 taxonomy as (ord, major, subtopic)."""
    rows, i = [], 0
    for major, subs in lx.FALLBACK_TAXONOMY.items():
        for s in subs:
            rows.append((i, major, s))
            i += 1
    return spark.createDataFrame(rows, "ord INT, major STRING, subtopic STRING")


def parse_taxonomy_tsv(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Taxonomy TSV (one row per line, in file order) -> (ord, major, subtopic).

    Two header lines skipped; rows with < 4 fields dropped; field 4 is the major
    and field 3 the subtopic; empties and self-named headers dropped; names
    lower-cased, spaces to ``_``, ``&`` to ``and``; a subtopic kept once per major,
    at its first position. ``lines`` must carry a line number column ``line_no``. A file of
    fewer than three lines holds no taxonomy: ValueError.
    """
    if lines.limit(3).count() < 3:
        raise ValueError("a taxonomy file has two header lines and at least one row")
    f = F.split(F.col(text_col), "\t")
    rows = (lines.where(F.col("line_no") >= 2)
                 .select("line_no", f.alias("f"))
                 .where(F.size("f") >= 4)
                 .select("line_no", F.trim(F.get("f", 3)).alias("tier1"),
                         F.trim(F.get("f", 2)).alias("name"))
                 .where((F.col("tier1") != "") & (F.col("name") != "")
                        & (F.lower("name") != F.lower("tier1"))))
    norm = lambda c: F.replace(F.replace(F.lower(c), F.lit(" "), F.lit("_")), F.lit("&"), F.lit("and"))
    named = rows.select("line_no", norm(F.col("tier1")).alias("major"), norm(F.col("name")).alias("subtopic"))
    first = named.groupBy("major", "subtopic").agg(F.min("line_no").alias("ord"))
    return first.select(F.col("ord").cast("int"), "major", "subtopic")


def subtopic_vectors(taxonomy: DataFrame, vectors: DataFrame) -> DataFrame:
    """X1 (+P19, J3, A11, Q16): subtopic vector = mean of its words' vectors.

    Names are normalised ('/', '_' -> space); a name under several majors keeps
    the last major and its first position; names with no known word are dropped.
    Output (ord, major, subtopic, vec ARRAY<DOUBLE>).
    """
    named = taxonomy.select("ord", "major", tx.normalise_term(F.col("subtopic")).alias("subtopic"))
    last = Window.partitionBy("subtopic").orderBy(F.col("ord").desc())
    first = Window.partitionBy("subtopic")
    dedup = (named.withColumn("_r", F.row_number().over(last))
                  .withColumn("_first", F.min("ord").over(first))
                  .where(F.col("_r") == 1)
                  .select(F.col("_first").alias("ord"), "major", "subtopic"))
    words = dedup.select("ord", "major", "subtopic",
                         F.posexplode(tx.phrase_words(F.col("subtopic"))).alias("wpos", "word"))
    return mean_vectors(lookup_vectors(words, vectors), ["ord", "major", "subtopic"], "vec")


def lookup_vectors(df: DataFrame, vectors, word_col: str = "word", original_col: str | None = None) -> DataFrame:
    """Attach ``vec`` to rows by word; unknown words dropped (inner join).

    ``vectors`` is a (word, vec) table or a function ``(df, word_col) -> df + vec``
    (e.g. a hashed lookup). A plain table join is left to AQE: broadcast when the
    measured vector side is small, shuffle join with skew splitting otherwise. With
    ``original_col`` a word that is unknown is looked up a second time by its original form."""
    if callable(vectors):
        return vectors(df, word_col)
    if original_col is None:
        return df.join(vectors.select(F.col("word").alias(word_col), "vec"), word_col)
    first = vectors.select(F.col("word").alias(word_col), F.col("vec").alias("_v1"))
    second = vectors.select(F.col("word").alias(original_col), F.col("vec").alias("_v2"))
    both = df.join(first, word_col, "left").join(second, original_col, "left")
    return (both.withColumn("vec", F.coalesce("_v1", "_v2")).where(F.col("vec").isNotNull())
                .select(*df.columns, "vec"))


def mean_vectors(df: DataFrame, keys: list[str], vec_col: str, weight_col: str | None = None) -> DataFrame:
    """(weighted) element-wise mean of the vectors of a bounded group.

    Groups here are a topic's selected words or a subtopic's words (tens at most),
    so the vectors are gathered per group and folded with array functions.
    """
    w = F.col(weight_col) if weight_col else F.lit(1.0)
    g = df.groupBy(*keys).agg(
        F.collect_list(F.struct(w.cast("double").alias("w"),
                                F.col(vec_col).cast("array<double>").alias("v"))).alias("_vs"),
        F.sum(w).alias("_wsum"))
    dim = F.size(F.col("_vs")[0]["v"])
    zero = F.transform(F.sequence(F.lit(1), dim), lambda _: F.lit(0.0))
    total = F.aggregate("_vs", zero,
                        lambda acc, x: F.zip_with(acc, x["v"], lambda a, b: a + x["w"] * b))
    return g.select(*keys, F.transform(total, lambda s: s / F.col("_wsum")).alias("vec"))


def select_topic_words(topics: DataFrame, percentile: float = 0.6, min_words: int = 3) -> DataFrame:
    """W5 + A10: words sorted by weight desc (stable); keep weight >= interpolated
    60th percentile of the weights (the minimum when there are <= 3 words), or the
    best ``min_words`` when fewer survive. Missing or mismatched coherence -> 0.5.
    Topics whose word and weight lists differ in length or are empty are skipped.

    Output (doc_id, topic_id, topic_quality, pos, word, weight, coherence).
    """
    n = F.size("words")
    coh = F.when(F.col("coherence_scores").isNotNull() & (F.size("coherence_scores") == n),
                 F.col("coherence_scores")).otherwise(
        F.transform(F.col("words"), lambda _: F.lit(0.5)))
    srt = F.col("_srt")
    pos = F.lit(percentile) * (n - 1)
    lo = F.floor(pos).cast("int")
    frac = pos - lo
    pct = F.get(srt, lo) + frac * (F.coalesce(F.get(srt, lo + 1), F.get(srt, lo)) - F.get(srt, lo))
    threshold = F.when(n > 3, pct).otherwise(F.array_min("weights"))
    valid = (topics.withColumn("_ok", (n > 0) & (F.size("weights") == n))
                   .withColumn("_srt", F.sort_array(F.col("weights")))
                   .withColumn("_coh", coh))
    valid = valid.withColumn("_thr", threshold)
    # stable sort by weight desc = sort by (-weight, original position)
    items = F.transform(F.arrays_zip(F.col("words").alias("w"), F.col("weights").alias("x"),
                                     F.col("_coh").alias("c")),
                        lambda z, i: F.struct((-z["x"]).alias("neg"), i.alias("i"), z["w"].alias("word"),
                                              z["x"].alias("weight"), z["c"].alias("coherence")))
    valid = valid.withColumn("_ord", F.sort_array(items))
    passing = F.transform(
        F.filter(F.arrays_zip(F.col("_ord").alias("z"), F.array_repeat(F.col("_thr"), F.size("_ord")).alias("t")),
                 lambda p: p["z"]["weight"] >= p["t"]),
        lambda p: p["z"])
    chosen = F.when(~F.col("_ok"), F.array().cast(items_type(valid)))\
        .when(F.size(passing) < min_words, F.slice("_ord", 1, min_words)).otherwise(passing)
    return (valid.select("doc_id", "topic_id", F.coalesce("topic_quality", F.lit(0.5)).alias("topic_quality"),
                         F.posexplode(chosen).alias("pos", "_z"))
                 .select("doc_id", "topic_id", "topic_quality", "pos",
                         F.col("_z.word").alias("word"), F.col("_z.weight").alias("weight"),
                         F.col("_z.coherence").alias("coherence")))


def items_type(df: DataFrame) -> str:
    return df.schema["_ord"].dataType.simpleString()


def topic_vectors(selected: DataFrame, vectors: DataFrame) -> DataFrame:
    """X2 (+J3): topic vector = average of the words' phrase vectors weighted by
    weight * (coherence + 0.2), weights normalised. A phrase vector is the mean of
    its known words' vectors; words with no known part are left out; a topic with
    no known word at all is dropped.
    """
    words = selected.select("doc_id", "topic_id", "topic_quality", "pos",
                            (F.col("weight") * (F.col("coherence") + F.lit(0.2))).alias("cw"),
                            F.posexplode(tx.phrase_words(F.col("word"))).alias("ppos", "word"))
    hit = lookup_vectors(words, vectors).withColumn("vec", F.col("vec").cast("array<double>"))
    # one exchange by topic: a topic's words (tens at most) meet, phrases are folded inside
    g = hit.groupBy("doc_id", "topic_id").agg(
        F.max("topic_quality").alias("topic_quality"),
        F.sort_array(F.collect_list(F.struct("pos", "ppos", "cw", "vec"))).alias("_w"))
    sizes = F.transform("_w", lambda x: F.size(F.filter("_w", lambda y: y["pos"] == x["pos"])))
    dim = F.size(F.get("_w", 0)["vec"])
    zero = F.transform(F.sequence(F.lit(1), dim), lambda _: F.lit(0.0))
    # a phrase vector is the mean of its words: each word weighs cw / words of its phrase
    share = F.zip_with("_w", sizes, lambda x, n: F.struct((x["cw"] / n).alias("w"), x["vec"].alias("v")))
    total = F.aggregate("_s", zero, lambda acc, x: F.zip_with(acc, x["v"], lambda p, q: p + x["w"] * q))
    weight = F.aggregate("_s", F.lit(0.0), lambda acc, x: acc + x["w"])
    return (g.withColumn("_s", share).select("doc_id", "topic_id", "topic_quality", total.alias("_t"), weight.alias("_n"))
             .select("doc_id", "topic_id", "topic_quality", F.transform("_t", lambda x: x / F.col("_n")).alias("vec")))


SCORE_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("topic_id", T.IntegerType()),
    T.StructField("ord", T.IntegerType()), T.StructField("major", T.StringType()),
    T.StructField("subtopic", T.StringType()), T.StructField("similarity", T.DoubleType()),
    T.StructField("weighted_similarity", T.DoubleType()),
])


def score_subtopics(tvecs: DataFrame, subvecs: DataFrame, min_similarity: float, block: int = BLOCK) -> DataFrame:
    """J4 + M9: cosine of every topic vector with every subtopic vector, times the
    quality multiplier 0.5 + 0.5 * quality; only pairs >= ``min_similarity`` leave
    the task. The taxonomy comes in blocks of at most ``block`` subtopics in the order of
    (ord, major, subtopic), each fetched after the last key of the one before and shipped as a
    broadcast variable. With several blocks each one's pairs are a stage, after which its
    matrix is released, so the driver and a task hold one block whatever the taxonomy's size."""
    spark = tvecs.sparkSession
    src = tvecs.select(F.col("doc_id").cast("long"), F.col("topic_id").cast("int"),
                       F.col("topic_quality").cast("double"), "vec")
    key = F.struct("ord", "major", "subtopic")
    todo, parts = subvecs, []
    while True:
        rows = todo.orderBy("ord", "major", "subtopic").limit(block + 1).collect()
        more = len(rows) > block
        rows = rows[:block]
        if not rows:
            break
        mat = np.array([np.asarray(r["vec"], dtype=np.float64) for r in rows])
        bc = spark.sparkContext.broadcast((
            [r["ord"] for r in rows], [r["major"] for r in rows], [r["subtopic"] for r in rows], mat))
        if more and not parts:  # vectors are scanned once a block: computed once
            src, subvecs = materialize(src, "topic-vectors"), materialize(subvecs, "subtopic-vectors")
        scored = src.mapInPandas(_broadcast_scorer(bc, min_similarity, SLICE), SCORE_SCHEMA)
        if not more and not parts:
            return scored
        parts.append(materialize(scored, "subtopic-scores"))
        bc.destroy()
        if not more:
            break
        last = rows[-1]
        after = F.struct(F.lit(last["ord"]).alias("ord"), F.lit(last["major"]).alias("major"), F.lit(last["subtopic"]).alias("subtopic"))
        todo = subvecs.where(key > after)
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], SCORE_SCHEMA)


def _broadcast_scorer(bc, min_similarity, slice_size):
    """The per-partition scorer. Self-contained (imports inside, no module-level
    references) so it is pickled by value and workers need no copy of this package.
    Both sides are normalised first and multiplied in slices of bounded size."""
    def run(batches):
        import numpy as np
        import pandas as pd
        keys, majors, subs, mat = bc.value
        keys = np.asarray(keys, dtype=np.int32)
        majors = np.asarray(majors, dtype=object)
        subs = np.asarray(subs, dtype=object)
        unit = (mat / np.linalg.norm(mat, axis=1, keepdims=True)).T
        step = max(1, slice_size // len(keys))
        for batch in batches:
            for lo in range(0, len(batch), step):
                pdf = batch.iloc[lo:lo + step]
                tv = np.stack([np.asarray(v, dtype=np.float64) for v in pdf["vec"]])
                cos = (tv / np.linalg.norm(tv, axis=1, keepdims=True)) @ unit
                boost = 0.5 + 0.5 * pdf["topic_quality"].to_numpy(dtype=np.float64)
                ws = cos * boost[:, None]
                r, c = np.nonzero(ws >= min_similarity)
                yield pd.DataFrame({
                    "doc_id": pdf["doc_id"].to_numpy()[r], "topic_id": pdf["topic_id"].to_numpy()[r],
                    "ord": keys[c], "major": majors[c], "subtopic": subs[c],
                    "similarity": cos[r, c], "weighted_similarity": ws[r, c],
                })
    return run


def classify_topics(topics: DataFrame, taxonomy: DataFrame, vectors: DataFrame,
                    top_n: int = 25, min_similarity: float = 0.5) -> DataFrame:
    """Per document, taxonomy keys ``major:subtopic`` -> percent.

    percent = round(100 * cosine * (0.5 + 0.5 * quality), 2) for pairs at or above
    ``min_similarity``; the best value per key over the document's topics (A9);
    the ``top_n`` best keys (W4; ties by taxonomy position).
    Output (doc_id, classification, pct, rank).
    """
    sel = select_topic_words(topics)
    tv = topic_vectors(sel, vectors)
    sv = subtopic_vectors(taxonomy, vectors)
    scored = score_subtopics(tv, sv, min_similarity)
    keyed = scored.select("doc_id", "ord",
                          F.concat_ws(":", "major", "subtopic").alias("classification"),
                          F.round(F.col("weighted_similarity") * 100, 2).alias("pct"))
    best = keyed.groupBy("doc_id", "classification").agg(F.max("pct").alias("pct"),
                                                         F.min("ord").alias("ord"))
    w = Window.partitionBy("doc_id").orderBy(F.col("pct").desc(), F.col("ord").asc())
    return (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)
                .select("doc_id", "classification", "pct", "rank"))


def classification_map(classified: DataFrame) -> DataFrame:
    """Per document MAP<STRING, DOUBLE> of its classifications (bounded: <= top_n)."""
    return classified.groupBy("doc_id").agg(
        F.map_from_entries(F.collect_list(F.struct("classification", "pct"))).alias("scores"))
