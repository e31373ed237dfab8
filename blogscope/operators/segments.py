"""Demographic segments and their score reports.

Documents belong to several overlapping segments at once. Instead of one scan
per segment, each document is fanned out to the names of the segments it is in
(J7) and everything after that is one aggregation keyed by segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import text as tx

EPSILON = 1e-12
SCORE_DIGITS = 6


def prepare_demographics(df: DataFrame, age: str = "age", industry: str = "industry",
                         unknown_age_as: str = lx.AGE_GT20) -> DataFrame:
    """``age_group`` (<=20 / >20) and ``is_student`` flag columns."""
    return (df.withColumn("age_group", tx.age_group(age, unknown_age_as))
              .withColumn("is_student", tx.is_student(industry)))


def default_segments(gender: str = "gender") -> dict[str, Column]:
    """The seven segments of the reports as ``{name: predicate}``."""
    return {
        lx.SEGMENT_MALE: F.col(gender) == "male",
        lx.SEGMENT_FEMALE: F.col(gender) == "female",
        lx.SEGMENT_AGE_LE20: F.col("age_group") == lx.AGE_LE20,
        lx.SEGMENT_AGE_GT20: F.col("age_group") == lx.AGE_GT20,
        lx.SEGMENT_STUDENTS: F.col("is_student") == F.lit(True),
        lx.SEGMENT_NON_STUDENTS: F.col("is_student") == F.lit(False),
        lx.SEGMENT_EVERYONE: F.lit(True),
    }


def segment_names(segments: dict[str, Column]) -> Column:
    """Array of the names of the segments a row is in (NULL predicate = not in)."""
    return F.array_compact(F.array(*[F.when(p, F.lit(name)) for name, p in segments.items()]))


def fan_out(df: DataFrame, segments: dict[str, Column], out: str = "demographic") -> DataFrame:
    """One row per (row, segment it belongs to)."""
    return df.withColumn(out, F.explode(segment_names(segments)))


def segment_sizes(docs: DataFrame, segments: dict[str, Column]) -> DataFrame:
    """Documents per segment (segments without documents do not appear)."""
    return (docs.select(F.explode(segment_names(segments)).alias("demographic"))
                .groupBy("demographic").agg(F.count(F.lit(1)).alias("documents")))


def segment_crosstab(docs: DataFrame, row: str = "is_student", col: str = "age_group",
                     values=(lx.AGE_LE20, lx.AGE_GT20)) -> DataFrame:
    """Cross-tab of two segment attributes (pivot values fixed, so no extra job)."""
    return docs.groupBy(row).pivot(col, list(values)).count()


def segment_scores(docs: DataFrame, segments: dict[str, Column], scores_col: str = "scores",
                   level: str = "category") -> DataFrame:
    """A3/A4/A5: mean share per document of each classification within each segment.

    ``scores_col`` is a MAP<STRING, DOUBLE> of ``major:sub`` -> percent, NULL when the
    document was not classified (it still counts in the denominator, Q9/Q11).
    ``level`` = "category" sums subtopics into their major (Q10), "subcategory"
    keeps the full key.

    One pass: every document contributes its map entries plus one marker entry
    with a NULL key. A single (segment, classification) aggregation, partially
    aggregated before the shuffle, yields both the sums and, on the marker rows,
    the segment sizes. Output keeps the marker rows out.
    """
    entry_t = "array<struct<key:string,value:double>>"
    entries = F.concat(
        F.coalesce(F.map_entries(F.col(scores_col)), F.array().cast(entry_t)),
        F.array(F.struct(F.lit(None).cast("string").alias("key"),
                         F.lit(None).cast("double").alias("value"))))
    rows = (docs.select(segment_names(segments).alias("_segs"), entries.alias("_e"))
                .select(F.explode("_segs").alias("demographic"), "_e")
                .select("demographic", F.explode("_e").alias("_kv")))
    key = F.col("_kv.key")
    cls = tx.category_of(key) if level == "category" else key
    agg = (rows.groupBy("demographic", cls.alias("classification"))
               .agg(F.sum(F.col("_kv.value") / 100.0).alias("_total"),
                    F.count(F.lit(1)).alias("_n")))
    w = Window.partitionBy("demographic")
    sized = agg.withColumn(
        "_docs", F.max(F.when(F.col("classification").isNull(), F.col("_n"))).over(w))
    return (sized.where(F.col("classification").isNotNull())
                 .select("demographic", "classification",
                         (F.col("_total") / F.col("_docs")).alias("average_weighted_score")))


def specificity(scores: DataFrame, everyone: str = lx.SEGMENT_EVERYONE,
                score_col: str = "average_weighted_score") -> DataFrame:
    """Segment score / (Everyone score + 1e-12), every segment but Everyone.

    The Everyone score is brought to each row with a window partitioned by
    classification instead of a join: one row per segment and classification.
    """
    w = Window.partitionBy("classification")
    base = F.max(F.when(F.col("demographic") == everyone, F.col(score_col))).over(w)
    return (scores.withColumn("_all", F.coalesce(base, F.lit(0.0)))
                  .where(F.col("demographic") != everyone)
                  .select("demographic", "classification",
                          (F.col(score_col) / (F.col("_all") + F.lit(EPSILON)))
                          .alias("popularity_bias_score")))


def rank_within(df: DataFrame, score_col: str, part: str = "demographic",
                tie: str = "classification", digits: int = SCORE_DIGITS) -> DataFrame:
    """Ordinal rank, score descending within ``part``; scores are rounded to
    ``digits`` first and ties are broken by ``tie`` ascending, so ranks are stable."""
    rounded = df.withColumn(score_col, F.round(F.col(score_col), digits))
    w = Window.partitionBy(part).orderBy(F.col(score_col).desc(), F.col(tie).asc())
    return rounded.withColumn("rank", F.row_number().over(w))


def top_n(ranked: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` ranks per segment (WindowGroupLimit keeps it partial)."""
    return ranked.where(F.col("rank") <= n)


def top2_summary(scores: DataFrame, sizes: DataFrame, score_col: str = "average_weighted_score",
                 level: str = "category") -> DataFrame:
    """First and second classification per segment with placeholder texts."""
    none, second = ((lx.NO_CATEGORIES, lx.NO_SECOND_CATEGORY) if level == "category"
                    else (lx.NO_TOPICS, lx.NO_SECOND_TOPIC))
    ranked = top_n(rank_within(scores, score_col), 2)
    firsts = ranked.groupBy("demographic").agg(
        F.max(F.when(F.col("rank") == 1, F.col("classification"))).alias("_c1"),
        F.max(F.when(F.col("rank") == 2, F.col("classification"))).alias("_c2"))
    return (sizes.select("demographic").join(firsts, "demographic", "left")
                 .select("demographic",
                         F.coalesce("_c1", F.lit(none)).alias("first"),
                         F.when(F.col("_c1").isNull(), F.lit(none))
                          .otherwise(F.coalesce("_c2", F.lit(second))).alias("second")))


def method_agreement(a: DataFrame, b: DataFrame, item: str, part: str = "demographic") -> DataFrame:
    """Per ``part``, shared items and Jaccard of the top lists of two methods
    (inputs already cut to their top k; a few rows per segment)."""
    sa = a.groupBy(part).agg(F.collect_set(item).alias("_a"))
    sb = b.groupBy(part).agg(F.collect_set(item).alias("_b"))
    j = sa.join(sb, part, "full")
    ea = F.coalesce("_a", F.array().cast("array<string>"))
    eb = F.coalesce("_b", F.array().cast("array<string>"))
    inter = F.size(F.array_intersect(ea, eb))
    union = F.size(F.array_union(ea, eb))
    return j.select(part, inter.cast("long").alias("common"),
                    F.round(F.when(union > 0, inter / union).otherwise(F.lit(0.0)), 6).alias("jaccard"))
