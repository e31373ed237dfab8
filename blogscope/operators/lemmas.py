"""Lemmas from tables (the lemma steps of T1 and T2).

A word's lemma is, in this order: its entry in the table of irregular forms; the word itself if
its ending is protected; what the rule of its longest suffix makes of it, if that is a known
word; the same for its next suffix; the word itself. Forms, rules and known words are tables.
They are joined to the *distinct* words, and the lemma table that results to term counts, so a
text is never shuffled and the driver holds no dictionary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as lx


def noun_rules(spark: SparkSession) -> DataFrame:
    """(suffix, replacement): endings of English plurals; a NULL replacement protects an ending."""
    return spark.createDataFrame([*lx.NOUN_SUFFIX_RULES.items()], "suffix STRING, replacement STRING")


def irregular_forms(spark: SparkSession) -> DataFrame:
    """(form, lemma) of irregular English plurals."""
    return spark.createDataFrame([*lx.IRREGULAR_PLURALS.items()], "form STRING, lemma STRING")


def lemma_table(words: DataFrame, forms: DataFrame, rules: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(word, lemma), one row per distinct non-NULL ``word`` of ``words``.

    ``forms`` (form, lemma): a form listed twice takes its smallest lemma. ``rules`` (suffix,
    replacement): a suffix must leave at least two letters before it. ``known`` (word): what a
    rule may make; without it a rule may make anything. Longest suffix first, ties by result."""
    vocab = words.where(F.col("word").isNotNull()).select("word").distinct()
    one = forms.groupBy(F.col("form").alias("word")).agg(F.min("lemma").alias("_irregular"))
    lengths = F.sequence(F.lit(3), F.length("word"))  # places where a suffix can begin
    cut = (vocab.where(F.length("word") >= 3).select("word", F.explode(lengths).alias("_at"))
                .select("word", "_at", F.expr("substring(word, _at)").alias("suffix"))
                .join(rules, "suffix")
                .select("word", "_at", F.expr("substring(word, 1, _at - 1) || replacement").alias("made")))
    # an ending is protected against every shorter suffix
    kept = cut.where(F.col("made").isNull()).groupBy("word").agg(F.min("_at").alias("_kept"))
    made = cut.where(F.col("made").isNotNull()).join(kept, "word", "left").where(
        F.col("_kept").isNull() | (F.col("_at") < F.col("_kept")))
    if known is not None:
        made = made.join(known.select(F.col("word").alias("made")).distinct(), "made", "left_semi")
    regular = made.groupBy("word").agg(F.min(F.struct("_at", "made")).alias("_best")).select(
        "word", F.col("_best.made").alias("_regular"))
    return (vocab.join(one, "word", "left").join(regular, "word", "left")
                 .select("word", F.coalesce("_irregular", "_regular", "word").alias("lemma")))


def lemma_counts(counts: DataFrame, keys: list[str], table: DataFrame, min_length: int = 2) -> DataFrame:
    """(keys..., term, cnt) with terms replaced by their lemmas, counts of one lemma added and
    lemmas shorter than ``min_length`` left out (T1 filters after the lemma). Terms without a
    row in ``table`` stay. AQE picks the join by the measured size of the table."""
    named = table.select(F.col("word").alias("term"), "lemma")
    term = F.coalesce("lemma", "term")
    return (counts.join(named, "term", "left").where(F.length(term) >= min_length)
                  .groupBy(*keys, term.alias("term")).agg(F.sum("cnt").cast("long").alias("cnt")))
