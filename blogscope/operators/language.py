"""Language detection (P2) and distribution (A2).

Re-aimed as a stop-word vote computed inside the row: per language, the number
of the text's words that are in that language's function-word list; the largest
count wins (ties by language code), no hit -> ``unknown``. No explode, no join,
no shuffle. The guards of the original are kept: a text shorter than 3
characters after stripping, or shorter than 10 after replacing punctuation by
spaces and collapsing whitespace, is ``unknown``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bags
from ..functions import lexicon as lx
from ..functions import text as tx

UNKNOWN = "unknown"


def _member_of(words):
    ws = list(words)
    return lambda t: t.isin(ws)


def detect_language(col, stop_words: dict = lx.LANGUAGE_STOP_WORDS) -> Column:
    """P2 as one expression. The words (runs of letters, digits, ``_``; lower-cased)
    are bound once (``let``); the cleaned text of the guard is exactly those words
    joined by single spaces, so its length is computed from them."""
    c = F.col(col) if isinstance(col, str) else col

    def with_toks(tk):
        per_lang = [F.struct((-F.size(F.filter(tk, _member_of(ws)))).alias("neg"), F.lit(lang).alias("lang"))
                    for lang, ws in sorted(stop_words.items())]
        best = F.get(F.sort_array(F.array(*per_lang)), 0)
        clean_len = F.aggregate(tk, F.lit(-1), lambda s, x: s + F.length(x) + 1)
        return bags.let(best, lambda b: F.when(clean_len < 10, F.lit(UNKNOWN))
                        .when(b["neg"] < 0, b["lang"]).otherwise(F.lit(UNKNOWN)))

    toks = F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}_]+)"), 1)
    return (F.when(c.isNull() | (F.length(tx.strip_ws(c)) < 3), F.lit(UNKNOWN))
             .otherwise(bags.let(toks, with_toks)))


def with_language(df: DataFrame, col: str, out: str = "content_language",
                  stop_words: dict = lx.LANGUAGE_STOP_WORDS) -> DataFrame:
    return df.withColumn(out, detect_language(col, stop_words))


def language_distribution(df: DataFrame, lang_col: str = "content_language") -> DataFrame:
    """A2: rows per detected language."""
    return df.groupBy(lang_col).agg(F.count(F.lit(1)).alias("count"))


def fit_language_model(docs: DataFrame, text_col: str = "text", label_col: str = "lang",
                       num_features: int = 1 << 18):
    """P2 (b): multinomial Naive Bayes on hashed character trigrams (pyspark.ml)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import HashingTF, NGram, StringIndexer

    prep = docs.withColumn("_chars", F.split(F.lower(F.col(text_col)), ""))
    pipe = Pipeline(stages=[
        StringIndexer(inputCol=label_col, outputCol="_label", handleInvalid="skip"),
        NGram(n=3, inputCol="_chars", outputCol="_tri"),
        HashingTF(inputCol="_tri", outputCol="_f", numFeatures=num_features),
        NaiveBayes(featuresCol="_f", labelCol="_label", modelType="multinomial", smoothing=1.0),
    ])
    return pipe.fit(prep)


def predict_language(model, docs: DataFrame, text_col: str = "text", out: str = "predicted") -> DataFrame:
    labels = model.stages[0].labels
    lab = F.array(*[F.lit(x) for x in labels])  # a handful of language codes
    pred = model.transform(docs.withColumn("_chars", F.split(F.lower(F.col(text_col)), "")))
    return pred.withColumn(out, F.get(lab, F.col("prediction").cast("int"))).drop(
        "_chars", "_tri", "_f", "rawPrediction", "probability", "prediction", "_label")
