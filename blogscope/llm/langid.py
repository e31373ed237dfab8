"""Language ID: multinomial logistic regression on TF-IDF character n-grams (operator 4).

Character 1- to 3-grams of the lower-cased text are hashed into ``2 ** BITS`` buckets and
weighted by (1 + log tf) * idf, scaled to length 1. Document frequencies are counted over
every training document, and so are the languages; the weights are fitted with
follow-the-regularised-leader and elastic-net penalties on a bounded sample in which every
language has rows of its own, a fifth of which sets the softmax temperature.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, decode, fold, table, text_list, texts
from .ftrl import Ftrl

BITS = 15
ORDERS = (1, 2, 3)
SAMPLE_ROWS = 4_000  # texts to fit the weights on, at most
SAMPLE_BYTES = 16 << 20
QUOTA = 100  # texts that a language has in the sample before others fill it up
EPOCHS = 2
UNKNOWN = "und"

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def term_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text's character n-grams and their counts."""
    c = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "replace"), np.uint32)
    h = c.copy()
    counts = np.zeros(1 << BITS, np.int64)
    for k in ORDERS:
        if k > 1:
            if len(c) < k:
                break
            h = h[:-1] * np.uint32(0x01000193) + c[k - 1:] * np.uint32(0x9E3779B1)
        g = h * np.uint32(0x85EBCA6B)
        counts += np.bincount((g ^ (g >> np.uint32(15))) >> np.uint32(32 - BITS), minlength=1 << BITS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, n = term_counts(text)
    x = (1.0 + np.log(n)) * idf[at]
    return at, x / max(float(np.sqrt(x @ x)), 1e-12)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Number of texts that hold each bucket, and of all texts: each task adds up its own
    rows, so ``2 ** BITS`` rows per task are shuffled and as many come back."""

    def run(batches):
        df, n = np.zeros(1 << BITS, np.int64), 0
        for b in batches:
            for raw in text_list(b.column("text")):
                df[term_counts(decode(raw))[0]] += 1
                n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(df[at], n), pa.int64())],
                                         names=["bucket", "n"])

    rows = texts(docs).select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = dict((r["bucket"], r["n"]) for r in rows.collect())  # 2 ** BITS rows at most
    total = got.pop(-1, 0)
    df = np.zeros(1 << BITS)
    df[list(got)] = list(got.values())
    return df, total


class LanguageModel:
    def __init__(self, languages: list[str], idf: np.ndarray):
        self.languages, self.idf = languages, idf
        self.w = np.zeros(((1 << BITS) + 1, len(languages)))
        self.temperature = 1.0

    def fit(self, sample: list[tuple[bytes, str]], epochs: int = EPOCHS) -> "LanguageModel":
        """Every fifth text of a language is held for the temperature, the others fit."""
        number = {k: i for i, k in enumerate(self.languages)}
        rows, held, seen = [], [], [0] * len(number)
        for t, y in sample:
            if y in number:
                seen[number[y]] += 1
                (held if seen[number[y]] % 5 == 0 else rows).append((*vector(decode(t), self.idf), number[y]))
        if rows:
            self.w = Ftrl(1 << BITS, len(self.languages), alpha=1.0, l1=0.01, l2=0.01).fit(rows, epochs).weights()
            held = held or rows
            logits = np.stack([x @ self.w[at] + self.w[-1] for at, x, _ in held])
            y = np.array([r[2] for r in held])
            grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))

            def loss(t):
                z = logits / t
                z = z - z.max(axis=1, keepdims=True)
                # a held text with smoothed labels, so that no error at all keeps T above zero
                logp = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
                return -(0.999 * logp[np.arange(len(y)), y] + 0.001 * logp.mean(axis=1)).mean()

            self.temperature = float(grid[np.argmin([loss(t) for t in grid])])
        return self

    def predict(self, text: str) -> tuple[str, float]:
        if not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        at, x = vector(text, self.idf)
        z = (x @ self.w[at] + self.w[-1]) / self.temperature
        p = np.exp(z - z.max())
        k = int(p.argmax())
        return self.languages[k], float(p[k] / p.sum())


def fit_language(docs: DataFrame, held_out, max_rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> LanguageModel:
    """Learn from ``docs`` (doc_id, text, lang) without the held-out rows and those without
    a language or text. Document frequencies and languages cover all of them; the weights are
    fitted on at most ``max_rows`` whole texts of ``max_bytes`` together, the first ``QUOTA``
    of each language among them (one of each even where that is more)."""
    train = docs.where(~held_out).where("lang is not null and text is not null and doc_id is not null")
    df, n = document_frequencies(train)
    sample = bounded_sample(train, train.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("label")),
                            max_rows, max_bytes, quota=QUOTA)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    return LanguageModel(sorted({y for _, y in sample}), idf).fit(sample)


def language(docs: DataFrame, model: LanguageModel, held_out) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, from whole texts, in one pass.

    A text that is null, empty or without a letter is ``und`` with score 0, and so is every
    text where nothing could be learned. Repeated rows are predicted each; ties between
    languages go to the first in alphabetical order.
    """

    def run(batches):
        for b in batches:
            got = [model.predict(decode(x)) for x in text_list(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return texts(docs, held_out.alias("held_out")).mapInArrow(run, SCHEMA)


def op4_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = fold(4) == 2
    return language(docs, fit_language(docs, held_out), held_out)
