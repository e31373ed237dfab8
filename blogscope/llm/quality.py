"""Quality classifier: hashed word n-grams, logistic FTRL, sparse dot products (operator 5).

Tokens are runs of letters and digits and runs of other visible characters, so that
markup and symbol noise are words of their own. Unigrams and bigrams are hashed into
``2 ** BITS`` buckets, the bigrams of one token with itself all into one; a feature's value
is its share of the text's n-grams.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, fold, mix, segment_sum, sigmoid, table, text_list, texts, word_hashes
from .ftrl import Ftrl

BITS = 18
REPEAT = 0  # bucket of a token that follows itself
SCALE = 30.0  # value of a feature that is the whole text
SAMPLE_ROWS = 8_000  # labelled texts to fit on, at most
SAMPLE_BYTES = 32 << 20
EPOCHS = 3
CUT = 0.7
TOKEN = rb"[a-z0-9\x80-\xff]+|[^a-z0-9\x80-\xff\s]+"

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def ngrams(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all unigrams, of all bigrams (with a start mark), offsets of the texts."""
    find = re.compile(TOKEN).findall
    h, offsets = word_hashes([find(x.lower()) for x in raw])
    before = np.empty_like(h)
    before[1:] = h[:-1]
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[starts] = 7
    again = h == before
    shift = np.uint64(64 - BITS)
    uni = mix(h, 0x9E3779B97F4A7C15) * np.uint64(0xBF58476D1CE4E5B9)
    both = (mix(before, 0x94D049BB133111EB) + h) * np.uint64(0x9E3779B97F4A7C15)
    both = (both >> shift).astype(np.int64)
    both[again] = REPEAT
    return (uni >> shift).astype(np.int64), both, offsets


def fit(sample: list[tuple[bytes, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last one is the bias) of a logistic model; zeros without samples."""
    rows = []
    uni, both, offsets = ngrams([t for t, _ in sample])
    for k, (_, y) in enumerate(sample):
        part = slice(offsets[k], offsets[k + 1])
        at, c = np.unique(np.concatenate([uni[part], both[part]]), return_counts=True)
        rows.append((at, c * (SCALE / max(c.sum(), 1)), float(y)))
    return Ftrl(1 << BITS).fit(rows, epochs).weights()[:, 0].astype(np.float32)


def score(raw: list[bytes], w: np.ndarray) -> np.ndarray:
    """Probabilities of label 1: one gathered weight per n-gram, summed per text."""
    uni, both, offsets = ngrams(raw)
    total = segment_sum(w[uni], offsets) + segment_sum(w[both], offsets)
    n = np.maximum(2 * np.diff(offsets), 1)
    return sigmoid(total * (SCALE / n) + float(w[-1]))


def quality(docs: DataFrame, labels: DataFrame, held_out, max_rows: int = SAMPLE_ROWS,
            max_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    ``labels`` is (doc_id, label 0/1); rows whose ``held_out`` expression (on doc_id) is
    true are never learned from. The fit uses at most ``max_rows`` labelled texts and
    ``max_bytes``; scoring is one pass without a shuffle over every whole text. Null and
    empty texts get the bias alone; without any label all scores are 0.5; repeated rows
    are scored each; null ids are scored and not learned from.
    """
    train = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    w = fit(bounded_sample(docs, train.where(~held_out), max_rows, max_bytes))

    def run(batches):
        for b in batches:
            raw = text_list(b.column("text"))
            p = np.concatenate([score(raw[k:k + 256], w) for k in range(0, len(raw), 256)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(p, pa.float64()),
                 pa.array((p >= CUT).astype(np.int32), pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    return texts(docs, held_out.alias("held_out")).mapInArrow(run, SCHEMA)


def op5_quality(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality(table(spark, sf_dir, "documents"), labels, fold(4) == 2)
