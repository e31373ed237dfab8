"""Toxicity: a convolutional text classifier over hashed word embeddings (operator 7).

A word's vector is the sum of two hashed embeddings, one of the word and one of its first
bytes (compounds share it). Filters one, two and three words wide slide over the text, each
is max-pooled (its two largest values, so that one chance hit differs from several), and a
logistic layer reads the maxima. Training (Adam, in numpy) sees whole
texts; gradients flow through the pooled positions only. For scoring, embeddings and filters
are folded into one table, so a text costs two look-ups a word.

Thresholds are calibrated by language: the fitted model guesses a text's language from its
own words (never from a column), and shifts the logit by the threshold chosen for that
language, so that 0.7 is every language's threshold. Only the fit is sampled: the languages'
word statistics count all training documents, and the thresholds all labelled ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, fold, mix, segment_sum, sigmoid, table, text_list, texts, word_hashes, words

BITS = 16
DIM = 8
FILTERS = 4  # of each width
WIDTHS = (1, 2, 3)
PREFIX = 6  # bytes
PAD = max(WIDTHS) - 1
SAMPLE_ROWS = 4_000  # labelled texts to fit on, at most
SAMPLE_BYTES = 24 << 20
EPOCHS = 3
CUT = 0.7
BINS = 256  # of logits, to a unit
LEAST = 10  # toxic texts for a threshold of the language's own
OPEN_LANGUAGES = 64  # whose counts a task holds before it hands them on

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def word_buckets(h: np.ndarray, mult: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    return ((mix(h, mult) * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - BITS)).astype(np.int64)


def encode(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of words and of word starts, each text followed by ``PAD`` empty places
    (bucket ``2 ** BITS``), and the offsets of the texts with their padding."""
    docs = [words(x) for x in raw]
    h, offsets = word_hashes(docs)
    p, _ = word_hashes([[w[:PREFIX] for w in d] for d in docs])
    n = np.diff(offsets)
    place = np.arange(len(h)) + np.repeat(PAD * np.arange(len(docs)), n)
    out = []
    for x in (word_buckets(h), word_buckets(p, 0xBF58476D1CE4E5B9)):
        at = np.full(len(h) + PAD * len(docs), 1 << BITS, np.int64)
        at[place] = x
        out.append(at)
    return out[0], out[1], offsets + PAD * np.arange(len(docs) + 1)


class ToxicModel:
    """Parameters, training and scoring. Pickles to a few MB of arrays."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.columns = FILTERS * sum(WIDTHS)
        self.emb = (0.02 * rng.standard_normal(((1 << BITS) + 1, DIM))).astype(np.float32)
        self.emb[-1] = 0
        self.conv = (0.3 * rng.standard_normal((DIM, self.columns))).astype(np.float32)
        self.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = (0.1 * rng.standard_normal(2 * FILTERS * len(WIDTHS))).astype(np.float32)
        self.c = np.float32(-2.0)
        self.languages: list[str] = []
        self.lang_logp = np.zeros(((1 << BITS) + 1, 0), np.float32)
        self.shift = np.zeros(1)
        self.table = None

    # filter k of width w reads column block j (of FILTERS columns) of word i + j
    @staticmethod
    def blocks():
        col = 0
        for k, w in enumerate(WIDTHS):
            yield slice(k * FILTERS, (k + 1) * FILTERS), [slice(col + j * FILTERS, col + (j + 1) * FILTERS) for j in range(w)]
            col += w * FILTERS

    def activations(self, x: np.ndarray) -> np.ndarray:
        act = np.empty((len(x), len(self.bias)), np.float32)
        for f, cols in self.blocks():
            act[:, f] = x[:, cols[0]]
            for j, c in enumerate(cols[1:], 1):
                act[:len(x) - j, f] += x[j:, c]
        return act

    def pooled(self, x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per text: the largest value of every filter, then the second largest."""
        act = self.activations(x)
        top = np.maximum.reduceat(act, offsets[:-1], axis=0)
        hit = act == np.repeat(top, np.diff(offsets), axis=0)
        times = np.add.reduceat(hit, offsets[:-1], axis=0, dtype=np.int32)
        act[hit] = -np.inf
        second = np.maximum.reduceat(act, offsets[:-1], axis=0)
        return np.concatenate([top, np.where(times > 1, top, second)], axis=1)

    def pooled_places(self, x: np.ndarray, offsets: np.ndarray):
        """The same, with the word at which each value was found."""
        act = self.activations(x)
        at = np.empty((len(offsets) - 1, 2 * act.shape[1]), np.int64)
        col = np.arange(act.shape[1])
        for k in range(len(at)):
            part = act[offsets[k]:offsets[k + 1]]
            first = part.argmax(axis=0)
            kept = part[first, col].copy()
            part[first, col] = -np.inf
            at[k] = offsets[k] + np.concatenate([first, part.argmax(axis=0)])
            part[first, col] = kept
        return act[at, np.tile(col, 2)], at

    def warm_start(self, coded: list, y: np.ndarray) -> None:
        """First embedding direction: the log-odds of a bucket between the two labels; one
        text's buckets at a time."""
        rows = [int((y == v).sum()) for v in (0, 1)]
        for side in (0, 1):
            seen = np.zeros((2, (1 << BITS) + 1))
            for codes, label in zip(coded, y):
                seen[label, np.unique(codes[side])] += 1
            rate = [(s + 0.5) / (max(n, 1) + 1.0) for s, n in zip(seen, rows)]
            total = seen[0] + seen[1]
            self.emb[:, 0] += np.clip(0.25 * np.log(rate[1] / rate[0]) * total / (total + 10.0), -1, 1)
        self.emb[-1] = 0
        self.conv[0, :FILTERS] = np.abs(self.conv[0, :FILTERS])

    def fit(self, sample: list, epochs: int = EPOCHS, batch: int = 64, seed: int = 11) -> "ToxicModel":
        """``sample``: (text, label); the last fifth is not learned from, so that thresholds
        over a table no larger than the sample see texts that are new to the model."""
        if not sample:
            return self.fold()
        y = np.array([lab for _, lab in sample], np.int64)
        cut = max(1, len(sample) * 4 // 5)
        coded = [tuple(c.astype(np.int32) for c in encode([t])) for t, _ in sample]
        self.warm_start(coded[:cut], y[:cut])
        rng = np.random.default_rng(seed)
        state = {k: [np.zeros_like(getattr(self, k)) for _ in range(2)] for k in ("emb", "conv", "bias", "out", "c")}
        t = 0
        for _ in range(epochs):
            order = rng.permutation(cut)
            for lo in range(0, cut, batch):
                t += 1
                part = order[lo:lo + batch]
                hw = np.concatenate([coded[k][0] for k in part])
                hp = np.concatenate([coded[k][1] for k in part])
                offsets = np.concatenate([[0], np.cumsum([len(coded[k][0]) for k in part])])
                e = self.emb[hw] + self.emb[hp]
                top, at = self.pooled_places(e @ self.conv, offsets)
                act = np.maximum(top + np.tile(self.bias, 2), 0)
                err = (sigmoid(act @ self.out + self.c) - y[part]).astype(np.float32) / len(part)
                g_act = err[:, None] * self.out * (act > 0)
                grad = {"out": act.T @ err, "c": err.sum(), "bias": g_act.sum(0).reshape(2, -1).sum(0), "conv": np.zeros_like(self.conv)}
                rows, g_rows = [], []
                for f, cols, rank in ((f, cols, rank) for f, cols in self.blocks() for rank in (0, len(self.bias))):
                    ranked = slice(f.start + rank, f.stop + rank)
                    for j, c in enumerate(cols):
                        place = np.minimum(at[:, ranked] + j, len(e) - 1)  # (texts, FILTERS)
                        ev = e[place]  # (texts, FILTERS, DIM)
                        grad["conv"][:, c] += np.einsum("bf,bfd->df", g_act[:, ranked], ev)
                        g_e = (g_act[:, ranked, None] * self.conv[:, c].T[None]).reshape(-1, DIM)
                        for h in (hw, hp):
                            rows.append(h[place].ravel())
                            g_rows.append(g_e)
                rows, inv = np.unique(np.concatenate(rows), return_inverse=True)
                ge = np.zeros((len(rows), DIM), np.float32)
                np.add.at(ge, inv, np.concatenate(g_rows))
                keep = rows < (1 << BITS)
                self.adam("emb", ge[keep], state, t, rows[keep])
                for k in ("conv", "bias", "out", "c"):
                    self.adam(k, grad[k], state, t)
        return self.fold()

    def adam(self, name: str, g, state, t: int, at=None, rate: float = 0.01) -> None:
        m, v = state[name]
        if at is None:
            m[...] = 0.9 * m + 0.1 * g
            v[...] = 0.999 * v + 0.001 * g * g
            now_m, now_v = m, v
        else:
            m[at] = 0.9 * m[at] + 0.1 * g
            v[at] = 0.999 * v[at] + 0.001 * g * g
            now_m, now_v = m[at], v[at]
        step = rate * (now_m / (1 - 0.9 ** t)) / (np.sqrt(now_v / (1 - 0.999 ** t)) + 1e-8)
        if at is None:
            setattr(self, name, (getattr(self, name) - step).astype(np.float32))
        else:
            self.emb[at] -= step.astype(np.float32)

    def know(self, counts: dict[str, np.ndarray]) -> "ToxicModel":
        """Word statistics by language, from the counts of every word bucket."""
        self.languages = sorted(counts)
        count = np.full(((1 << BITS) + 1, len(counts)), 0.1)
        for k, lang in enumerate(self.languages):
            count[:-1, k] += counts[lang]
        self.lang_logp = np.log(count / count.sum(0)).astype(np.float32)
        self.lang_logp[-1] = 0
        self.shift = np.zeros(len(counts) + 1)
        return self

    def calibrate(self, guess: np.ndarray, z: np.ndarray, y: np.ndarray, n: np.ndarray) -> "ToxicModel":
        """One threshold per language from counts ``n`` of (guessed language, logit, label);
        a language with too few of either label gets that of all."""
        if len(n):
            overall = best_cut(z, y, n)
            for k in range(len(self.shift)):
                own = guess == k
                toxic = n[own] @ y[own]
                self.shift[k] = best_cut(z[own], y[own], n[own]) if LEAST <= toxic < n[own].sum() else overall
        return self

    def fold(self) -> "ToxicModel":
        self.table = self.emb @ self.conv
        return self

    def logits(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Uncalibrated logits and the guessed language (its number; the last is none)."""
        z, guess = [], []
        for part in groups(raw, 1 << 20):
            hw, hp, offsets = encode(part)
            x = self.table[hw]
            x += self.table[hp]
            act = np.maximum(self.pooled(x, offsets) + np.tile(self.bias, 2), 0)
            z.append(act @ self.out + self.c)
            if self.languages:
                s = np.stack([segment_sum(self.lang_logp[hw, k], offsets) for k in range(len(self.languages))], axis=1)
                guess.append(np.where(np.diff(offsets) > PAD, s.argmax(axis=1), len(self.languages)))
            else:
                guess.append(np.zeros(len(part), np.int64))
        return np.concatenate(z or [np.zeros(0)]).astype(np.float64), np.concatenate(guess or [np.zeros(0, np.int64)])

    def score(self, raw: list[bytes]) -> np.ndarray:
        z, guess = self.logits(raw)
        return sigmoid(z - self.shift[guess] + np.log(CUT / (1 - CUT)))


def groups(raw: list[bytes], size: int):
    """Consecutive texts of about ``size`` bytes together (a longer one alone)."""
    part, used = [], 0
    for x in raw:
        if part and used + len(x) > size:
            yield part
            part, used = [], 0
        part.append(x)
        used += len(x)
    if part:
        yield part


def best_cut(z: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> float:
    """The middle of the widest-margin cut with the fewest errors; ``n`` are row counts."""
    n = np.ones(len(z)) if n is None else n
    z, at = np.unique(z, return_inverse=True)
    one, zero = np.bincount(at, n * y), np.bincount(at, n * (1 - y))
    errors = np.concatenate([[0], np.cumsum(one)]) + np.concatenate([np.cumsum(zero[::-1])[::-1], [0]])
    edges = np.concatenate([[z[0] - 2], z, [z[-1] + 2]])
    best = np.flatnonzero(errors == errors.min())
    k = best[np.argmax(edges[best + 1] - edges[best])]
    return float((edges[k] + edges[k + 1]) / 2)


def word_counts(docs: DataFrame) -> dict[str, np.ndarray]:
    """Occurrences of every word bucket by language, over all rows with one: each task adds
    up its own rows, so at most ``2 ** BITS`` rows per task and language are shuffled."""

    def rows(open_counts):
        for lang, c in open_counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(c[at], pa.int64())],
                                             names=["lang", "bucket", "n"])

    def run(batches):
        held = {}
        for b in batches:
            langs, raw = b.column("lang").to_pylist(), text_list(b.column("text"))
            for lang in set(langs):
                if lang not in held and len(held) >= OPEN_LANGUAGES:
                    yield from rows(held)
                    held = {}
                count = held.setdefault(lang, np.zeros(1 << BITS, np.int64))
                for part in groups([t for t, own in zip(raw, langs) if own == lang], 1 << 20):
                    count += np.bincount(word_buckets(word_hashes([words(t) for t in part])[0]), minlength=1 << BITS)
        yield from rows(held)

    own = docs.where("lang is not null and text is not null")
    got = (texts(own, F.col("lang").cast("string").alias("lang")).select("lang", "text").mapInArrow(run, "lang string, bucket long, n long")
           .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    out = {}
    for b in got.toArrow().to_batches():  # 2 ** BITS rows per language at most
        langs = b.column("lang").dictionary_encode()
        bucket, n = b.column("bucket").to_numpy(), b.column("n").to_numpy()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            at = np.flatnonzero(langs.indices.to_numpy() == k)
            out.setdefault(lang, np.zeros(1 << BITS, np.int64))[bucket[at]] += n[at]
    return out


def logit_counts(docs: DataFrame, labels: DataFrame, model: ToxicModel) -> tuple[np.ndarray, ...]:
    """Guessed languages, logits (middles of bins), labels and numbers of all rows of ``docs``
    with a label. Texts are scored where they are read; ids and bins meet the labels."""

    def run(batches):
        for b in batches:
            z, guess = model.logits(text_list(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(guess, pa.int32()), pa.array(np.rint(z * BINS).astype(np.int64), pa.int64())],
                                             names=["doc_id", "guess", "bin"])

    scored = texts(docs.where("doc_id is not null and text is not null")).mapInArrow(run, "doc_id long, guess int, bin long")
    got = scored.join(labels, "doc_id").groupBy("guess", "bin", "label").agg(F.count("*").alias("n")).toArrow()
    guess, at, y, n = (got.column(c).to_numpy() for c in ("guess", "bin", "label", "n"))
    return guess, at / BINS, y, n


def fit_toxicity(docs: DataFrame, labels: DataFrame, held_out, max_rows: int = SAMPLE_ROWS,
                 max_bytes: int = SAMPLE_BYTES) -> ToxicModel:
    """Fit on at most ``max_rows`` labelled texts; ``labels`` is (doc_id, label 0/1). Languages
    (the column of ``docs``, if there is one) and thresholds are learned from all rows that
    are not held out, in a pass each."""
    train = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
             .where(~held_out).where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.max("label").alias("label")))
    model = ToxicModel()
    sample = bounded_sample(docs, train, max_rows, max_bytes)
    if not sample:
        return model.fold()
    model.fit(sample)
    learned = docs.where(~held_out).where("doc_id is not null")
    if "lang" in docs.columns:
        model.know(word_counts(learned))
    return model.calibrate(*logit_counts(learned, train, model))


def toxicity(docs: DataFrame, model: ToxicModel, held_out) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``, in one pass.

    Null and empty texts hold no word: every filter's maximum is that of the padding.
    Without any training label the model says the same of every text. Repeated rows are
    scored each; texts of any length are read whole.
    """
    model.emb = None  # the folded table is all that scoring needs

    def run(batches):
        for b in batches:
            p = model.score(text_list(b.column("text")))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(p, pa.float64()),
                 pa.array((p >= CUT).astype(np.int32), pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    return texts(docs, held_out.alias("held_out")).mapInArrow(run, SCHEMA)


def drop_toxic(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """Rows of ``docs``, all columns, whose text scores below the cut; one pass."""
    model.emb = None

    def run(batches):
        for b in batches:
            p = model.score(text_list(b.column("text").cast(pa.binary())))
            yield b.filter(pa.array(p < CUT, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op7_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    held_out = fold(3) == 1
    return toxicity(docs, fit_toxicity(docs, labels, held_out), held_out)
