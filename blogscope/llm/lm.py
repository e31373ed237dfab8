"""LM scoring: causal self-attention on subword ids, beside smoothed word counts (operator 1).

Stored stages, each of bounded rows per task, and the training between them:

1. ``chunks``: documents are read into chunks of bounded size. A document becomes indices
   into its chunk's vocabulary; the vocabulary goes out by hash buckets, with the number of
   uses in training documents. The chunk's words are split into subwords, once each; the ids
   of its training documents are stored. Id classes, id counts and the attention layer are
   made from all of these ids, by sums over them (uses, neighbours, and the parameters that
   tasks have trained; see ``trained``).
2. ``counted``: a bucket sees its words from all chunks, so counts over the whole corpus are
   exact; they go back to the chunks. The buckets' sums give the corpus totals.
3. Chunks meet their words' counts and score their documents.

The model: p(id | before) = p(class | before) p(id | class, context). Ids that begin a word
and ids that go on with one never share a class, so the class says which of the two comes;
the context is the class of the id before for those that go on, none for those that begin.
The second factor is counted over all training documents, smoothed towards p(id | class). The
first is one causal attention layer with learned biases by distance and a residual, trained in
numpy on every training document. To score, embeddings and projections are folded into tables; a text
is cut into windows of ``2 * BLOCK`` ids that overlap by half, and each window scores its
second half, so every id is scored once. A word's probability is a mixture of the product
over its ids and of its share of all training words, so that counts of whole words, which
grow with the corpus, are part of the model and new words are left to the attention layer.
"""

from __future__ import annotations

import copy
import zlib
from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, stage, table, text_list, texts, tokenizer_path, word_hashes

MODEL = "piece_bpe_32k.model"
CHUNK_BYTES = 8 << 20
BEGIN, END = 1, 2
DIM, CLASSES, BLOCK = 24, 128, 16
SMOOTH = 5.0  # weight of p(id | class) against counts in context
KNOWN_IDS, CONTEXTS = 6_000, 256  # frequent ids that are clustered, by so many neighbours
FIRST_IDS, GROWTH = 1 << 22, 8  # ids of the first round of training, in one task; how much each round grows
UNIT_IDS = 1 << 21  # ids that a replica is trained on in later rounds
COUNT_IDS = 1 << 23  # ids of a task that counts neighbours, about
PARTS = 16  # slices that sums over tasks travel in
EPOCHS, BATCH = 4, 384  # passes over the ids of a small corpus, at most (otherwise one); rows of a step
UNIT, ONE = np.float32((1 << 23) / np.log(2)), np.float32(127 << 23)  # a float's bits are about ONE + UNIT * its logarithm
NONE = np.float32(-1e9)  # the bits of no share
RATE = 0.03  # falls to a tenth over the training
GROUP = 256  # rows of ids scored at a time
STEP_ROWS = 64  # rows of a step that are trained on at a time
MIX = 0.2  # weight of a word's share of all training words

CHUNK_SCHEMA = "chunk long, bucket int, doc_id long, held_out boolean, words binary, idx binary, n binary, sizes binary, pieces binary, ids binary"
COUNT_SCHEMA = "chunk long, idx binary, n binary, total long, known long"
RESULT_SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                 "base_score double, score double")


def tokens(raw: bytes) -> list[bytes]:
    """Words between ASCII white space of the text with A-Z in lower case."""
    return raw.lower().split()


def subwords(path: str):
    """A function from words to their lists of ids."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda batch: sp.encode([w.decode("utf-8", "replace") for w in batch], num_threads=1)


# --- stages 1 and 2 --------------------------------------------------------------


def chunk_rows(batches, buckets: int, path: str):
    """Rows of ``CHUNK_SCHEMA``: documents, the chunk's words by bucket, and one with the words'
    ids and those of the chunk's training documents, an end after each."""
    names = ["chunk", "bucket", "doc_id", "held_out", "words", "idx", "n", "sizes", "pieces", "ids"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.bool_()] + [pa.binary()] * 6
    split = subwords(path)
    number = TaskContext.get().partitionId() << 32
    vocabulary, docs, used = numbering(), [], 0

    def rows(chunk):
        out = [(chunk, None, d, h, None, i.tobytes(), None, None, None, None) for d, h, _, i in docs]
        listed = list(vocabulary)
        sizes, pieces = split_words(listed, split)
        ids = training_ids([i for _, _, t, i in docs if t], sizes, pieces)
        out.append((chunk, None, None, None, None, None, None, sizes.astype(np.int32).tobytes(), pieces.tobytes(), ids.tobytes()))
        n = np.bincount(np.concatenate([i for _, _, t, i in docs if t] or [np.empty(0, np.int32)]), minlength=len(listed))
        home = word_hashes([listed])[0] % np.uint32(buckets)
        order = np.argsort(home, kind="stable").astype(np.int32)
        edges = np.searchsorted(home[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)):
            at = order[edges[b]:edges[b + 1]]
            out.append((chunk, int(b), None, None, b"\n".join([listed[k] for k in at]), at.tobytes(), n[at].astype(np.int64).tobytes(), None, None, None))
        for lo in range(0, len(out), 1024):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[lo:lo + 1024]), kinds)], names=names)

    for b in batches:
        for d, h, t, raw in zip(b.column("doc_id").to_pylist(), b.column("held_out").to_pylist(),
                                b.column("train").to_pylist(), text_list(b.column("text"))):
            if docs and used + len(raw) > CHUNK_BYTES:
                yield from rows(number)
                number, vocabulary, docs, used = number + 1, numbering(), [], 0
            own = tokens(raw)
            docs.append((d, h, t, np.fromiter(map(vocabulary.__getitem__, own), np.int32, len(own))))
            used += len(raw)
    if docs:
        yield from rows(number)


def training_ids(docs: list[np.ndarray], sizes: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    """Subword ids of documents that are indices of words, an end after each."""
    if not docs:
        return np.empty(0, np.uint16)
    end = np.array([len(sizes)], np.int32)
    sizes, pieces = np.append(sizes, 1), np.append(pieces, np.uint16(END))
    at = np.concatenate([x for i in docs for x in (i, end)])
    return gathered(at, sizes, np.cumsum(sizes) - sizes, pieces)


def numbering() -> dict:
    """A dictionary that numbers its keys as they are first looked up."""
    return defaultdict(count().__next__)


def split_words(listed: list[bytes], split) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of ids of words, and the ids."""
    ids = []
    for lo in range(0, len(listed), 20_000):
        ids += split(listed[lo:lo + 20_000])
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return sizes, np.fromiter(chain.from_iterable(ids), np.uint16, int(sizes.sum()))


def gathered(at: np.ndarray, sizes: np.ndarray, start: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that belong to the entries ``at``, end to end."""
    s = sizes[at]
    return flat[np.repeat(start[at] - (np.cumsum(s) - s), s) + np.arange(s.sum())]


def count_rows(batches):
    """Rows of ``COUNT_SCHEMA`` from the word rows of whole buckets, one bucket after the
    other; last, the task's uses of all words, and how many words are used."""
    names = ["chunk", "idx", "n", "total", "known"]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    uses = known = 0

    def close(held):
        nonlocal uses, known
        word, n = {}, []
        keyed = []
        for chunk, words, idx, own in held:
            listed = words.split(b"\n")
            own = np.frombuffer(own, np.int64)
            at = np.empty(len(listed), np.int64)
            for k, w in enumerate(listed):
                j = at[k] = word.setdefault(w, len(word))
                if j == len(n):
                    n.append(0)
                n[j] += int(own[k])
            keyed.append((chunk, idx, at))
        total = np.array(n, np.int64)
        uses, known = uses + int(total.sum()), known + int((total > 0).sum())
        for lo in range(0, len(keyed), 256):
            yield batch([(chunk, idx, total[at].tobytes(), None, None) for chunk, idx, at in keyed[lo:lo + 256]])

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    bucket, held = None, []
    for b in batches:
        for r in b.to_pylist():
            if r["bucket"] != bucket:
                if held:
                    yield from close(held)
                bucket, held = r["bucket"], []
            held.append((r["chunk"], r["words"], r["idx"], r["n"]))
    if held:
        yield from close(held)
    yield batch([(None, None, None, uses, known)])


# --- the model ---------------------------------------------------------------------


def blocks_of(pieces: list[np.ndarray]):
    """Inputs and targets of texts as rows of ``BLOCK`` ids: begin mark and ids in, ids and
    end out. Also which targets are real, which rows begin a text, and the row offsets."""
    end = np.array([END], np.uint16)
    stream = np.concatenate([x for p in pieces for x in (p, end)] or [end[:0]])
    return stream_blocks(stream, np.array([len(p) + 1 for p in pieces], np.int64))


def stream_blocks(stream: np.ndarray, sizes: np.ndarray):
    """``blocks_of`` of texts that lie end to end, ``sizes`` ids each with their end marks."""
    rows = -(-sizes // BLOCK)
    offsets = np.concatenate([[0], np.cumsum(rows)]).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    before = np.empty(len(stream), np.int32)
    before[1:] = stream[:-1]
    before[starts] = BEGIN
    at = np.repeat(offsets[:-1] * BLOCK - starts, sizes) + np.arange(len(stream))
    x, y = np.zeros((2, offsets[-1] * BLOCK), np.int32)
    real = np.zeros(len(x), bool)
    x[at], y[at], real[at] = before, stream, True
    first = np.zeros(offsets[-1], bool)
    first[offsets[:-1]] = True
    return x.reshape(-1, BLOCK), y.reshape(-1, BLOCK), real.reshape(-1, BLOCK), first, offsets


def text_sizes(stream: np.ndarray) -> np.ndarray:
    """Sizes of the texts of a stream in which an end mark follows each (the tokenizer makes none);
    the last may be cut."""
    sizes = np.diff(np.flatnonzero(stream == END), prepend=-1)
    rest = len(stream) - int(sizes.sum())
    return np.append(sizes, rest) if rest else sizes


def neighbours(stream: np.ndarray, known: np.ndarray, size: int) -> np.ndarray:
    """How often each id of ``known`` follows and precedes each of the first ``CONTEXTS`` of
    them (or any other id), texts from begin to end mark: (known, 2 * (CONTEXTS + 1))."""
    sizes = text_sizes(stream)
    stream = np.insert(stream, np.cumsum(sizes) - sizes, BEGIN)
    row, col = np.full(size, -1), np.full(size, CONTEXTS)
    row[known], col[known[:CONTEXTS]] = np.arange(len(known)), np.arange(min(CONTEXTS, len(known)))
    width = CONTEXTS + 1
    out = np.zeros((len(known), 2 * width), np.int64)
    for a, b, shift in ((stream[1:], stream[:-1], 0), (stream[:-1], stream[1:], width)):
        r = row[a]
        ok = r >= 0
        out += np.bincount(r[ok] * 2 * width + col[b][ok] + shift, minlength=out.size).reshape(out.shape)
    return out


def context_uses(stream: np.ndarray, class_of: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Uses of each id in each context, at context * ids + id."""
    size = len(class_of)
    context = np.full(len(stream), CLASSES)
    context[1:] = class_of[stream[:-1]]
    context[begins[stream]] = CLASSES
    return np.bincount(context * size + stream, minlength=(CLASSES + 1) * size)


def powers(z: np.ndarray) -> np.ndarray:
    """2 ** x of z = (x + 127) * 2 ** 23, linear between whole x: the float of these bits."""
    bits = z.astype(np.int32)
    if bits.min(initial=1 << 23) < 1 << 23:
        np.maximum(bits, 1 << 23, out=bits)
    return bits.view(np.float32)


class AttentionModel:
    """One causal attention layer over id classes."""

    NAMES = ("emb", "wq", "wk", "wv", "wc", "bc", "dist")

    def __init__(self, size: int, begins: np.ndarray | None = None, seed: int = 13):
        """``begins`` says which ids begin a word (the end mark does, too)."""
        rng = np.random.default_rng(seed)
        self.size = size
        self.begins = np.zeros(size, bool) if begins is None else begins.copy()
        self.begins[END] = True
        self.class_of = np.zeros(size, np.int64)
        self.emb = (0.3 * rng.standard_normal((size, DIM))).astype(np.float32)
        for name in ("wq", "wk", "wv"):
            setattr(self, name, (rng.standard_normal((DIM, DIM)) / np.sqrt(DIM) * 0.5).astype(np.float32))
        self.wc = (0.1 * rng.standard_normal((DIM, CLASSES))).astype(np.float32)
        self.bc = np.zeros(CLASSES, np.float32)
        self.dist = np.zeros(2 * BLOCK, np.float32)
        away = (BLOCK + np.arange(BLOCK))[:, None] - np.arange(2 * BLOCK)[None, :]
        self.away, self.causal = np.maximum(away, 0), away >= 0

    def known(self, n: np.ndarray) -> np.ndarray:
        """The ids that are clustered, the most frequent first, from the uses of all ids."""
        at = np.argsort(-n, kind="stable")[:KNOWN_IDS]
        return at[n[at] >= 3]

    def cluster(self, n: np.ndarray, known: np.ndarray, seen: np.ndarray, rounds: int = 6) -> None:
        """Classes of ids with like neighbours (k-means on the square roots of neighbour
        shares, ``seen``), ids that begin words and others apart, by their shares of all
        uses ``n``; either kind's ids beyond the frequent ones share its last class."""
        share = n[self.begins].sum() / max(n.sum(), 1)
        middle = int(np.clip(round(CLASSES * share), 8, CLASSES - 8))  # classes of ids that begin words
        self.class_of = np.where(self.begins, middle - 1, CLASSES - 1)
        feats = seen.astype(np.float32)
        feats = np.sqrt(feats / np.maximum(feats.sum(axis=1, keepdims=True), 1))
        for kind, first, k in ((True, 0, middle - 1), (False, middle, CLASSES - middle - 1)):
            at = np.flatnonzero(self.begins[known] == kind)
            if len(at) <= k:
                self.class_of[known[at]] = first + np.arange(len(at))
                continue
            own_feats = feats[at]
            centre = own_feats[:k].copy()  # the most frequent ids
            for _ in range(rounds):
                own = (own_feats @ centre.T * 2 - (centre * centre).sum(axis=1)).argmax(axis=1)
                for c in range(k):
                    if (own == c).any():
                        centre[c] = own_feats[own == c].mean(axis=0)
            self.class_of[known[at]] = first + own

    def step(self, x, y, real, first):
        """Mean loss of the class of each real target, and gradients. Each row also sees the one
        before. Exponents need no shift (see ``id_scores``). In single precision they are
        ``powers``, and the gradients those of exact ones, which differ by a few percent. Shares
        of keys that a query must not see are exact zeros: products with numbers next to the
        smallest that floats hold are many times slower. A group's arrays fit into a core's cache."""
        flat, count = x.ravel(), max(int(real.sum()), 1)
        scale = np.float32(DIM ** -0.5)
        w = np.concatenate([self.wq * scale, self.wk, self.wv], axis=1)
        order = np.argsort(flat.astype(np.uint16), kind="stable")
        listed = flat[order]
        starts = np.flatnonzero(np.diff(listed, prepend=-1))
        inv, rows = np.empty(len(flat), np.int64), listed[starts]  # ids occur often in a step, so they are projected once
        inv[order] = np.repeat(np.arange(len(rows)), np.diff(starts, append=len(flat)))
        e = self.emb[rows]
        t = np.take(e @ w, inv, axis=0).reshape(len(x), BLOCK, 3 * DIM)
        e = np.take(e, inv, axis=0)
        kind = t.dtype
        quick = kind == np.float32  # both softmaxes as in id_scores
        bias = np.where(self.causal, self.dist[self.away], -1e9).astype(kind)
        out_w = np.vstack([self.wc, self.bc]).astype(kind)
        if quick:
            bias = np.where(self.causal, bias * UNIT + ONE, ONE).astype(kind)  # what must not be seen is set to 0 below
            out_w *= UNIT
            out_w[DIM] += ONE
        wc_t, seen = np.ascontiguousarray(self.wc.T), self.causal.astype(kind)
        cls, own = self.class_of[y.ravel()], (real.ravel() / count).astype(kind)
        gt, gh = np.empty_like(t), np.empty((len(flat), DIM), kind)
        g_out, g_dist, loss = np.zeros((DIM + 1, CLASSES)), np.zeros(self.causal.shape), 0.0
        group = min(STEP_ROWS, len(x))
        kv, gkv = np.zeros((2, group, 2 * BLOCK, 2 * DIM), kind)
        h = np.ones((group * BLOCK, DIM + 1), kind)
        logits = np.empty((group * BLOCK, CLASSES), kind)
        keys, classes, every = np.ones((2 * BLOCK, 1), kind), np.ones(CLASSES, kind), np.arange(group * BLOCK)
        for lo in range(0, len(x), group):
            tg = t[lo:lo + group]
            n, cut = len(tg), slice(lo * BLOCK, lo * BLOCK + len(tg) * BLOCK)
            q, k = tg[..., :DIM], kv[:n, :, :DIM]
            kv[:n, BLOCK:] = tg[..., DIM:]
            kv[1:n, :BLOCK] = tg[:-1, :, DIM:]
            if lo:
                kv[0, :BLOCK] = t[lo - 1, :, DIM:]
            kv_t = np.ascontiguousarray(kv[:n].transpose(0, 2, 1))
            a = q @ kv_t[:, :DIM]
            if quick:
                a *= UNIT
                a += bias
                a = powers(a)
            else:
                a += bias
                np.exp(a, out=a)
            a *= seen
            a[first[lo:lo + n], :, :BLOCK] = 0
            a /= a @ keys
            hg, z, c = h[:n * BLOCK], logits[:n * BLOCK], cls[cut]
            np.add((a @ kv[:n, :, DIM:]).reshape(-1, DIM), e[cut], out=hg[:, :DIM])
            np.matmul(hg, out_w, out=z)
            p = powers(z) if quick else np.exp(z, out=z)
            total = p @ classes
            loss += float((np.log(total) - np.log(np.maximum(p[every[:len(c)], c], 1e-30))) @ own[cut])
            p[every[:len(c)], c] -= total
            part = (own[cut] / total)[:, None]
            g_out += (hg * part).T @ p
            gg = np.matmul(p, wc_t, out=gh[cut])
            gg *= part
            gg = gg.reshape(n, BLOCK, DIM)
            np.matmul(a.transpose(0, 2, 1), gg, out=gkv[:n, :, DIM:])
            ga = gg @ kv_t[:, DIM:]
            ga *= a
            a *= ga @ keys
            ga -= a
            g_dist += ga.sum(axis=0)
            np.matmul(ga, k, out=gt[lo:lo + n, :, :DIM])
            np.matmul(ga.transpose(0, 2, 1), q, out=gkv[:n, :, :DIM])
            gt[lo:lo + n, :, DIM:] = gkv[:n, BLOCK:]
            back = slice(1 if lo == 0 else 0, n)  # rows that begin a text give zeros
            gt[lo + back.start - 1:lo + n - 1, :, DIM:] += gkv[back, :BLOCK]
        g = {"wc": g_out[:DIM], "bc": g_out[DIM], "dist": np.bincount(self.away.ravel(), (g_dist * self.causal).ravel(), 2 * BLOCK)}
        gt = gt.reshape(-1, 3 * DIM)
        gw = e.T @ gt
        g["wq"], g["wk"], g["wv"] = gw[:, :DIM] * scale, gw[:, DIM:2 * DIM], gw[:, 2 * DIM:]
        ge = gh + gt @ w.T
        g["emb"] = np.add.reduceat(ge[order], starts, axis=0)
        return loss, g, rows

    def train(self, stream: np.ndarray, epochs: int, rate: float, last: float, seed: int = 7) -> list[float]:
        """Adam over the texts of a stream, at a rate that falls from ``rate`` to ``last``;
        returns the mean loss of each epoch."""
        x, y, real, first, _ = stream_blocks(stream, text_sizes(stream))
        m = {k: np.zeros_like(getattr(self, k)) for k in self.NAMES}
        v = {k: np.zeros_like(getattr(self, k)) for k in self.NAMES}
        rng, t, losses = np.random.default_rng(seed), 0, []
        starts = np.arange(0, len(x), BATCH)
        for epoch in range(epochs):
            total = []
            for lo in rng.permutation(starts):
                cut = slice(lo, lo + BATCH)
                own = first[cut].copy()
                own[0] = True  # a batch may begin inside a text
                loss, g, rows = self.step(x[cut], y[cut], real[cut], own)
                total.append(loss)
                t += 1
                now = rate * (last / rate) ** (t / (epochs * len(starts)))
                for k in self.NAMES:
                    at = rows if k == "emb" else slice(None)
                    m_new, v_new, change = m[k][at], v[k][at], g[k].astype(np.float32)
                    m_new *= np.float32(0.9)
                    m_new += np.float32(0.1) * change
                    change *= change
                    v_new *= np.float32(0.99)
                    v_new += np.float32(0.01) * change
                    m[k][at], v[k][at] = m_new, v_new
                    np.divide(v_new, np.float32(1 - 0.99 ** t), out=change)
                    np.sqrt(change, out=change)
                    change += np.float32(1e-8)
                    np.divide(m_new, change, out=change)
                    change *= np.float32(now / (1 - 0.9 ** t))
                    getattr(self, k)[at] -= change
            losses.append(float(np.mean(total)))
        return losses

    def fit(self, pieces: list[np.ndarray], epochs: int = EPOCHS) -> list[float]:
        """Cluster and train on whole texts in this process; returns the mean loss of each epoch."""
        if not pieces:
            return []
        stream = np.concatenate([np.append(p, END) for p in pieces])
        n = np.bincount(stream, minlength=self.size)
        known = self.known(n)
        self.cluster(n, known, neighbours(stream, known, self.size))
        return self.train(stream, epochs, RATE, RATE / 10)

    def packed(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES])

    def unpack(self, values: np.ndarray) -> None:
        lo = 0
        for k in self.NAMES:
            old = getattr(self, k)
            setattr(self, k, values[lo:lo + old.size].reshape(old.shape).astype(np.float32))
            lo += old.size

    def finish(self, counts: np.ndarray) -> "AttentionModel":
        """Set p(id | class, context) from counts (contexts, ids) over the corpus, and fold
        the tables for scoring."""
        n = counts.sum(axis=0) + 0.5
        p_id = n / np.bincount(self.class_of, n, CLASSES)[self.class_of]
        self.logp_id = np.empty(counts.shape, np.float32)
        for k, own in enumerate(counts):
            per_class = np.bincount(self.class_of, own, CLASSES)[self.class_of]
            self.logp_id[k] = np.log((own + SMOOTH * p_id) / (per_class + SMOOTH))
        self.bc = np.where(np.bincount(self.class_of, minlength=CLASSES) > 0, self.bc, -1e9).astype(np.float32)  # no id, no mass
        self.out_bits = np.vstack([self.wc * UNIT, np.maximum(self.bc * UNIT + ONE, NONE)])
        scale = np.float32(DIM ** -0.5)
        self.folded = np.concatenate([self.emb @ self.wq * (scale * UNIT), self.emb @ self.wk, self.emb @ self.wv, self.emb], axis=1)
        self.bias = np.where(self.causal, self.dist[self.away] * UNIT + ONE, NONE).astype(np.float32)
        return self

    def id_scores(self, pieces: list[np.ndarray], group: int = GROUP):
        """Natural log probabilities of the ids of texts and of their ends, in rows of blocks,
        and the offsets of the texts' rows. Exponents need no shift: inputs of both softmaxes
        are small. They are ``powers``, each used for its share and for the sum alike, so the
        shares sum to 1. A group's arrays fit into a core's cache."""
        x, y, real, first, offsets = blocks_of(pieces)
        context = np.where(self.begins[y], CLASSES, self.class_of[x])
        within = self.logp_id.reshape(-1)[context * self.size + y]
        rows = np.empty(x.shape, np.float32)
        group = max(1, min(group, len(x)))
        kk, vv = np.zeros((group + 1, DIM, 2 * BLOCK), np.float32), np.zeros((group + 1, 2 * BLOCK, DIM), np.float32)
        scores, logits = np.empty((group, BLOCK, 2 * BLOCK), np.float32), np.empty((group * BLOCK, CLASSES), np.float32)
        inner = np.ones((group, BLOCK, DIM + 1), np.float32)
        ones, every = np.ones(max(CLASSES, 2 * BLOCK), np.float32), np.arange(group * BLOCK)
        last = 0
        for lo in range(0, len(x), group):
            xs, ys = x[lo:lo + group], y[lo:lo + group]
            n = len(xs)
            t = self.folded[xs]
            part = t[..., DIM:2 * DIM].transpose(0, 2, 1)  # keys lie in columns, which makes the products faster
            kk[0, :, :BLOCK] = kk[last, :, :BLOCK]  # the block before the first one
            kk[1:n + 1, :, :BLOCK] = part
            kk[:n, :, BLOCK:] = part
            part = t[..., 2 * DIM:3 * DIM]
            vv[0, :BLOCK] = vv[last, :BLOCK]
            vv[1:n + 1, :BLOCK] = part
            vv[:n, BLOCK:] = part
            last = n
            a = np.matmul(t[..., :DIM], kk[:n], out=scores[:n])
            a += self.bias
            a = powers(a)
            a[first[lo:lo + n], :, :BLOCK] = 0
            h = a @ vv[:n]
            h /= (a @ ones[:2 * BLOCK])[..., None]
            np.add(h, t[..., 3 * DIM:], out=inner[:n, :, :DIM])
            z = powers(np.matmul(inner[:n].reshape(-1, DIM + 1), self.out_bits, out=logits[:n * BLOCK]))
            target = z[every[:n * BLOCK], self.class_of[ys].ravel()]
            rows[lo:lo + n] = np.log(target / (z @ ones[:CLASSES])).reshape(xs.shape) + within[lo:lo + n]
        return rows, offsets

    def score(self, pieces: list[np.ndarray], sizes: list[np.ndarray], shares: list[np.ndarray], unknown: float,
              group: int = GROUP) -> np.ndarray:
        """log10 probability of each text: its words, then the end. ``sizes`` are the numbers
        of ids of every word and the end, ``shares`` their shares of all training words;
        ``unknown`` stands in for the ids of a word that has none (its characters are ignored
        by the tokenizer)."""
        rows, offsets = self.id_scores(pieces, group)
        flat = rows.reshape(-1)
        out = np.zeros(len(pieces))
        for k, (size, share) in enumerate(zip(sizes, shares)):
            ids = flat[offsets[k] * BLOCK:offsets[k] * BLOCK + len(pieces[k]) + 1].astype(np.float64)
            log_p = np.full(len(size), np.log(unknown))
            some = size > 0
            log_p[some] = np.add.reduceat(ids, (np.cumsum(size) - size)[some])
            out[k] = np.log10(MIX * share + (1 - MIX) * np.exp(log_p)).sum()
        return out


# --- stage 3 -----------------------------------------------------------------------


def score_rows(batches, model: AttentionModel, total: int, distinct: int, ends: int):
    """Results of whole chunks, the rows of their words before their documents."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    chunk, held, words, docs = None, [], None, []
    scale = np.log10(float(total + distinct + 1))
    unknown = 1.0 / (total + distinct + 1)

    def known():
        own = next(r for r in held if r["sizes"] is not None)
        sizes, flat = np.frombuffer(own["sizes"], np.int32).astype(np.int64), np.frombuffer(own["pieces"], np.uint16)
        n = np.zeros(len(sizes), np.int64)
        for r in held:
            if r["n"] is not None:
                n[np.frombuffer(r["idx"], np.int32)] = np.frombuffer(r["n"], np.int64)
        return n, sizes, np.cumsum(sizes) - sizes, flat

    def close():
        n, sizes, start, flat = words
        rows, pieces, lengths, shares = [], [], [], []
        for r in docs:
            idx = np.frombuffer(r["idx"], np.int32)
            c = n[idx]
            base = np.log10(c + 1.0).sum() + np.log10(ends + 1.0) - (len(idx) + 1) * scale
            pieces.append(gathered(idx, sizes, start, flat))
            lengths.append(np.append(sizes[idx], 1))
            shares.append(np.append(c, ends) / max(total, 1))
            rows.append((r["doc_id"], r["held_out"], len(idx) + 1, int((c > 0).sum()) + (ends > 0), total, float(base)))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*zip(*rows), model.score(pieces, lengths, shares, unknown)], kinds)], names=names)

    for b in batches:
        for r in b.to_pylist():
            if r["chunk"] != chunk:
                if docs:
                    yield close()
                chunk, held, words, docs = r["chunk"], [], None, []
            if not r["is_doc"]:
                held.append(r)
                continue
            if words is None:
                words, held = known(), []
            docs.append(r)
            if len(docs) == 256:
                yield close()
                docs = []
    if docs:
        yield close()


# --- training over all documents ------------------------------------------------------


def summed(rows: DataFrame, made, kind: str) -> np.ndarray | None:
    """The sum of the arrays that ``made`` makes of the ``ids`` of each task (None: nothing), all of
    one length. They meet in slices, so only the sum comes to the driver."""
    counts, wide = kind == "i8", "i8" if kind == "i8" else "f8"

    def parts(batches):
        whole = made(np.frombuffer(raw, np.uint16) for b in batches for raw in b.column("ids").to_pylist())
        if whole is not None:
            for k, own in enumerate(np.array_split(whole, PARTS)):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([blob(own.astype(kind))])], names=["part", "sums"])

    def blob(own):
        return zlib.compress(own.tobytes(), 1) if counts else own.tobytes()

    def array(raw, as_kind):
        return np.frombuffer(zlib.decompress(raw) if counts else raw, as_kind)

    def added(batches):
        total = {}
        for b in batches:
            for k, raw in zip(b.column("part").to_pylist(), b.column("sums").to_pylist()):
                own = array(raw, kind)
                total[k] = total[k] + own if k in total else own.astype(wide)
        for k, own in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([blob(own)])], names=["part", "sums"])

    schema = "part int, sums binary"
    got = rows.select("ids").mapInArrow(parts, schema).repartition(PARTS, "part").mapInArrow(added, schema).collect()
    return np.concatenate([array(r["sums"], wide) for r in sorted(got, key=lambda r: r["part"])]) if got else None


def added_up(arrays) -> np.ndarray | None:
    total = None
    for own in arrays:
        total = own if total is None else np.add(total, own, out=total)
    return total


def replicas(streams, model: AttentionModel, most: int, epochs: int, rate: float, last: float) -> np.ndarray | None:
    """Sums over units of about ``most`` ids of the parameters that ``model`` gets by training
    on them, times their weights, and the weights. An embedding weighs as much as the unit uses
    its id, so ids that few units have move as the others do; the rest weighs as the unit's ids."""
    total = weights = None
    emb = model.emb.size

    def close(held):
        nonlocal total, weights
        stream = np.concatenate(held)
        own = copy.deepcopy(model)
        own.train(stream, epochs, rate, last)
        uses = np.bincount(stream, minlength=model.size)
        uses[BEGIN] = uses[END]
        w = np.append(uses, len(stream)).astype(np.float64)
        values = own.packed().astype(np.float64)
        values[:emb] *= np.repeat(w[:-1], DIM)
        values[emb:] *= w[-1]
        total, weights = (values, w) if total is None else (total + values, weights + w)

    held, n = [], 0
    for stream in streams:
        for lo in range(0, len(stream), 4 * most):  # in parts only if it is one huge text
            held.append(stream[lo:lo + 4 * most])
            n += len(held[-1])
            if n >= most:
                close(held)
                held, n = [], 0
    if held:
        close(held)
    return None if total is None else np.concatenate([total, weights])


def rounds_of(n: int) -> list[tuple[float, float, int]]:
    """Rounds of training on ``n`` ids, as shares of the chunks (from, to) and passes. Together they
    hold every chunk once; a small corpus is one round of several passes."""
    if n <= FIRST_IDS:
        return [(0.0, 1.0, min(EPOCHS, max(1, FIRST_IDS // max(n, 1))))]
    edges = [0.0, FIRST_IDS / n]
    while edges[-1] < 1:
        edges.append(1.0 if edges[-1] * GROWTH * 1.5 > 1 else edges[-1] * GROWTH)
    return [(a, b, 1) for a, b in zip(edges, edges[1:])]


def trained(chunks: DataFrame, size: int, begins: np.ndarray) -> AttentionModel:
    """The model's classes, attention layer and id counts from all stored ids. The first round is trained in
    one task; each later one has several times the ids, dealt over tasks in units of
    ``UNIT_IDS`` that start at the mean of the round before. Every id is trained on."""
    model = AttentionModel(size, begins)
    rows = chunks.where("octet_length(ids) > 0").select("chunk", "ids")
    n = summed(rows, lambda streams: added_up(np.bincount(s, minlength=size) for s in streams), "i8")
    if n is None:
        return model.finish(np.zeros((CLASSES + 1, size)))
    ids = int(n.sum())
    n[BEGIN] = n[END]  # a begin mark for every end mark
    counting, known = rows.coalesce(max(1, ids // COUNT_IDS)), model.known(n)
    if len(known):
        seen = summed(counting, lambda streams: added_up(neighbours(s, known, size).ravel() for s in streams), "i8")
        model.cluster(n, known, seen.reshape(len(known), -1))
    place = F.pmod(F.xxhash64("chunk"), F.lit(1 << 30)) / float(1 << 30)
    plan = rounds_of(ids)
    for k, (lo, hi, epochs) in enumerate(plan):
        most = UNIT_IDS if k else 4 * FIRST_IDS  # the shares are met by about, the first unit is to hold its round
        tasks = max(1, int((hi - lo) * ids) // most)
        rate, last = RATE * 0.1 ** (k / len(plan)), RATE * 0.1 ** ((k + 1) / len(plan))
        got = summed(rows.where((place >= lo) & (place < hi)).coalesce(tasks),
                     lambda streams: replicas(streams, model, most, epochs, rate, last), "f4")
        if got is None:
            continue
        values, weights = got[:-size - 1], got[-size - 1:]
        values[model.emb.size:] /= weights[-1]
        by_id = values[:model.emb.size].reshape(size, DIM)
        by_id /= np.maximum(weights[:-1], 1)[:, None]
        model.unpack(np.concatenate([np.where(weights[:-1, None] > 0, by_id, model.emb).ravel(), values[model.emb.size:]]))
    class_of, begins = model.class_of, model.begins
    uses = summed(counting, lambda streams: added_up(context_uses(s, class_of, begins) for s in streams), "i8")
    return model.finish(uses.reshape(-1, size).astype(np.float64))


def lm_scores(docs: DataFrame, held_out, train, path: str | None = None) -> DataFrame:
    """Scores of every row of ``docs``; ``held_out`` and ``train`` are expressions on doc_id.

    Null and empty texts consist of the end token alone. Repeated rows are scored each, and
    counted each when they are trained on. Without training documents every count is 0. An
    empty table gives an empty result. Counts, classes and the attention layer cover all
    training documents.
    """
    spark = docs.sparkSession
    path = path or tokenizer_path(MODEL)
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    size = sp.get_piece_size()
    begins = np.array([sp.id_to_piece(k).startswith("\u2581") for k in range(size)])
    buckets = max(16, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = texts(docs, held_out.alias("held_out"), train.alias("train"))
    chunks = stage(rows.mapInArrow(lambda batches: chunk_rows(batches, buckets, path), CHUNK_SCHEMA), "lm-chunks")
    model = trained(chunks, size, begins)
    counted = stage(chunks.where("bucket is not null").select("bucket", "chunk", "words", "idx", "n")
                    .repartition("bucket").sortWithinPartitions("bucket", "chunk")
                    .mapInArrow(count_rows, COUNT_SCHEMA), "lm-counted")
    sums = counted.agg(F.sum("total").alias("total"), F.sum("known").alias("known")).first()
    ends = docs.where(train).count()
    total, distinct = (sums["total"] or 0) + ends, (sums["known"] or 0) + (ends > 0)

    word_rows = counted.where("chunk is not null").select("chunk", F.lit(False).alias("is_doc"), "idx", "n")
    chunk_own = chunks.where("bucket is null").select(
        "chunk", F.col("sizes").isNull().alias("is_doc"), "idx", "sizes", "pieces", "doc_id", "held_out")
    return (chunk_own.unionByName(word_rows, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk", "is_doc")
            .mapInArrow(lambda batches: score_rows(batches, model, total, distinct, ends), RESULT_SCHEMA))


def op1_lm_scores(spark, sf_dir):
    return lm_scores(table(spark, sf_dir, "documents"), fold(7) == 2, ~fold(7).isin(2, -1))
