"""Order-preserving packing of documents into training sequences (operator 8).

Documents are taken in stored order. Their token ids form a stream in which a window may be
cut at a document's end (free), at a sentence's end (a small penalty) or, inside a stretch
without either, at fixed distances (a large one). Dynamic programming picks the cuts with
the least padding plus penalties. The best start for a window that ends at p is the least
``cost + position`` among cuts not further back than the window: a monotone queue keeps
these, so a cut costs constant time. Windows whose length is a power of two need no padding
and are further transitions.

Each task packs its own rows, block by block; the last windows of a block stay open and are
packed again with the next one. Nothing is shuffled, a task holds one block, and the only
loss against one global run is a shorter last window per task.
"""

from __future__ import annotations

import re
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import decode, table, text_list, texts, tokenizer_path

MODEL = "word_bpe_49k.json"
LENGTH = 4096
END_ID = 2  # follows every document
SENTENCE, FORCED, EACH = 16, 256, 512  # penalties in tokens of padding; EACH is per window
BLOCK_WINDOWS = 64  # windows of tokens gathered before a block is packed
MEMO = 300_000  # remembered strings per task, then the table starts again

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class WordEncoder:
    """Ids as the library gives them. Its pre-tokens never span white space, so for texts of
    plain Latin characters each stretch between white space is encoded once and remembered;
    the library's own BPE merges each new pre-token. Other texts (where its normaliser could
    change more than the case) and texts with its special strings go through it whole."""

    # no control characters, no Unicode spaces, no letter that lower case lengthens
    PLAIN = "[\\t-\\r -~¡-įı-ňŊ-ſ]*"
    NUMBER = "0-9²³¹¼½¾"
    PRETOKEN = ("'s|'t|'re|'ve|'m|'ll|'d|[^\\W\\d_²³¹¼½¾]+|[" + NUMBER + "]|(?:[^\\w\\s]|_)+")

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = re.compile(self.PLAIN).fullmatch
        self.find = re.compile(self.PRETOKEN).findall
        # byte-level alphabet: printable bytes stand for themselves, the rest from 256 on
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(own)]
        self.byte_chars = {**{b: chr(b) for b in own}, **{b: chr(256 + k) for k, b in enumerate(rest)}}
        self.chunks: dict[str, bytes] = {}
        self.pretokens: dict[str, bytes] = {}

    def merge(self, pretoken: str) -> bytes:
        got = self.pretokens.get(pretoken)
        if got is None:
            tokens = self.model.tokenize(pretoken.encode().decode("latin-1").translate(self.byte_chars))
            got = self.pretokens[pretoken] = np.array([t.id for t in tokens], "<u4").tobytes()
        return got

    def encode(self, batch: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self.chunks) > MEMO:
            self.chunks = {}
        if len(self.pretokens) > MEMO:
            self.pretokens = {}
        chunks, out = self.chunks, [b""] * len(batch)
        plain = [self.plain(t) is not None and not any(s in t for s in self.special) for t in batch]
        split = [t.lower().split() if p else [] for t, p in zip(batch, plain)]
        for c in set().union(*split).difference(chunks):
            chunks[c] = b"".join(map(self.merge, self.find(c)))
        for k, p in enumerate(plain):
            if p:
                out[k] = b"".join(map(chunks.__getitem__, split[k]))
            else:
                ids = self.tokenizer.encode(batch[k], add_special_tokens=False).ids
                out[k] = np.array(ids, "<u4").tobytes()
        return out

    def sentence_ends(self) -> np.ndarray:
        """Which ids end a sentence: word-final tokens whose last character is . ! or ?"""
        vocab = self.tokenizer.get_vocab()
        table = np.zeros(max(vocab.values()) + 1, bool)
        for s, i in vocab.items():
            table[i] = s.endswith((".</w>", "!</w>", "?</w>"))
        return table


def cut_points(ends: np.ndarray, sentences: np.ndarray, length: int) -> tuple[list[int], list[int]]:
    """Candidate cuts (ascending, the last is the stream's end) and their penalties."""
    pos = np.union1d(ends, sentences)
    pen = np.where(np.isin(pos, ends), 0, SENTENCE)
    gaps = np.flatnonzero(np.diff(np.concatenate([[0], pos])) > length)
    if len(gaps):
        step = max(1, length // 8)
        low = np.concatenate([[0], pos])
        more = np.concatenate([np.arange(low[g] + step, pos[g], step) for g in gaps])
        order = np.argsort(np.concatenate([pos, more]), kind="stable")
        pos, pen = np.concatenate([pos, more])[order], np.concatenate([pen, np.full(len(more), FORCED)])[order]
    return pos.tolist(), pen.tolist()


def choose_windows(pos: list[int], pen: list[int], length: int) -> list[int]:
    """Window ends with the least total of padding, penalties and ``EACH`` per window."""
    at = [0, *pos]
    index = {p: k for k, p in enumerate(at)}
    powers = [1 << k for k in range(4, length.bit_length()) if 1 << k < length]
    cost, back, value = [0] * len(at), [0] * len(at), [0] * len(at)
    queue = deque([0])
    for j in range(1, len(at)):
        p = at[j]
        while at[queue[0]] < p - length:
            queue.popleft()
        best, frm = value[queue[0]] + length - p, queue[0]
        for s in powers:
            i = index.get(p - s)
            if i is not None and cost[i] < best:
                best, frm = cost[i], i
        cost[j], back[j] = best + pen[j - 1] + EACH, frm
        value[j] = cost[j] + p
        while queue and value[queue[-1]] >= value[j]:
            queue.pop()
        queue.append(j)
    out, j = [], len(at) - 1
    while j:
        out.append(at[j])
        j = back[j]
    return out[::-1]


class Packer:
    """Streams documents in, pieces out. ``docs`` holds (doc_id, ids, start, doc_tokens) of
    what is not yet packed; ids are a document's remaining ones."""

    def __init__(self, is_end: np.ndarray, first_sequence: int, length: int, with_ids: bool = False):
        self.is_end, self.sequence, self.length, self.with_ids = is_end, first_sequence, length, with_ids
        self.docs: list[tuple] = []
        self.held = 0

    def add(self, doc_id, ids: np.ndarray):
        self.docs.append((doc_id, ids, 0, len(ids)))
        self.held += len(ids)
        return self.pack(False) if self.held >= BLOCK_WINDOWS * self.length else []

    def pack(self, final: bool) -> list[tuple]:
        if not self.docs:
            return []
        ends = np.cumsum([len(d[1]) for d in self.docs])
        stream = np.concatenate([d[1] for d in self.docs])
        known = np.minimum(stream, len(self.is_end) - 1)
        cuts = choose_windows(*cut_points(ends, np.flatnonzero(self.is_end[known]) + 1, self.length), self.length)
        if not final:
            cuts = cuts[:-2]
        out, low, d = [], 0, 0
        starts = ends - [len(x[1]) for x in self.docs]
        for cut in cuts:
            offset = 0
            while offset < cut - low:
                doc_id, ids, start, total = self.docs[d]
                a = low + offset - int(starts[d])
                b = min(len(ids), cut - int(starts[d]))
                piece = ids[a:b]
                out.append((doc_id, start + a, b - a, zlib.crc32(piece.tobytes()), total, self.sequence, offset,
                            *([piece.tolist()] if self.with_ids else [])))
                offset += b - a
                if b == len(ids):
                    d += 1
            low = cut
            self.sequence += 1
        rest = self.docs[d:]
        if rest and low > starts[d]:
            doc_id, ids, start, total = rest[0]
            used = low - int(starts[d])
            rest[0] = (doc_id, ids[used:], start + used, total)
        self.docs, self.held = rest, sum(len(x[1]) for x in rest)
        return out


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: doc_id, start (ids of its document before it),
    length, ids_crc32, doc_tokens, sequence_id and offset in the sequence; with ``with_ids``
    the ids themselves too.

    Every row of ``docs`` is packed, null and empty texts as their end id alone; repeated
    rows and null ids are documents of their own; an empty table gives no pieces. A
    document may be longer than a window by any factor. Sequence ids are a task's number
    and its count of windows: unique, and the same when a lost task runs again.
    """
    path = path or tokenizer_path(MODEL)
    kinds = [pa.int64()] * 7 + ([pa.list_(pa.int64())] if with_ids else [])
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def run(batches):
        encoder = WordEncoder(path)
        packer = Packer(encoder.sentence_ends(), TaskContext.get().partitionId() << 36, length, with_ids)

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        last = np.array([end_id], "<u4").tobytes()
        for b in batches:
            ids, raw = b.column("doc_id").to_pylist(), text_list(b.column("text"))
            rows = []
            for lo in range(0, len(raw), 128):
                for doc_id, x in zip(ids[lo:lo + 128], encoder.encode([decode(t) for t in raw[lo:lo + 128]])):
                    rows += packer.add(doc_id, np.frombuffer(x + last, "<u4"))
            if rows:
                yield batch(rows)
        if rows := packer.pack(True):
            yield batch(rows)

    return texts(docs).mapInArrow(run, SCHEMA + (", ids array<long>" if with_ids else ""))


def op8_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))
