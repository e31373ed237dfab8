"""Document fingerprints by context-triggered piecewise hashing (operator 11).

A rolling hash of the last ``WINDOW`` bytes marks places wherever its low bits are all ones,
and chunks end at marks, so an edit moves only the chunk ends near it. The block size is the
smallest power of two of which the text has at most ``BLOCKS``. A chunk has at least half a
block (marks before that are passed over) and at most ``LONGEST`` blocks (then it ends
without a mark), which keeps texts that repeat themselves, whose marks are all or none, in
useful pieces. Every chunk gives a signature of two characters (12 bits of a polynomial hash
of its bytes), and the fingerprint holds the signatures at the block size and at twice that:

    <block size>:<signatures>:<signatures at twice the block size>

Two fingerprints are compared at a block size that both have (equal ones, or one twice the
other): likeness is 1 - edit distance / longer length, over chunk signatures. Without a
common block size it is 0. Texts of any length are read whole. All of a batch is hashed at once in numpy, and edit distances of all its
pairs run bit-parallel, one 64-bit word per pair.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, table, text_list, texts

WINDOW = 7
BLOCKS = 32
CHUNKS = 2 * BLOCKS  # at most, so that a signature's positions fit one machine word
LONGEST = 4
GROUP = 1 << 20  # bytes hashed at once (a longer text alone)
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)

ROLL = 0x9E3779B1
CHUNK = 0xBF58476D1CE4E5B9  # odd, so it has an inverse modulo 2 ** 64
CHUNK_INVERSE = pow(CHUNK, -1, 1 << 64)

SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, edge string, place int, text binary")


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


@functools.cache
def group_powers(base: int) -> np.ndarray:
    return powers(base, 2 * GROUP)


def powers_to(base: int, n: int) -> np.ndarray:
    return group_powers(base)[:n] if n <= 2 * GROUP else powers(base, n)


def rolling_hashes(weight: np.ndarray) -> np.ndarray:
    """The hash of the ``WINDOW`` (seven) numbers up to every place: sums of one, two, three
    and four of them are put together from each other."""

    def add(x, y, back):
        out = x.copy()
        out[back:] += y[:max(len(y) - back, 0)] * np.uint32(ROLL ** back & 0xFFFFFFFF)
        return out

    two = add(weight, weight, 1)
    h = add(add(two, two, 2), add(two, weight, 2), 4)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    return h


def chunk_codes(starts: np.ndarray, ends: np.ndarray, weighted: np.ndarray) -> np.ndarray:
    """12 bits of the polynomial hash of every chunk; what lies between chunks weighs nothing."""
    total = np.add.reduceat(weighted, starts) * powers_to(CHUNK_INVERSE, len(weighted))[starts]
    total += (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    total = (total ^ (total >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return ((total ^ (total >> np.uint64(29))) >> np.uint64(52)).astype(np.int64)


def signature_text(codes: np.ndarray) -> str:
    return np.stack([ALPHABET[codes >> 6], ALPHABET[codes & 63]], axis=1).tobytes().decode("ascii")


def chunk_ends(marks: list[int], start: int, end: int, least: int, most: int) -> list[int]:
    """Ends of the chunks of ``start`` to ``end``: marks at least ``least`` after the chunk's
    start, or else ``most`` after it."""
    out, at = [], start
    for m in marks:
        while m - at > most:
            at += most
            out.append(at)
        if m - at >= least:
            at = m
            out.append(at)
    while end - at > most:
        at += most
        out.append(at)
    if at < end:
        out.append(end)
    return out


def group_fingerprints(raw: list[bytes]) -> list[str]:
    """Fingerprints of non-empty texts that are hashed together, with room between them so
    that no window reaches into the text before."""
    gap = WINDOW - 1
    data = np.frombuffer(bytes(gap).join(raw), np.uint8)
    lengths = np.array([len(x) for x in raw])
    starts = np.r_[0, np.cumsum(lengths + gap)[:-1]]
    weight = data.astype(np.uint32) + np.uint32(1)
    for k in range(gap):
        weight[(starts[1:] - 1 - k)] = 0
    rolled = rolling_hashes(weight)
    weighted = weight * powers_to(CHUNK, len(weight))
    size = [max(0, (-(-n // BLOCKS) - 1).bit_length()) for n in lengths.tolist()]  # its power of two
    room = np.r_[lengths[:-1] + gap, lengths[-1:]]
    edges = list(zip(starts.tolist(), (starts + lengths).tolist()))
    parts = []
    for more in (0, 1):
        # a mark for every half a block
        low = np.array([(1 << min(max(k + more - 1, 0), 31)) - 1 for k in size], np.uint32)
        low = np.repeat(low, room)
        marks = np.flatnonzero((rolled & low) == low) + 1
        first, last = (np.searchsorted(marks, x, side="right").tolist() for x in (starts, starts + lengths))
        marks = marks.tolist()
        begins, ends, counts = [], [], [0]
        for k, (a, b) in enumerate(edges):
            block = 1 << (size[k] + more)
            own = chunk_ends(marks[first[k]:last[k]], a, b, max(block // 2, 1), LONGEST * block)
            begins.append(a)
            begins += own[:-1]
            ends += own
            counts.append(len(ends))
        codes = chunk_codes(np.array(begins), np.array(ends), weighted)
        parts.append([signature_text(codes[a:b]) for a, b in zip(counts, counts[1:])])
    return [f"{1 << k}:{a}:{b}" for k, a, b in zip(size, *parts)]


def fingerprints_of(raw: list[bytes]) -> list[str]:
    """The fingerprint of every text; that of an empty one has no chunk."""
    out = ["1::"] * len(raw)
    held, used = [], 0

    def flush():
        for k, f in zip(held, group_fingerprints([raw[k] for k in held])):
            out[k] = f

    for k, x in enumerate(raw):
        if held and used + len(x) > GROUP:
            flush()
            held, used = [], 0
        if x:
            held.append(k)
            used += len(x)
    if held:
        flush()
    return out


# --- comparison --------------------------------------------------------------------


def signature(text: str) -> np.ndarray:
    """Chunk signatures as numbers, one per two characters."""
    return np.frombuffer(text.encode("ascii"), ">u2").astype(np.int64)


def comparable(a: str, b: str) -> tuple[str, str] | None:
    """The signatures of two fingerprints at a block size of both, the smaller one if two are."""
    (size1, *sig1), (size2, *sig2) = a.split(":"), b.split(":")
    if size1 == size2:
        return sig1[0], sig2[0]
    if int(size1) * 2 == int(size2):
        return sig1[1], sig2[0]
    if int(size2) * 2 == int(size1):
        return sig1[0], sig2[1]
    return None


def edit_distances(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """Edit distances (insertion, deletion and substitution cost 1) of pairs of sequences of
    at most ``CHUNKS`` numbers. The columns of all pairs' tables advance together, each held
    as vertical differences in the bits of one word."""
    one, zero = np.uint64(1), np.uint64(0)
    m, n = (np.array([len(s) for s in side], np.int64) for side in (first, second))
    a, b = (np.full((len(side), CHUNKS), fill, np.int64) for side, fill in ((first, -1), (second, -2)))
    for block, side in ((a, first), (b, second)):
        for k, s in enumerate(side):
            block[k, :len(s)] = s
    up = np.full(len(first), ~zero, np.uint64)
    down = np.zeros(len(first), np.uint64)
    last = one << (np.maximum(m, 1) - 1).astype(np.uint64)
    bit = one << np.arange(CHUNKS, dtype=np.uint64)
    distance = m.copy()
    for j in range(int(n.max(initial=0))):
        same = ((a == b[:, j:j + 1]) * bit).sum(axis=1, dtype=np.uint64)
        diagonal = (((same & up) + up) ^ up) | same | down
        right, left = down | ~(diagonal | up), up & diagonal
        live = j < n
        distance += live & ((right & last) > 0)
        distance -= live & ((left & last) > 0)
        right, left = (right << one) | one, left << one
        up, down = left | ~(diagonal | right), right & diagonal
    return np.where(m == 0, n, distance)


def likeness_of(pairs: list[tuple[str, str]]) -> list[float]:
    """Likeness (0 to 1) of every pair of fingerprints; equal ones are 1."""
    out = [1.0 if a == b else 0.0 for a, b in pairs]
    todo = [(k, c) for k, (a, b) in enumerate(pairs) if a != b and (c := comparable(a, b)) is not None]
    for lo in range(0, len(todo), 1024):
        part = todo[lo:lo + 1024]
        first, second = ([signature(c[side]) for _, c in part] for side in (0, 1))
        longer = [max(len(x), len(y)) for x, y in zip(first, second)]
        for (k, _), d, most in zip(part, edit_distances(first, second).tolist(), longer):
            out[k] = 1.0 - d / most if most else 1.0
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row of ``docs`` (doc_id, text), in one pass; a null text
    is an empty one."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fingerprints_of(text_list(b.column("text"))), pa.string())],
                                             names=["doc_id", "fingerprint"])

    return texts(docs).mapInArrow(run, "doc_id long, fingerprint string")


def with_likeness(pairs: DataFrame, first: str, second: str, name: str = "likeness") -> DataFrame:
    """``pairs`` with the likeness of two fingerprint columns (null where either is null)."""

    def run(batches):
        for b in batches:
            both = list(zip(b.column(first).to_pylist(), b.column(second).to_pylist()))
            known = [p for p in both if None not in p]
            got = iter(likeness_of(known))
            like = [next(got) if None not in p else None for p in both]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(like, pa.float64())], names=[*b.schema.names, name])

    return pairs.mapInArrow(run, pairs.select("*", F.lit(None).cast("double").alias(name)).schema)


# --- texts and their edited neighbours ------------------------------------------------


def edited(own: str, following: str) -> str:
    """``own`` with its last third replaced by as much of the start of ``following``."""
    k = len(own) // 3
    return own[:len(own) - k] + following[:k]


def edit_rows(ids: list, raw: list[bytes], prints: list[str]) -> pa.RecordBatch:
    """Results of all texts but the last, each with the text after it."""
    own = [x.decode("utf-8", "replace") for x in raw]
    changed = [edited(a, b).encode("utf-8") for a, b in zip(own, own[1:])]
    changed_prints = fingerprints_of(changed)
    n = len(changed)
    near = likeness_of([*zip(prints, changed_prints), *zip(prints, prints[1:])])
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[:n], pa.int64()), pa.array([len(x) for x in own[:n]], pa.int64()),
         pa.array([hashlib.sha256(x).hexdigest() for x in changed], pa.string()), pa.array(prints[:n], pa.string()),
         pa.array(changed_prints, pa.string()), pa.array(near[:n], pa.float64()), pa.array(near[n:], pa.float64()),
         pa.nulls(n, pa.string()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=NAMES)


NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def ordered_rows(batches):
    """Results of a partition's rows in order, then its first and last text: what comes after
    the last one lies in another partition."""
    from pyspark import TaskContext

    def edge(kind, doc_id, raw, fingerprint):
        row = [[doc_id], [None], [None], [fingerprint], [None], [None], [None], [kind], [TaskContext.get().partitionId()], [raw]]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, pa.string(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, kinds)], names=NAMES)

    before = None
    for b in batches:
        ids, raw = b.column("doc_id").to_pylist(), text_list(b.column("text"))
        if not ids:
            continue
        prints = fingerprints_of(raw)
        if before is None:
            yield edge("first", ids[0], raw[0], prints[0])
        else:
            ids, raw, prints = [before[0], *ids], [before[1], *raw], [before[2], *prints]
        if len(ids) > 1:
            yield edit_rows(ids, raw, prints)
        before = ids[-1], raw[-1], prints[-1]
    if before is not None:
        yield edge("last", *before)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    of every row of ``docs`` (doc_id, text).

    The document after another is the one with the next smaller id, after the last the first;
    rows that repeat an id follow each other in the order of their texts' hash, rows without
    one come last. A null text is empty; a single row is its own neighbour. n_chars counts
    code points, and bytes that are no UTF-8 count as replacement characters. An empty table
    gives an empty result; other columns are not read.

    One range shuffle brings neighbours together (a repeated id is split, too, since the hash
    is part of the order); each partition then streams over its rows and hands on its first
    and last text, two rows per partition, which are paired up afterwards.
    """
    spark = docs.sparkSession
    order = [F.desc_nulls_last("doc_id"), F.xxhash64("text"), F.col("text")]
    dealt = texts(docs).repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    done = stage(dealt.mapInArrow(ordered_rows, SCHEMA), "fingerprints")

    edges = done.where("edge is not null")
    used = sorted(r["place"] for r in edges.where("edge = 'first'").select("place").collect())  # one number a partition
    after = spark.createDataFrame(list(zip(used, used[1:] + used[:1])), "place int, after int")
    heads = edges.where("edge = 'first'").select(F.col("place").alias("after"), F.col("text").alias("next_text"))
    tails = edges.where("edge = 'last'").join(after, "place").join(heads, "after").select("doc_id", "text", "next_text")

    def close(batches):
        for b in batches:
            for doc_id, raw, following in zip(b.column("doc_id").to_pylist(), text_list(b.column("text")), text_list(b.column("next_text"))):
                yield edit_rows([doc_id, None], [raw, following], fingerprints_of([raw, following]))

    columns = NAMES[:-3]
    return done.where("edge is null").select(columns).unionByName(tails.mapInArrow(close, SCHEMA).select(columns))


def op11_fingerprints(spark, sf_dir):
    return edited_fingerprints(table(spark, sf_dir, "documents"))
