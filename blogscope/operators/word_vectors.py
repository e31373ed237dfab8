"""Word2Vec (skip-gram with hierarchical softmax) whose tables no process holds whole (M5).

The vocabulary is a DataFrame. Words are ranked by count; a canonical Huffman code follows from the
rank and a few numbers a code length, and these from how many words have each count, which is what
the driver knows. An inner node is named by the bits that lead to it, so there is no tree.

Segments are cut into blocks of bounded size. A block knows its own words and trains vectors of
these and of the nodes on their paths, in small batches; a pass ends with the mean of each vector over
the blocks that hold it, as in pyspark.ml's Word2Vec with several partitions. Vectors travel
packed, by buckets of their ids. They begin with numbers that follow from rank and seed.
"""

from __future__ import annotations

import heapq
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .arrow_groups import column, one_list, slices, whole_groups

BLOCK_TOKENS = 1 << 19
WINDOW, RATE, MAX_EXP, SENTENCE = 5, 0.025, 6.0, 1000  # as in pyspark.ml
BATCH = 256  # tokens whose contexts are learned at once
REPEATS = 32  # a vector that a batch uses more often moves by so many times its mean gradient
TOP, GROUPS = 7, 4  # levels of the code whose nodes a batch shares; parts of a batch by the length of the code
BUCKET_IDS = 1 << 16  # ids of a bucket, about
PARTS = "bucket long, block long, ids binary, vecs binary"


def code_lengths(counts: dict[int, int]) -> list[tuple[int, int]]:
    """(length, words) of a Huffman code, shortest first, of as many words as ``counts`` gives
    for each count. Equal weights are merged together, so the work follows the distinct counts."""
    heap = [(c, k, n) for k, (c, n) in enumerate(sorted(counts.items()))]
    leaves, nodes = len(heap), []
    while len(heap) > 1 or heap and heap[0][2] > 1:
        w, k, n = heapq.heappop(heap)
        if n > 1:
            nodes.append((k, k))
            heapq.heappush(heap, (2 * w, leaves + len(nodes) - 1, n // 2))
            if n % 2:
                heapq.heappush(heap, (w, k, 1))
        else:
            v, j, m = heapq.heappop(heap)
            if m > 1:
                heapq.heappush(heap, (v, j, m - 1))
            nodes.append((k, j))
            heapq.heappush(heap, (w + v, leaves + len(nodes) - 1, 1))
    at = [Counter() for _ in range(leaves + len(nodes))]
    if heap:
        at[heap[0][1]][0] = 1
    for k in range(leaves + len(nodes) - 1, leaves - 1, -1):
        for child in nodes[k - leaves]:
            for depth, n in at[k].items():
                at[child][depth + 1] += n
    return sorted(sum(at[:leaves], Counter()).items())


def paths(ranks: np.ndarray, lengths: list[tuple[int, int]]):
    """(nodes, bits, on) of words by rank, a row each: the node at every depth, the way that is
    taken there, and whether the path goes on so far."""
    size, many = (np.array(x, np.int64) for x in zip(*lengths))
    first_rank = np.cumsum(many) - many
    first_code, code = [], 0
    for k, (length, n) in enumerate(lengths):
        code <<= length - (lengths[k - 1][0] if k else 0)
        first_code.append(code)
        code += n
    own = np.searchsorted(first_rank, ranks, side="right") - 1
    code, length = np.array(first_code, np.int64)[own] + ranks - first_rank[own], size[own]
    depth = np.arange(length.max(initial=0))[None]
    on = depth < length[:, None]
    left = np.where(on, length[:, None] - depth, 1)
    return np.where(on, (1 << depth) | code[:, None] >> left, 0), (code[:, None] >> left - 1) & 1, on


def start_vectors(ranks: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Uniform numbers of -0.5 / size to 0.5 / size by rank."""
    x = ranks.astype(np.uint64)[:, None] * np.uint64(size) + np.arange(size, dtype=np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(odd)
    return (((x >> np.uint64(40)).astype(np.float64) / (1 << 24) - 0.5) / size).astype(np.float32)


def add_rows(table: np.ndarray, ids: np.ndarray, moves: np.ndarray, uses: np.ndarray | None = None) -> None:
    """Add ``moves`` to the rows ``ids`` of a table, less where an id is used often; ``uses`` of every move, one by default."""
    order = np.argsort(ids, kind="stable")
    at = ids[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    n = np.diff(np.r_[first, len(at)])
    often = n > 1
    table[at[first[~often]]] += moves[order[first[~often]]] if uses is None else moves[order[first[~often]]] / _times(uses[order[first[~often]]])
    if often.any():
        rows, n = np.repeat(often, n), n[often]
        order, starts = order[rows], np.cumsum(n) - n
        sums, place, step = moves[order], np.arange(len(order)) - np.repeat(starts, n), 1
        left = np.repeat(n, n) - place
        while step < n.max():  # halves of halves, since reduceat is slow along rows
            at_step = np.flatnonzero((place % (2 * step) == 0) & (left > step))
            sums[at_step] += sums[at_step + step]
            step *= 2
        table[at[first[often]]] += sums[starts] / _times(n if uses is None else np.add.reduceat(uses[order], starts))


def _times(n: np.ndarray) -> np.ndarray:
    return np.maximum(1, n / REPEATS).astype(np.float32)[:, None]


def train(words: np.ndarray, inner: np.ndarray, tokens: np.ndarray, sentence: np.ndarray, path, bits, on, rng, rates) -> None:
    """One pass over a block. ``path`` names rows of ``inner``, which are in order of depth; ``rates`` are the
    first and last learning rate. Nodes of the first ``TOP`` levels, which most tokens share, meet all tokens of a
    batch in whole matrices; deeper ones meet their own token's context, tokens with paths of like length together."""
    off, width = np.arange(-WINDOW, WINDOW + 1), 2 * WINDOW + 1
    length, goal = on.sum(axis=1), (1 - bits).astype(np.float32)
    top = min(TOP, path.shape[1])
    high = int(path[:, :top].max(initial=-1)) + 1
    for lo in range(0, len(tokens), BATCH):
        p = np.arange(lo, min(lo + BATCH, len(tokens)))
        at = p[:, None] + off
        inside = np.clip(at, 0, len(tokens) - 1)
        reach = rng.integers(1, WINDOW + 1, len(p))[:, None]
        near = (at == inside) & (sentence[inside] == sentence[p][:, None]) & (np.abs(off) <= reach) & (off != 0)
        t, size = tokens[p], len(p)
        if not near.any() or not length[t].max():
            continue
        rate = np.float32(rates[0] + (rates[1] - rates[0]) * lo / len(tokens))

        def gradient(f, goal, here, near):
            on = np.abs(f) < MAX_EXP
            on &= near[:, :, None]
            on &= here[:, None]
            g = np.clip(f, -MAX_EXP, MAX_EXP)
            np.exp(np.negative(g, out=g), out=g)
            g += 1
            np.subtract(goal[:, None], np.reciprocal(g, out=g), out=g)
            g *= on
            g *= rate
            return g

        ids = tokens[np.clip(np.arange(lo - WINDOW, lo + size + WINDOW), 0, len(tokens) - 1)]
        near_ids = words[ids]
        x = np.lib.stride_tricks.sliding_window_view(near_ids, width, axis=0).transpose(0, 2, 1)
        nodes, way, here = inner[:high], path[t, :top], on[t, :top]
        cell = (np.arange(size)[:, None, None] + np.arange(width)[:, None]) * high + way[:, None]
        g = gradient((near_ids @ nodes.T).ravel()[cell], goal[t, :top], here, near)
        total = np.bincount(cell.ravel(), g.ravel(), len(ids) * high).astype(np.float32).reshape(len(ids), high)
        back, nodes_move = total @ nodes, total.T @ near_ids
        deep_ids, deep_moves, deep_back = [], [], np.zeros((size, width, words.shape[1]), np.float32)
        order = np.argsort(length[t], kind="stable")
        for own in np.array_split(order[length[t[order]] > top], GROUPS):
            if not len(own):
                continue
            level = slice(top, int(length[t[own[-1]]]))
            way, here, context = path[t[own], level], on[t[own], level], x[own]
            below = inner[way]
            g = gradient(context @ below.transpose(0, 2, 1), goal[t[own], level], here, near[own])
            deep_back[own] = g @ below
            deep_ids.append(way[here])
            deep_moves.append((g.transpose(0, 2, 1) @ context)[here])
        uses = np.zeros(len(ids))
        for j in range(width):
            back[j:j + size] += deep_back[:, j]
            uses[j:j + size] += near[:, j]
        inner[:high] += nodes_move / _times(np.bincount(path[t, :top][on[t, :top]], minlength=high))
        if deep_ids:
            add_rows(inner, np.concatenate(deep_ids), np.concatenate(deep_moves))
        add_rows(words, ids, back, uses)


# --- blocks ----------------------------------------------------------------------------


def cut_rows(batches):
    """A row per block: the words, the tokens as their numbers, the sizes of the segments."""
    number = TaskContext.get().partitionId() << 32
    held, used = [], 0

    def close():
        coded = pa.concat_arrays([h.flatten() for h in held]).dictionary_encode()
        sizes = np.concatenate([np.diff(h.offsets.to_numpy()) for h in held]).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), one_list(coded.dictionary), pa.array([coded.indices.to_numpy().tobytes()]),
                                           pa.array([sizes.tobytes()])], names=["block", "words", "tokens", "sizes"])

    for b in batches:
        for lo in range(0, b.num_rows, 256):
            part = b.column(0).slice(lo, 256)
            held.append(part)
            used += len(part.flatten())
            if used >= BLOCK_TOKENS:
                yield close()
                number, held, used = number + 1, [], 0
    if used:
        yield close()


def trained_rows(batches, lengths, size, seed, turn, turns, buckets):
    """What every block makes of its vectors (``PARTS``); ids of words are even, of nodes odd."""
    for table in whole_groups(batches, ["block"], lambda b: b.num_rows, 1):
        for t in slices(table, ["block"]):
            number = column(t, "block")[0].as_py()
            body = t.filter(column(t, "tokens").is_valid())
            if not body.num_rows:
                continue
            found = t.filter(column(t, "rank").is_valid())
            tokens, sizes = (np.frombuffer(column(body, c)[0].as_py(), np.int32) for c in ("tokens", "sizes"))
            row = np.full(int(tokens.max()) + 1, -1)
            ranks = column(found, "rank").to_numpy().astype(np.int64)
            row[column(found, "pos").to_numpy()] = np.arange(len(ranks))
            segment = np.repeat(np.arange(len(sizes)), sizes)
            tokens, segment = row[tokens], segment[row[tokens] >= 0]
            tokens = tokens[tokens >= 0]
            if not len(tokens):
                continue
            start = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
            place = np.arange(len(segment)) - np.repeat(start, np.diff(np.r_[start, len(segment)]))
            sentence = segment.astype(np.int64) * (len(segment) // SENTENCE + 1) + place // SENTENCE
            path, bits, on = paths(ranks, lengths)
            nodes, way = np.unique(path, return_inverse=True)
            words, inner = start_vectors(ranks, size, seed), np.zeros((len(nodes), size), np.float32)
            ids = np.concatenate([2 * ranks, 2 * nodes + 1])
            vecs = np.concatenate([words, inner])
            for r in t.filter(column(t, "vecs").is_valid()).select(["ids", "vecs"]).to_pylist():
                sorter = np.argsort(ids)
                at = sorter[np.searchsorted(ids, np.frombuffer(r["ids"], np.int64), sorter=sorter)]
                vecs[at] = np.frombuffer(r["vecs"], np.float32).reshape(-1, size)
            words, inner = vecs[:len(ranks)], vecs[len(ranks):]
            rates = [RATE * max(1 - x / turns, 1e-4) for x in (turn, turn + 1)]
            train(words, inner, tokens, sentence, way.reshape(path.shape), bits, on, np.random.default_rng([seed, turn, number]), rates)
            if turn + 1 == turns:  # nobody reads the nodes any more
                ids, vecs = ids[:len(ranks)], vecs[:len(ranks)]
            home = (ids >> 1) % buckets
            order = np.argsort(home, kind="stable")
            used, ends = np.unique(home[order], return_index=True)
            cuts = np.r_[ends, len(ids)]
            for lo in range(0, len(used), 256):
                own = [order[a:b] for a, b in zip(cuts[lo:lo + 256], cuts[lo + 1:lo + 257])]
                yield pa.RecordBatch.from_arrays([pa.array(used[lo:lo + 256], pa.int64()), pa.array([number] * len(own), pa.int64()),
                                                  pa.array([ids[o].tobytes() for o in own]), pa.array([vecs[o].tobytes() for o in own])],
                                                 names=["bucket", "block", "ids", "vecs"])


def mean_rows(batches, size):
    """(bucket, ids, vecs): every id's mean vector. Only a bucket's sums are held."""
    def close(bucket, ids, sums, n):
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([ids.tobytes()]),
                                           pa.array([(sums / n[:, None]).astype(np.float32).tobytes()])], names=["bucket", "ids", "vecs"])

    bucket, ids, sums, n = None, None, None, None
    for b in batches:
        for at, own, vecs in zip(*(b.column(c).to_pylist() for c in ("bucket", "ids", "vecs"))):
            if at != bucket:
                if bucket is not None:
                    yield close(bucket, ids, sums, n)
                bucket, ids, sums, n = at, np.empty(0, np.int64), np.empty((0, size)), np.empty(0)
            own, vecs = np.frombuffer(own, np.int64), np.frombuffer(vecs, np.float32).reshape(-1, size)
            new = np.setdiff1d(own, ids)
            if len(new):
                ids = np.concatenate([ids, new])
                sums, n = np.concatenate([sums, np.zeros((len(new), size))]), np.concatenate([n, np.zeros(len(new))])
                order = np.argsort(ids)
                ids, sums, n = ids[order], sums[order], n[order]
            k = np.searchsorted(ids, own)  # a block sends an id once
            sums[k] += vecs
            n[k] += 1
    if bucket is not None:
        yield close(bucket, ids, sums, n)


def returned_rows(batches, size):
    """A bucket's mean vectors, which come first, for every block that sent some."""
    bucket, ids, vecs = None, None, None
    for b in batches:
        for r in b.to_pylist():
            if r["block"] is None:
                bucket, ids, vecs = r["bucket"], np.frombuffer(r["ids"], np.int64), np.frombuffer(r["vecs"], np.float32).reshape(-1, size)
                continue
            own = vecs[np.searchsorted(ids, np.frombuffer(r["ids"], np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([r["block"]], pa.int64()), pa.array([r["ids"]]),
                                              pa.array([own.tobytes()])], names=["bucket", "block", "ids", "vecs"])


def word_rows(batches, size):
    """(rank, vec) of the words of every bucket."""
    for b in batches:
        for own, vecs in zip(b.column("ids").to_pylist(), b.column("vecs").to_pylist()):
            own = np.frombuffer(own, np.int64)
            vecs = np.frombuffer(vecs, np.float32).reshape(-1, size)[own % 2 == 0].astype(np.float64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, vecs.size + 1, size), pa.int32()), pa.array(vecs.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(own[own % 2 == 0] >> 1), lists], names=["rank", "vec"])


def ranked(rows: DataFrame, min_count: int) -> DataFrame:
    """(word, cnt, rank) of the words of (tokens) that occur ``min_count`` times, by count."""
    counts = rows.select(F.explode("tokens").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") >= min_count)
    order = [F.col("cnt").desc(), F.col("word").asc()]
    done = materialize(counts.repartitionByRange(*order).sortWithinPartitions(*order)
                       .select("word", "cnt", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "word-counts")
    before, offsets = 0, []
    for r in sorted(done.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()):  # a row per task
        offsets.append((r["part"], before))
        before += r["n"]
    ends = done.sparkSession.createDataFrame(offsets, "part int, before long")
    return done.join(F.broadcast(ends), "part").select("word", "cnt", (F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("rank"))


def word_vectors(segments: DataFrame, tokens: str = "tokens", size: int = 64, min_count: int = 2,
                 seed: int = 42, max_iter: int = 1) -> DataFrame:
    """Word vectors trained on the corpus as a (word, vec) table, usable wherever a vector table is
    expected (S10/J3). One row per word that occurs ``min_count`` times."""
    spark = segments.sparkSession
    rows = segments.select(F.array_compact(tokens).alias("tokens")).where(F.size("tokens") > 0)
    vocab = materialize(ranked(rows, min_count), "word-ranks")
    per_count = {r["cnt"]: r["n"] for r in vocab.groupBy("cnt").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per distinct count
    if not per_count:
        return vocab.select("word", F.array().cast("array<double>").alias("vec"))
    lengths, many = code_lengths(per_count), sum(per_count.values())
    buckets = max(16, 2 * many // BUCKET_IDS)
    blocks = materialize(rows.mapInArrow(cut_rows, "block long, words array<string>, tokens binary, sizes binary"), "word-blocks")
    found = (blocks.select("block", F.posexplode("words").alias("pos", "word")).join(vocab.select("word", "rank"), "word")
             .select("block", "pos", "rank"))
    held = blocks.drop("words").unionByName(found, allowMissingColumns=True)
    parts, table = None, None
    for turn in range(max_iter):
        sent = spark.createDataFrame([], PARTS)
        if turn:
            met = table.unionByName(parts.drop("vecs"), allowMissingColumns=True)
            sent = met.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(lambda b: returned_rows(b, size), PARTS)
        met = held.unionByName(sent.drop("bucket"), allowMissingColumns=True)
        parts = met.repartition("block").sortWithinPartitions("block").mapInArrow(
            lambda b, turn=turn: trained_rows(b, lengths, size, seed, turn, max_iter, buckets), PARTS)
        if turn + 1 < max_iter:  # read twice
            parts = materialize(parts, f"word-parts-{turn}")
        table = materialize(parts.select("bucket", "ids", "vecs").repartition("bucket").sortWithinPartitions("bucket")
                            .mapInArrow(lambda b: mean_rows(b, size), "bucket long, ids binary, vecs binary"), f"word-means-{turn}")
    named = table.mapInArrow(lambda b: word_rows(b, size), "rank long, vec array<double>")
    return vocab.join(named, "rank").select("word", "vec")


# executors need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
