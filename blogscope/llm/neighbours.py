"""Approximate nearest neighbours by multiprobe p-stable hashing (operator 6).

Vectors of length one are hashed by ``TABLES`` tables of ``PROJECTIONS`` Gaussian projections,
cut into cells of ``WIDTH``. A query visits, in each table, its own cell and the cells that
differ by one step in some projections, in the order of their estimated success (least
sum of squared distances to the crossed cell walls). What any table yields is merged, gathered
and ranked by the exact cosine in double precision; other vectors are not multiplied.

The index is dealt over shards by a hash of the id, so that a crowded cell is shared out
evenly; each shard holds its own tables. Queries stream past every shard in blocks, and a
shard answers with its best few, so no pairs are ever written out. Queries for which all
shards together found too few are ranked again, against every vector.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, table

TABLES, PROJECTIONS, WIDTH, PROBES = 16, 5, 1.0, 100
SHARD_ROWS = 4_096  # aimed at, while that makes no more shards than shuffle partitions
SHARD_MOST = 1 << 19  # rows of a shard whatever the number of partitions
QUERY_BLOCK = 256
BLOCK_PAIRS = 1 << 22  # queries times rows of a shard looked up at a time
GATHERED = 1 << 15  # candidates whose vectors are gathered at a time

SCHEMA = "query_id long, vec_id long, score double"


class Hashes:
    """The tables' projections for one dimension, from a seed."""

    def __init__(self, dim: int, tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH,
                 probes: int = PROBES, seed: int = 29):
        rng = np.random.default_rng([seed, dim])
        self.tables, self.m, self.width = tables, projections, width
        self.a = rng.standard_normal((tables, dim, projections))
        self.b = rng.uniform(0, width, (tables, 1, projections))
        self.steps = np.array(list(itertools.product((-1, 0, 1), repeat=projections)), np.int64)
        self.probes = min(probes, len(self.steps))
        self.place = np.int64(2048) ** np.arange(projections, dtype=np.int64)

    def cells(self, x: np.ndarray, t: int) -> np.ndarray:
        """Projections in units of cells."""
        return (x @ self.a[t] + self.b[t]) / self.width

    def keys(self, x: np.ndarray, t: int) -> np.ndarray:
        return (np.floor(self.cells(x, t)).astype(np.int64) + 1024) @ self.place

    def probe_keys(self, x: np.ndarray, t: int) -> np.ndarray:
        """(queries, probes) cell keys, likeliest first."""
        h = self.cells(x, t)
        low = np.floor(h)
        down, up = (h - low) ** 2, (low + 1 - h) ** 2
        cost = down @ (self.steps == -1).T + up @ (self.steps == 1).T
        first = np.argsort(cost, axis=1, kind="stable")[:, :self.probes]
        return ((low.astype(np.int64) + 1024) @ self.place)[:, None] + (self.steps @ self.place)[first]


class Shard:
    """Hash tables over one shard's vectors of one dimension; without ``hashes`` every
    vector is a candidate."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, hashes: Hashes | None):
        self.ids, self.vectors, self.hashes = ids, vectors, hashes
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.products = 0  # vectors multiplied with a query so far
        self.tables = []  # per table: cell keys, where each cell begins, the vectors by cell
        for t in range(hashes.tables if hashes else 0):
            keys, cell = np.unique(hashes.keys(vectors / self.norms[:, None], t), return_inverse=True)
            edges = np.concatenate([[0], np.cumsum(np.bincount(cell, minlength=len(keys)))])
            self.tables.append((keys, edges, np.argsort(cell, kind="stable")))

    def candidates(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The (query, vector) pairs that any table yields, each once, by query."""
        rows = len(self.ids)
        marked = np.full(len(unit) * rows, self.hashes is None)
        for t, (keys, edges, order) in enumerate(self.tables):
            probe = self.hashes.probe_keys(unit, t)
            at = np.minimum(np.searchsorted(keys, probe), len(keys) - 1)
            query, col = np.nonzero(keys[at] == probe)
            cell = at[query, col]
            sizes = edges[cell + 1] - edges[cell]
            inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            marked[np.repeat(query, sizes) * rows + order[np.repeat(edges[cell], sizes) + inside]] = True
        return np.divmod(np.flatnonzero(marked), rows)

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """(query_id, vec_id, score) arrays of the best ``k`` candidates of each query, ties to
        the smaller id. Candidates' vectors are gathered and scored in blocks; no other vector
        is multiplied."""
        norms = np.sqrt((queries * queries).sum(axis=1))
        query, vector = self.candidates(queries / norms[:, None])
        other = query_ids[query] != self.ids[vector]
        query, vector = query[other], vector[other]
        self.products += len(query)
        score = np.empty(len(query))
        for lo in range(0, len(query), GATHERED):
            q, v = query[lo:lo + GATHERED], vector[lo:lo + GATHERED]
            score[lo:lo + GATHERED] = (self.vectors[v] * queries[q]).sum(axis=1) / (self.norms[v] * norms[q])
        order = np.lexsort((self.ids[vector], -score, query))
        first = np.searchsorted(query[order], np.arange(len(queries)))
        best = order[np.arange(len(order)) - first[query[order]] < k]
        return query_ids[query[best]], self.ids[vector[best]], score[best]


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) of rows that can take part: an id, and a vector that is not
    null, not empty, not zero and without null or non-finite components."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
            .where("vec_id is not null and v is not null").where(fine).where(F.exists("v", lambda x: x != 0)))


def matrix(column) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and lengths of an Arrow list column."""
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def shard_answers(batches, k: int, options: dict, exact: bool = False):
    """Rows of one or more shards, each with its index rows before its queries."""
    shard, held, built, families = None, [], None, {}

    def build():
        by_dim = {}
        for ids, values, sizes in held:
            ends = np.cumsum(sizes)
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                at = (ends[rows] - dim)[:, None] + np.arange(dim)
                by_dim.setdefault(int(dim), []).append((ids[rows], values[at]))
        out = {}
        for dim, parts in by_dim.items():
            families.setdefault(dim, None if exact else Hashes(dim, **options))
            out[dim] = Shard(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), families[dim])
        return out

    for b in batches:
        shards, kinds = b.column("shard").to_numpy(), b.column("is_query").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.r_[True, (np.diff(shards) != 0) | (kinds[1:] != kinds[:-1])]) if len(shards) else []
        for a, z in zip(edges, [*edges[1:], len(shards)]):
            if shards[a] != shard:
                shard, held, built = shards[a], [], None
            part = b.slice(a, z - a)
            ids = part.column("vec_id").to_numpy()
            values, sizes = matrix(part.column("v"))
            if not kinds[a]:
                held.append((ids, values, sizes))
                continue
            if built is None:
                built, held = build(), []
            ends = np.cumsum(sizes)
            for dim, index in built.items():
                rows = np.flatnonzero(sizes == dim)
                step = max(1, min(QUERY_BLOCK, BLOCK_PAIRS // len(index.ids)))
                for lo in range(0, len(rows), step):
                    own = rows[lo:lo + step]
                    at = (ends[own] - dim)[:, None] + np.arange(dim)
                    got = index.nearest(ids[own], values[at], k)
                    if len(got[0]):
                        yield pa.RecordBatch.from_arrays([pa.array(got[0], pa.int64()), pa.array(got[1], pa.int64()),
                                                          pa.array(got[2], pa.float64())], names=["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            **options) -> DataFrame:
    """The ``k`` nearest found of every query: query_id, rank (from 1), vec_id, score. Every
    query has ``k`` rows, or all its candidates: where the tables yield fewer, the query is
    ranked exactly.

    Only vectors of the query's own dimension and another id are its candidates. Rows that
    cannot take part (see ``usable``) are in no result; ties go to the smaller id; rows that
    repeat an id count once, so do equal vectors beyond the ``k + 1`` smallest ids, which no
    result can reach. ``options`` go to ``Hashes``.
    """
    spark = vectors.sparkSession
    index = usable(vectors, id_col, vec_col).dropDuplicates(["vec_id"])
    same = Window.partitionBy("v").orderBy("vec_id")
    index = index.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1).drop("n")
    n = vectors.count()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, min(-(-n // SHARD_ROWS), partitions), -(-n // SHARD_MOST))
    dealt = index.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"),
                         F.lit(False).alias("is_query"), "vec_id", "v")
    asked = usable(queries, id_col, vec_col).dropDuplicates(["vec_id"])
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def answers(asked: DataFrame, exact: bool) -> DataFrame:
        copies = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("is_query"), "vec_id", "v")
        found = (dealt.unionByName(copies).repartition(shards, "shard").sortWithinPartitions("shard", "is_query", "vec_id")
                 .mapInArrow(lambda batches: shard_answers(batches, k, options, exact), SCHEMA))
        return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
                .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))

    probed = stage(answers(asked, False), "neighbours-probed")
    full = probed.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = stage(asked.join(full, "vec_id", "left_anti"), "neighbours-short")
    if short.isEmpty():
        return probed
    ranked = probed.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").select(probed.columns)
    return ranked.unionByName(answers(short, True))


def op6_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))
