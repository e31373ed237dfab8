"""Importance resampling towards a target distribution (operator 12).

Documents are drawn without replacement, in proportion to how much likelier their hashed
word n-grams are in a target table than in the whole corpus. The steps:

1. Count the features of every bucket over the corpus and over the target. Each Arrow batch
   interns its n-grams in an open-addressed table, whose slots carry a feature's bucket and
   count, so a bucket is computed once per distinct n-gram; a task hands on one row per bucket.
2. Gains per bucket: scaled log ratios of the smoothed shares, ``buckets`` numbers.
3. Read the corpus again; the slot of every occurrence gathers its gain, documents sum them
   and add Gumbel noise from a hash of their id: the largest scores are the sample.
4. Rank: a range sort by score, whose partitions' sizes give every row its rank, so no task
   or driver sees more than a partition.
"""

from __future__ import annotations

import hashlib
import math
import operator
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, table, text_list, texts, words

BUCKETS, MAX_N = 10_000, 1
LEAST_WORDS, PERCENT = 20, 10
SEED = 2024

COUNT_SCHEMA = "bucket int, n long"
SCORE_SCHEMA = "doc_id long, n_words long, n_features long, weight long, score long"


class InternTable:
    """Distinct byte strings in an open-addressed table: linear probing from a xxhash64 key.
    A place belongs to a string only if key and bytes agree, so two strings with one key get
    a slot each. ``owner`` holds the first occurrence of every slot's string."""

    def __init__(self, items: list[bytes], keys: np.ndarray | None = None):
        import xxhash
        self.items = items
        if keys is None:
            keys = np.fromiter(map(xxhash.xxh64_intdigest, items), np.uint64, len(items))
        size = 1 << max(3, (2 * len(items)).bit_length())  # at most half full
        self.owner = np.full(size, -1, np.int64)
        self.slot = np.empty(len(items), np.int64)
        place = (keys & np.uint64(size - 1)).astype(np.int64)
        todo = np.arange(len(items))
        while len(todo):
            at = place[todo]
            free = self.owner[at] < 0
            self.owner[at[free][::-1]] = todo[free][::-1]  # the first occurrence wins
            own = self.owner[at]
            mine = keys[own] == keys[todo]
            check = np.flatnonzero(mine & (own != todo))
            mine[check] = np.fromiter(map(operator.eq, map(items.__getitem__, own[check]), map(items.__getitem__, todo[check])),
                                      bool, len(check))
            self.slot[todo[mine]] = at[mine]
            todo = todo[~mine]
            place[todo] = (place[todo] + 1) & (size - 1)
        self.used = np.flatnonzero(self.owner >= 0)

    def buckets(self, buckets: int) -> np.ndarray:
        """The bucket of every slot (crc32 of its string), -1 where nothing is."""
        out = np.full(len(self.owner), -1, np.int64)
        out[self.used] = [zlib.crc32(self.items[k]) % buckets for k in self.owner[self.used].tolist()]
        return out

    def counts(self) -> np.ndarray:
        """Occurrences of every slot's string."""
        return np.bincount(self.slot, minlength=len(self.owner))


def features(raw: bytes, max_n: int) -> tuple[int, list[bytes]]:
    """Words of a text, and all its runs of 1 to ``max_n`` words."""
    w = words(raw)
    out = list(w)
    for n in range(2, max_n + 1):
        out += map(b" ".join, zip(*(w[k:] for k in range(n))))
    return len(w), out


def interned(raw: list[bytes], max_n: int):
    """Features of texts as a table, with the number of words and features of every text."""
    n_words, n_features, items = [], [], []
    for x in raw:
        n, own = features(x, max_n)
        n_words.append(n)
        n_features.append(len(own))
        items += own
    return InternTable(items), np.array(n_words, np.int64), np.array(n_features, np.int64)


def text_groups(raw: list[bytes], size: int = 1 << 21):
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


def bucket_counts(docs: DataFrame, buckets: int, max_n: int) -> np.ndarray:
    """Features of ``docs`` in every bucket; tasks add up their own first."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for part in text_groups(text_list(b.column("text"))):
                t, _, _ = interned(part, max_n)
                total += np.bincount(t.buckets(buckets)[t.used], t.counts()[t.used], buckets).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    got = (texts(docs.where("text is not null")).mapInArrow(run, COUNT_SCHEMA)
           .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())  # ``buckets`` rows at most
    out = np.zeros(buckets, np.int64)
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of smoothed shares) of every bucket."""
    total, wanted, k = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1) * (total + k) / ((s + 1) * (wanted + k))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: int, seed: int) -> int:
    """Gumbel noise in thousandths, from a hash of the id."""
    h = int(hashlib.sha256(b"%d:%d" % (seed, doc_id)).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gains: np.ndarray, max_n: int = MAX_N, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of ``docs``, in one pass."""

    def run(batches):
        names = ["doc_id", "n_words", "n_features", "weight", "score"]
        for b in batches:
            ids, done = b.column("doc_id").to_pylist(), 0
            for part in text_groups(text_list(b.column("text"))):
                t, n_words, n_features = interned(part, max_n)
                at = t.buckets(len(gains))
                of_slot = np.where(at >= 0, gains[at], 0)
                total = np.r_[0, np.cumsum(of_slot[t.slot])]
                ends = np.cumsum(n_features)
                weight = total[ends] - total[ends - n_features]
                own = ids[done:done + len(part)]
                done += len(part)
                score = [None if i is None else w + noise(i, seed) for i, w in zip(own, weight.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(n_words), pa.array(n_features), pa.array(weight),
                                                  pa.array(score, pa.int64())], names=names)

    return texts(docs).mapInArrow(run, SCORE_SCHEMA)


def ranked(rows: DataFrame, order: list, name: str) -> DataFrame:
    """``rows`` with ``rank`` (1, 2, ... in ``order``). After a range sort, a row's place in its
    partition and the sizes of the partitions before give its rank; the driver sees one
    number per partition."""
    spark = rows.sparkSession
    inside = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("__at", F.monotonically_increasing_id()))
    placed = stage(inside.select("*", F.shiftright("__at", 33).cast("int").alias("__part"),
                                 F.expr("__at & 8589934591L").alias("__row")).drop("__at"), name)
    sizes = sorted((r["__part"], r["n"]) for r in placed.groupBy("__part").agg(F.count("*").alias("n")).collect())
    before, starts = 0, []
    for part, n in sizes:
        starts.append((part, before))
        before += n
    start = spark.createDataFrame(starts, "__part int, __start long")
    return placed.join(F.broadcast(start), "__part").withColumn("rank", F.col("__start") + F.col("__row") + 1).drop("__part", "__row", "__start")


def importance_resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, max_n: int = MAX_N, least_words: int = LEAST_WORDS,
                        percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs`` (doc_id, text); drawn
    rows have a rank.

    Of the documents with at least ``least_words`` words, ``percent`` of a hundred with the
    highest scores are drawn (rounded down), ties to the smaller doc_id. A null text has no
    words, like an empty one. Rows that repeat an id are documents each (full ties in the
    order of weight and n_features); a row without an id has a null score and is neither
    drawn nor one of the documents that the share is of. Texts count whole, in any case,
    for the corpus. An empty table gives an empty result, an empty target only smoothing.
    """
    gains = bucket_gains(bucket_counts(docs, buckets, max_n), bucket_counts(target.withColumn("doc_id", F.lit(0)), buckets, max_n))
    rows = stage(scores(docs, gains, max_n, seed), "resample-scores")
    fit = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    columns = ["doc_id", "n_features", "weight", "score"]
    eligible = rows.where(fit)
    drawn = percent * eligible.count() // 100
    best = ranked(eligible.select(columns), [F.desc("score"), F.asc("doc_id"), F.desc("weight"), F.desc("n_features")], "resample-ranked")
    return (best.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
            .unionByName(rows.where(~fit).select(*columns, F.lit(None).cast("long").alias("rank"))))


def op12_resample(spark, sf_dir):
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# crc32 byte by byte: the table of 256 remainders comes from its rule (eight shifts each).
_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
OP12_SQL = f"""
WITH RECURSIVE crc(b, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT b, k + 1, {_STEP} FROM crc WHERE k < 8),
remainders AS (SELECT list(c ORDER BY b) AS r FROM crc WHERE k = 8),
corpus AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
target AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
hits AS (SELECT row_id, f, count(*) AS n FROM (SELECT row_id, unnest(w) AS f FROM corpus) GROUP BY row_id, f),
wanted AS (SELECT f, count(*) AS n FROM (SELECT unnest(w) AS f FROM target) GROUP BY f),
strings AS (SELECT DISTINCT f, hex(encode(f)) AS h FROM (SELECT f FROM hits UNION SELECT f FROM wanted)),
feature AS (
  SELECT f, xor(list_reduce(
      list_transform(range(0, length(h) // 2), lambda i:
        (strpos('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) * 16 + strpos('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1),
      lambda c, x: xor(c >> 8, r[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % {BUCKETS} AS bucket
  FROM strings, remainders),
source_counts AS (SELECT bucket, sum(n) AS s FROM hits JOIN feature USING (f) GROUP BY bucket),
target_counts AS (SELECT bucket, sum(n) AS t FROM wanted JOIN feature USING (f) GROUP BY bucket),
totals AS (SELECT coalesce((SELECT sum(s) FROM source_counts), 0) AS ss, coalesce((SELECT sum(t) FROM target_counts), 0) AS tt),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (ss + {BUCKETS}) AS DOUBLE) / CAST((s + 1) * (tt + {BUCKETS}) AS DOUBLE))) AS BIGINT) AS gain
  FROM source_counts LEFT JOIN target_counts USING (bucket), totals),
weights AS (SELECT row_id, sum(n * gain) AS weight FROM hits JOIN feature USING (f) JOIN gains USING (bucket) GROUP BY row_id),
noise AS (
  SELECT row_id, doc_id, len(w) AS n_features,
         list_reduce(list_transform(range(1, 9), lambda i: strpos('0123456789abcdef', substr(sha256('{SEED}:' || doc_id), i, 1)) - 1),
                     lambda a, b: a * 16 + b) AS h FROM corpus),
scored AS (
  SELECT row_id, doc_id, n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
  FROM noise LEFT JOIN weights USING (row_id)),
placed AS (
  SELECT row_id, row_number() OVER (ORDER BY score DESC, doc_id, weight DESC, n_features DESC) AS place, count(*) OVER () AS n
  FROM scored WHERE n_features >= {LEAST_WORDS} AND doc_id IS NOT NULL)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CASE WHEN place <= {PERCENT} * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (row_id)
"""
