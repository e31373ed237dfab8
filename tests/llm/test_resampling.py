"""Importance resampling against a version that counts one feature at a time."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from blogscope.llm import resampling

from .test_operators import ROWS, frame

BENCH = [(1, "The river and the stone"), (2, None), (2, "alpha beta, alpha"), (None, "cloud cloud cloud")]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, n):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [" ".join(w[i:i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def expected(rows, bench, buckets, n, least, percent, seed=2024):
    def count(table):
        return collections.Counter(zlib.crc32(g.encode()) % buckets for _, t in table for g in grams(t, n)[1])

    s, t = count(rows), count(bench)
    total, wanted = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total + buckets) / ((s[b] + 1) * (wanted + buckets)))) for b in range(buckets)]
    out, eligible = [], []
    for k, (i, text) in enumerate(rows):
        n_words, own = grams(text, n)
        weight = sum(gain[zlib.crc32(g.encode()) % buckets] for g in own)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n_words >= least:
                eligible.append((-score, i, -weight, -len(own), k))
        out.append([i, len(own), weight, score, None])
    for place, e in enumerate(sorted(eligible)[:percent * len(eligible) // 100], 1):
        out[e[-1]][-1] = place
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("buckets,n,least,percent", [(10_000, 1, 20, 10), (7, 3, 1, 50), (100, 2, 3, 100)])
def test_resampling(spark, buckets, n, least, percent):
    for rows, bench in ((ROWS, BENCH), (ROWS, []), (ROWS[1:3], BENCH), ([], BENCH)):
        got = resampling.importance_resample(frame(spark, rows).repartition(3), frame(spark, bench), buckets, n, least, percent)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows, bench, buckets, n, least, percent)


def test_ranks_over_many_partitions(spark):
    rows = [(i, "the river " * (1 + i % 7) + "stone " * 20) for i in range(500)] + [(3, "the river " * 4 + "stone " * 20)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = resampling.importance_resample(frame(spark, rows).repartition(9), frame(spark, BENCH), percent=60)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows, BENCH, 10_000, 1, 20, 60)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_equal_keys_are_told_apart_by_their_bytes():
    items = [b"a", b"b", b"a", b"c", b"", b"b", b"a"] * 30
    for keys in (None, np.zeros(len(items), np.uint64), np.array([len(items) - k for k in range(7)] * 30, np.uint64) * 0 + 5):
        t = resampling.InternTable(items, keys)
        assert [items[t.owner[s]] for s in t.slot] == items
        assert sorted((items[t.owner[s]], t.counts()[s]) for s in t.used) == sorted(collections.Counter(items).items())
    assert len(resampling.InternTable([]).used) == 0
