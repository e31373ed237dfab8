"""Fingerprints against a naive version that takes one byte and one table cell at a time."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from blogscope.llm import fingerprints as fp

from .test_operators import ROWS, frame

M64, M32 = (1 << 64) - 1, (1 << 32) - 1


def naive_marks(raw):
    out = []
    for i in range(len(raw)):
        h = sum((raw[i - j] + 1) * pow(fp.ROLL, j, 1 << 32) for j in range(fp.WINDOW) if i >= j) & M32
        h ^= h >> 15
        h = h * 0x2C1B3C6D & M32
        out.append(h ^ h >> 13)
    return out


def naive_code(chunk):
    x = sum((c + 1) * pow(fp.CHUNK, k, 1 << 64) for k, c in enumerate(chunk)) + len(chunk) * 0x9E3779B97F4A7C15 & M64
    x = (x ^ x >> 31) * 0x94D049BB133111EB & M64
    return (x ^ x >> 29) >> 52


def naive_fingerprint(raw):
    block, hashes = 1, naive_marks(raw)
    while block * fp.BLOCKS < len(raw):
        block *= 2
    parts = []
    for size in (block, 2 * block):
        mask, codes, at = size // 2 - 1 if size > 1 else 0, [], 0
        for i in range(len(raw)):
            long_enough = i + 1 - at >= max(size // 2, 1)
            if long_enough and hashes[i] & mask == mask or i + 1 - at == fp.LONGEST * size or i + 1 == len(raw):
                codes.append(naive_code(raw[at:i + 1]))
                at = i + 1
        text = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
        parts.append("".join(text[c >> 6] + text[c & 63] for c in codes))
    return f"{block}:{parts[0]}:{parts[1]}"


def naive_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def naive_likeness(a, b):
    if a == b:
        return 1.0
    both = fp.comparable(a, b)
    if both is None:
        return 0.0
    x, y = ([s[k:k + 2] for k in range(0, len(s), 2)] for s in both)
    return 1 - naive_distance(x, y) / max(len(x), len(y), 1)


def corpus():
    rng = random.Random(3)
    out = [b"", b"x", b"ab" * 700, b"The " * 300, "日本語 🙂 naïve".encode() * 9, bytes(3000)]
    out += [bytes(rng.choice(b"abcdefg ") for _ in range(rng.choice([2, 5, 31, 32, 33, 64, 65, 300, 2500]))) for _ in range(60)]
    return out


def test_fingerprints_equal_the_naive_ones(monkeypatch):
    raw = corpus()
    want = [naive_fingerprint(x) if x else "1::" for x in raw]
    assert fp.fingerprints_of(raw) == want
    monkeypatch.setattr(fp, "GROUP", 500)  # many groups, texts longer than one
    fp.group_powers.cache_clear()
    assert fp.fingerprints_of(raw) == want
    fp.group_powers.cache_clear()
    assert max(len(p) for f in want for p in f.split(":")[1:]) <= 2 * fp.CHUNKS


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), max_size=64), st.lists(st.integers(0, 3), max_size=64)), min_size=1, max_size=5))
def test_edit_distances(pairs):
    first, second = ([np.array(p[k], np.int64) for p in pairs] for k in (0, 1))
    assert fp.edit_distances(first, second).tolist() == [naive_distance(*p) for p in pairs]


def expected(rows):
    def place(r):
        h = xxhash.xxh64_intdigest((r[1] or "").encode(), seed=42) if r[1] is not None else 42
        return (r[0] is None, -(r[0] or 0), h - (1 << 64) if h >> 63 else h, r[1] is not None, r[1] or "")
    order = sorted(rows, key=place)
    out = []
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        t, following = t or "", following or ""
        k = len(t) // 3
        changed = t[:len(t) - k] + following[:k]
        own, new, nxt = (naive_fingerprint(x.encode()) if x else "1::" for x in (t, changed, following))
        out.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), own, new, naive_likeness(own, new), naive_likeness(own, nxt)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [1, 7])
def test_edited_fingerprints(spark, parts):
    conf = {"spark.sql.shuffle.partitions": str(parts), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for rows in (ROWS, ROWS[:1], ROWS[1:2], [(5, "one text"), (5, "one text"), (5, "one text")]):
            got = fp.edited_fingerprints(frame(spark, rows).repartition(3)).collect()
            assert sorted((tuple(r) for r in got), key=repr) == expected(rows)
        assert fp.edited_fingerprints(frame(spark, [])).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_copies_and_pairs(spark):
    got = fp.fingerprints(frame(spark)).collect()
    by_text = {}
    for r in got:
        by_text.setdefault(r["doc_id"], r["fingerprint"])
    assert by_text[1] == by_text[5] and by_text[2] == by_text[3] == "1::" and len(got) == len(ROWS)
    pairs = spark.createDataFrame([(1, by_text[1], by_text[5]), (2, by_text[1], by_text[6]), (3, None, by_text[1])],
                                  "score long, a string, b string")
    like = {r["score"]: r["likeness"] for r in fp.with_likeness(pairs, "a", "b").collect()}
    assert like[1] == 1.0 and 0.8 < like[2] < 1.0 and like[3] is None


def test_an_edit_keeps_the_rest_alike():
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 7) for _ in range(rng.choice([8, 60, 900]))) for _ in range(200)]
    texts += [("word " * 400) + str(k) * 600 for k in range(9)]  # repeats itself
    for a, b in zip(texts, texts[1:]):
        one, changed, other = fp.fingerprints_of([x.encode() for x in (a, fp.edited(a, b), b)])
        near, far = fp.likeness_of([(one, changed), (one, other)])
        assert near > 0.3 and (near > far or a[:300] == b[:300])
