"""Word2Vec in blocks: code, vocabulary, vectors, and nothing of the vocabulary's size on the driver."""

import heapq
import random
from collections import Counter

import numpy as np

from blogscope.operators import word_vectors as wv


def _plain_cost(counts):
    heap, cost = [c for c, n in counts.items() for _ in range(n)], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        w = heapq.heappop(heap) + heapq.heappop(heap)
        cost += w
        heapq.heappush(heap, w)
    return cost


def test_code_is_optimal_and_prefix_free():
    rng = random.Random(4)
    for case in ({5: 1}, {2: 2}, {1: 7}, {9: 1, 1: 3}, *[Counter(int(1 + rng.paretovariate(0.8)) for _ in range(300)) for _ in range(5)]):
        lengths = wv.code_lengths(dict(case))
        words = sorted((c for c, n in case.items() for _ in range(n)), reverse=True)
        sizes = [k for k, n in lengths for _ in range(n)]
        assert len(sizes) == len(words) and sum(c * k for c, k in zip(words, sizes)) == _plain_cost(case)
        nodes, bits, on = wv.paths(np.arange(len(words)), lengths)
        codes = ["".join(map(str, b[o])) for b, o in zip(bits, on)]
        assert [len(c) for c in codes] == sizes and len(set(codes)) == len(codes)
        assert not any(a != b and b.startswith(a) for a in codes for b in codes if a)
        for c, n, o in zip(codes, nodes, on):
            assert [int("1" + c[:d], 2) for d in range(len(c))] == n[o].tolist()


def _segments(spark, n=400):
    rng = random.Random(2)
    groups = [[f"{g}{i}" for i in range(8)] for g in "ab"]
    rows = [([rng.choice(groups[i % 2]) for _ in range(30)] + (["once%d" % i] if i < 5 else []),) for i in range(n)]
    return spark.createDataFrame(rows + [([],), (None,)], "tokens array<string>").repartition(3)


def test_words_that_occur_together_come_close(spark, monkeypatch):
    monkeypatch.setattr(wv, "BLOCK_TOKENS", 2000)
    got = {r["word"]: np.array(r["vec"]) for r in wv.word_vectors(_segments(spark), size=16, max_iter=3).collect()}
    assert set(got) == {f"{g}{i}" for g in "ab" for i in range(8)}  # words that occur once are out
    assert all(len(v) == 16 and np.isfinite(v).all() for v in got.values())
    unit = {w: v / np.linalg.norm(v) for w, v in got.items()}
    same = [unit[a] @ unit[b] for a in unit for b in unit if a < b and a[0] == b[0]]
    other = [unit[a] @ unit[b] for a in unit for b in unit if a[0] < b[0]]
    assert np.mean(same) > np.mean(other) + 0.3


def test_no_vocabulary_reaches_the_driver(spark, monkeypatch):
    from pyspark.ml import feature
    monkeypatch.setattr(feature, "Word2Vec", None)  # its model keeps all vectors on the driver
    segs = spark.createDataFrame([(["x", "y", None, "x", "y"],), (["x", "z"],)], "tokens array<string>")
    assert {r["word"]: len(r["vec"]) for r in wv.word_vectors(segs).collect()} == {"x": 64, "y": 64}
    one = spark.createDataFrame([(["x", "x"],)], "tokens array<string>")
    assert [r["word"] for r in wv.word_vectors(one).collect()] == ["x"]
    assert wv.word_vectors(segs.limit(0)).count() == 0
    assert not wv.word_vectors(segs, min_count=9).collect()


def _plain_train(words, inner, tokens, sentence, path, bits, on, rng, rates):
    """One batch after the other, a pair and a node at a time."""
    for lo in range(0, len(tokens), wv.BATCH):
        batch = range(lo, min(lo + wv.BATCH, len(tokens)))
        rate = rates[0] + (rates[1] - rates[0]) * lo / len(tokens)
        moves = {}, {}
        reach = rng.integers(1, wv.WINDOW + 1, len(batch))
        for p, r in zip(batch, reach):
            t = tokens[p]
            near = [q for q in range(p - r, p + r + 1) if q != p and 0 <= q < len(tokens) and sentence[q] == sentence[p]]
            for q in near:
                total = np.zeros(words.shape[1])
                for d in np.flatnonzero(on[t]):
                    f = float(words[tokens[q]] @ inner[path[t, d]])
                    g = rate * (1 - bits[t, d] - 1 / (1 + np.exp(-f))) if abs(f) < wv.MAX_EXP else 0.0
                    total += g * inner[path[t, d]]
                    moves[1].setdefault(path[t, d], []).append((p, g * words[tokens[q]]))
                moves[0].setdefault(tokens[q], []).append(total)
        uses = Counter(path[tokens[p], d] for p in batch for d in np.flatnonzero(on[tokens[p]]))
        for w, m in moves[0].items():
            words[w] += sum(m) / max(1, len(m) / wv.REPEATS)
        for n, m in moves[1].items():
            inner[n] += sum(x for _, x in m) / max(1, uses[n] / wv.REPEATS)


def test_training_equals_a_plain_version_and_gathers_deep_nodes_only(monkeypatch):
    monkeypatch.setattr(wv, "BATCH", 40)
    rng = np.random.default_rng(1)
    many, size = 600, 8
    tokens = np.minimum(rng.zipf(1.3, 300) - 1, many - 1)
    sentence = np.sort(rng.integers(0, 20, len(tokens)))
    path, bits, on = wv.paths(np.arange(many), wv.code_lengths(Counter(1 + 3000 // (k + 1) for k in range(many))))
    nodes, way = np.unique(path, return_inverse=True)
    way = way.reshape(path.shape)
    got, want = [[(rng_.random((many, size)) - 0.5).astype(np.float32), (rng_.random((len(nodes), size)) - 0.5).astype(np.float32)]
                 for rng_ in (np.random.default_rng(2), np.random.default_rng(2))]
    gathered, real = [], wv.add_rows

    def recorded(table, ids, *rest):
        if table is got[1]:
            gathered.extend(ids.tolist())
        real(table, ids, *rest)
    monkeypatch.setattr(wv, "add_rows", recorded)
    wv.train(*got, tokens, sentence, way, bits, on, np.random.default_rng(3), [0.2, 0.1])
    _plain_train(*want, tokens, sentence, way, bits, on, np.random.default_rng(3), [0.2, 0.1])
    assert all(np.allclose(a, b, atol=1e-3) for a, b in zip(got, want))  # sums of float32
    assert np.abs(want[0] - (np.random.default_rng(2).random((many, size)) - 0.5)).max() > 0.1
    assert gathered and min(nodes[gathered]) >= 1 << wv.TOP  # the levels that all tokens share are never gathered node by node
