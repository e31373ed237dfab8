"""Array-expression operators against brute force, and report invariants."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from blogscope.functions import bags
from blogscope.operators import segments, terms, topics


def _lists(seed=7, n=60):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(12)]
    return [(i, [rnd.choice(vocab) for _ in range(rnd.randint(0, 40))]) for i in range(n)]


def test_term_counts_brute_force(spark):
    data = _lists()
    df = spark.createDataFrame(data, "id long, t array<string>")
    got = {r.id: {x.term: x.cnt for x in r.b} for r in df.select("id", bags.term_counts(F.col("t")).alias("b")).collect()}
    assert got == {i: dict(Counter(t)) for i, t in data}


def test_word_frequencies_brute_force(spark):
    data = _lists(3)
    df = spark.createDataFrame(data, "id long, t array<string>")
    got = {r.id: (r.w.most_common, r.w.least_common)
           for r in df.select("id", terms.word_frequencies(F.col("t"), 5, 5).alias("w")).collect()}
    for i, t in data:
        c = Counter(t)
        most = [w for w, _ in c.most_common(5)]
        least = [w for w, _ in sorted(((w, n) for w, n in c.items() if n > 1), key=lambda x: x[1])[:5]]
        assert got[i] == (most, least)


def test_tfidf_topic_norm_and_order(spark):
    data = _lists(5)
    df = spark.createDataFrame(data, "id long, t array<string>")
    rows = df.select("id", terms.tfidf_topic(F.col("t"), top_n=50, num_words=50).alias("x")).collect()
    for r in rows:
        ws = r.x.weights
        if ws:
            assert math.isclose(sum(w * w for w in ws), 1.0, rel_tol=1e-9)
            assert ws == sorted(ws, reverse=True)


def test_ranks_without_gaps(spark):
    df = spark.createDataFrame([("a", "x", 0.3), ("a", "y", 0.3), ("a", "z", 0.1), ("b", "x", 0.2)],
                               "demographic string, classification string, s double")
    r = segments.rank_within(df, "s").collect()
    by = {}
    for x in r:
        by.setdefault(x.demographic, []).append(x["rank"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in by.values())
    assert [x.classification for x in sorted(r, key=lambda x: (x.demographic, x["rank"]))][:2] == ["x", "y"]


def test_specificity_partition_identity(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.random() < 0.3, {"a:x": float(rnd.randint(0, 100)), "b:y": float(rnd.randint(0, 100))})
            for i in range(200)]
    df = spark.createDataFrame(rows, "file_id long, s boolean, scores map<string,double>")
    segs = {"S": F.col("s"), "N": ~F.col("s"), "Everyone": F.lit(True)}
    sc = segments.segment_scores(df, segs, "scores", "category")
    spec = {(r.demographic, r.classification): r.popularity_bias_score for r in segments.specificity(sc).collect()}
    n_s = sum(1 for r in rows if r[1])
    for c in ["a", "b"]:
        total = n_s / 200 * spec[("S", c)] + (200 - n_s) / 200 * spec[("N", c)]
        assert math.isclose(total, 1.0, rel_tol=1e-9)


def test_topic_quality_matches_python(spark):
    import numpy as np

    def py(words, weights, coh):
        top = sorted(coh, reverse=True)[:3]
        wc = 0.5 * top[0] + 0.3 * top[1] + 0.2 * top[2] if len(top) >= 3 else float(np.mean(coh))
        w = np.array(weights[:8])
        p = w / w.sum()
        ent = -np.sum(p * np.log(p + 1e-10))
        dist = 1 - ent / np.log(len(p)) if len(p) > 1 else 0.0
        rich = min(1.0, len({x[:4] for x in words[:6] if len(x) > 3}) / 4.0)
        return 0.5 * min(1.0, wc) + 0.3 * dist + 0.2 * rich
    cases = [(["house", "garden", "tree", "ab", "housing"], [5.0, 4.0, 3.0, 2.0, 1.0], [0.9, 0.4, 0.6, 0.3, 0.2]),
             (["alpha", "beta"], [1.0, 1.0], [0.5, 0.5])]
    df = spark.createDataFrame(cases, "w array<string>, x array<double>, c array<double>")
    got = [r.q for r in df.select(topics.topic_quality(F.col("w"), F.col("x"), F.col("c")).alias("q")).collect()]
    for g, c in zip(got, cases):
        assert math.isclose(g, py(*c), rel_tol=1e-9)
