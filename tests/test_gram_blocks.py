"""T7 in blocks against a plain count, and what it shuffles."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from blogscope.operators import gram_blocks, terms

KEY = ["doc_id", "seg_id"]
ROWS = ([(d, s, [f"w{(d * 7 + s * 3 + j * j) % 11}" for j in range(3 + d % 4)] + ["all"]) for d in range(12) for s in range(3)]
        + [(3, 1, ["w1", "w1", "w2"]), (None, 0, ["w1", "w5", "all"]), (None, 0, ["w5", "all"]), (50, 0, []), (50, 1, None), (60, 0, ["éx", "once"])])


def plain(rows, scope, max_features, min_df=2, max_df=0.85):
    grams = [Counter(" ".join(t[i:i + n]) for n in (1, 2, 3) for i in range(len(t or []) - n + 1)) for _, _, t in rows]
    of = [r[0] if scope else 0 for r in rows]
    df, total, n = defaultdict(Counter), defaultdict(Counter), Counter(of)
    for s, g in zip(of, grams):
        df[s].update(g.keys())
        total[s].update(g)
    kept = {}
    for s in n:
        strict = {t for t, c in df[s].items() if min_df <= c <= max_df * n[s]}
        some = strict or {t for t, c in df[s].items() if c <= max_df * n[s]}
        kept[s] = set(sorted(some, key=lambda t: (-total[s][t], t))[:max_features])
    raw, norm = defaultdict(list), Counter()
    for (d, g, _), s, c in zip(rows, of, grams):
        if scope and d is None:
            continue
        for t, x in c.items():
            if t in kept[s]:
                w = (1 + math.log(x)) * (math.log((1 + n[s]) / (1 + df[s][t])) + 1)
                raw[d, g].append((t, x, w))
                norm[d, g] += w * w
    return {k: sorted((t, x, w / math.sqrt(norm[k])) for t, x, w in v) for k, v in raw.items()}


@pytest.mark.parametrize("scope", [["doc_id"], []])
@pytest.mark.parametrize("most", [None, 7])
def test_matrix_equals_a_plain_count(spark, scope, most):
    segs = spark.createDataFrame(ROWS, "doc_id long, seg_id int, tokens array<string>").repartition(3)
    got = defaultdict(list)
    for r in terms.segment_tfidf(segs, KEY, scope, max_features=most).collect():
        got[r.doc_id, r.seg_id].append((r.term, r.cnt, r.weight))
    want = plain(ROWS, scope, most)
    assert set(got) == set(want)
    for k in want:
        have = sorted(got[k])
        assert [x[:2] for x in have] == [x[:2] for x in want[k]]
        assert [x[2] for x in have] == pytest.approx([x[2] for x in want[k]])


def test_blocks_of_any_size_give_the_same(spark, monkeypatch):
    segs = spark.createDataFrame(ROWS, "doc_id long, seg_id int, tokens array<string>").repartition(3)
    run = lambda: sorted(map(str, gram_blocks.term_rows(segs, KEY, []).select(*KEY, F.expr("array_sort(transform(entries, x -> x.term))")).collect()))
    want = run()
    monkeypatch.setattr(gram_blocks, "BLOCK_TOKENS", 1)
    monkeypatch.setattr(gram_blocks, "BUCKET_GRAMS", 2)
    assert run() == want


def test_no_ngram_is_shuffled_as_a_string(spark):
    segs = spark.createDataFrame(ROWS, "doc_id long, seg_id int, tokens array<string>")
    plan = gram_blocks.term_rows(segs, KEY, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Window" not in plan
