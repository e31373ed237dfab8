"""Blocks of a term matrix, however they are cut; parts of a batch; bounded shuffles."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from blogscope.operators import phrases, term_blocks, terms, topic_factors, topics

KEY = ["doc_id", "seg_id"]


@pytest.fixture()
def small(spark, monkeypatch):
    monkeypatch.setattr(term_blocks, "LEAST_ENTRIES", 8)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")  # a block is one batch at least
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.fixture()
def matrix(spark):
    rows = [(d, s, w, 1.0 + (d + s) % 3) for d in range(20) for s in range(2) for w in ("all", f"even{d % 2}", f"own{d}", f"w{(d * s) % 5}")]
    return spark.createDataFrame(rows + [(None, 0, "all", 2.0), (None, 0, "own3", 1.0)], "doc_id long, seg_id int, term string, weight double").repartition(3)


def test_numbers_of_terms_go_to_blocks_and_back(matrix, small):
    b = term_blocks.build(matrix, KEY)
    assert b.rows.count() > 5 and b.vocab.where("bucket < 0").count() and b.routes.count()
    assert sorted(t for r in b.vocab.collect() for t in r.terms) == sorted(r.term for r in matrix.select("term").distinct().collect())
    lam = matrix.select("term").distinct().select("term", F.array(F.length("term").cast("double"), F.lit(2.0)).alias("lam"))
    table = b.place(lam, 2)
    assert {r.term: r.v for r in b.named(table, 2).collect()} == {r.term: r.lam for r in lam.collect()}

    def run(block):
        import numpy as np
        x = block.values(2)[block.idx] * block.weight[:, None]
        yield block.parts(np.stack([np.bincount(block.idx, x[:, c], block.terms) for c in (0, 1)], axis=1))
    got = {r.term: r.v for r in b.named(b.to_terms(b.each(b.to_blocks(table, 2), run, term_blocks.PARTS), 2), 2).collect()}
    assert got == {r.term: [len(r.term) * r.s, 2 * r.s] for r in matrix.groupBy("term").agg(F.sum("weight").alias("s")).collect()}


def test_a_model_is_the_same_in_small_blocks(matrix, request):
    def run():
        m = topic_factors.fit(matrix, KEY, 3, passes=3)
        mix = {(r.doc_id, r.seg_id): r.mixture for r in topic_factors.segment_mixtures(matrix, m, KEY).collect()}
        return {r.term: r.lam for r in m.table.collect()}, mix
    want = run()
    request.getfixturevalue("small")
    for a, b in zip(run(), want):
        assert set(a) == set(b) and all(a[x] == pytest.approx(b[x], rel=1e-9) for x in b)


def test_phrases_hold_few_blogs_at_a_time():
    kind = pa.list_(pa.list_(pa.string()))
    blogs = [[["new", "york", "x"]] * 9, None, [["a"], [], None, ["b", None]], []]
    batch = pa.RecordBatch.from_arrays([pa.array(blogs, kind)], names=["p"])
    small, large = (list(phrases._row_phrases("p", ((2, 1.0),), most)([batch])) for most in (1, 10 ** 6))
    assert len(large) == 1 and len(small) > 1
    assert [v for b in small for v in b.column(0).to_pylist()] == large[0].column(0).to_pylist()


def test_tfidf_of_a_corpus_sorts_bounded_rows(spark, monkeypatch):
    counts = spark.createDataFrame([(d, f"t{(d * j) % 17}", 1 + j) for d in range(30) for j in range(4)], "doc_id long, term string, cnt long")
    assert terms.row_parts(counts, 10) == 12 and terms.row_parts(counts) == 0
    run = lambda: sorted(map(tuple, terms.corpus_tfidf_top(counts, ["doc_id"]).select("doc_id", "rank", "term", F.round("weight", 9)).collect()))
    want = run()
    monkeypatch.setattr(terms, "row_parts", lambda df: 12)
    assert run() == want


def test_blogs_keep_described_topics_only(spark):
    fields = "topic_id int, topic_quality double, label string, words array<string>, weights array<double>, coherence_scores array<double>, semantic_coherence double"
    described = spark.createDataFrame([(i, 0.5 + i / 10, f"l{i}", [f"w{i}"], [1.0], [0.5], 0.5) for i in range(3)] + [(None, 0.9, "n", ["n"], [1.0], [0.5], 0.5)], fields)
    shares = spark.createDataFrame([(1, 0), (1, 2), (1, 2), (2, 1), (3, 9), (4, None)], "doc_id long, topic_id int")
    kept = topics.blog_topics(shares, described)
    assert sorted((r.doc_id, r.topic_id) for r in kept.collect()) == [(1, 0), (1, 2), (2, 1)]
