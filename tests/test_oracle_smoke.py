"""A few registered queries against their SQL twins on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from blogscope.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET enable_progress_bar = false")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", ["r2_category_specificity", "t8_tfidf_topics", "w8_word_frequencies",
                                  "p2_language_vote", "e3_segment_tfidf_terms", "s3_page_posts", "t7_corpus_tfidf", "x3_source_taxonomy",
                                  "a1_dated_blogs", "x1_subtopic_vectors", "e6_topics_over_time"])
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = _norm([tuple(r[c] for c in cols) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    want = _norm([tuple(dict(zip(dcols, r))[c] for c in cols) for r in res.fetchall()])
    assert sorted(dcols) == cols
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 20 and df.columns == ["demographic", "classification", "popularity_bias_score", "rank"]
