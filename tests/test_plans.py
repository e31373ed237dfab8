"""Plan shape guards: no pairwise joins anywhere, filters where they are written,
partial top-n for hot groups."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
MODEL_QUERIES = {"m1_lda_topics", "m1_incremental_topics", "w10_blog_topics", "x3_lda_taxonomy", "m4_choose_k",
                 "m5_word_vectors", "p2b_language_bayes"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# the training-data queries have their own tests; the other reports share these plans
OWN_TESTS = {n for n in E.queries() if n.startswith("op") or n == "pipeline"}
SAME_PLANS = {"r3_subcategory_scores", "r4_subcategory_specificity", "w3_subcategory_summary", "r6_subcategory_scores",
              "r6_subcategory_specificity", "m3_topic_shares", "m6_reranked_words", "m8_described_topics", "w11_kept_topics"}


@pytest.mark.parametrize("name", sorted(set(E.queries()) - MODEL_QUERIES - OWN_TESTS - SAME_PLANS))
def test_no_pairwise_joins(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["t5_phrases", "t7_corpus_tfidf", "t9_corpus_tfidf", "e1_top_term_sentences",
                                  "e4_method_agreement", "r6_category_scores"])
def test_raw_text_is_scanned_once(spark, name):
    """The raw text is read by the one job that writes the stage of English blogs; the
    query's own plan reads stages only."""
    from blogscope import session
    before = len(session._STAGES)
    df = E.queries()[name](spark, SF)
    assert "documents.parquet" not in _plan(df)
    assert sum("/english-blogs-" in p for p in session._STAGES[before:]) == 1


def test_segment_topn_is_partial(spark):
    df = E.queries()["e3_segment_tfidf_terms"](spark, SF)
    df.collect()
    plan = _plan(df)
    assert "WindowGroupLimit" in plan and "Partial" in plan
