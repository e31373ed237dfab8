
import datetime as dt
import math


import numpy as np
from pyspark.sql import functions as F

from blogscope.functions import lexicon as lx, text as tx
from blogscope.operators import language, segments, taxonomy, topics
from blogscope.sources import blogfiles


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_file_name_with_three_parts(spark):
    df = spark.createDataFrame([("/x/123.male.25.xml",)], "path string")
    r = blogfiles.files_table(df).first()
    assert (r.scrapping_timestamp, r.gender, r.age) == ("123", "male", "25")
    assert r.industry is None and r.star_sign is None and r.id is not None


def test_more_dates_than_posts(spark):
    text = "<date>1,mai,2004</date><post>a</post><date>2,mai,2004</date>"
    df = spark.createDataFrame([(1, text)], "id long, t string")
    rows = blogfiles.posts_from_text(df, "id", "t").collect()
    assert [(r.pos, r.date_text, r.content) for r in rows] == [(0, "1,mai,2004", "a")]


def test_ampersand_escape(spark):
    assert one(spark, tx.escape_stray_ampersands(F.col("v")), "a & b &amp; &#39;") == "a &amp; b &amp; &amp;#39;"


def test_invalid_utf8(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb"),)], "b binary")
    assert df.select(blogfiles.bytes_to_text("b").alias("t")).first().t == "a�b"


def test_multilingual_dates(spark):
    assert one(spark, blogfiles.parse_day_first_date(F.col("v")), "14,mai,2004") == dt.datetime(2004, 5, 14)
    assert one(spark, blogfiles.parse_day_first_date(F.col("v")), "x") is None
    assert one(spark, blogfiles.parse_day_first_date(F.col("v")), "3,Décembre,2003") == dt.datetime(2003, 12, 3)


def test_language_guards(spark):
    assert one(spark, language.detect_language(F.col("v")), "ab") == "unknown"
    assert one(spark, language.detect_language(F.col("v")), "the cat!!") == "unknown"
    assert one(spark, language.detect_language(F.col("v")), "the cat and the dog of the house") == "en"
    assert one(spark, language.detect_language(F.col("v")), "le chat et les chiens dans la maison") == "fr"


def test_age_groups_and_student(spark):
    df = spark.createDataFrame([("abc", None), (None, "Student"), ("20", "x"), ("21", None)],
                               "age string, industry string")
    rows = segments.prepare_demographics(df).collect()
    assert [r.age_group for r in rows] == [">20", ">20", "<=20", ">20"]
    assert [r.is_student for r in rows] == [None, True, False, None]  # NULL industry: neither segment


def test_unclassified_documents_count_in_denominator(spark):
    df = spark.createDataFrame(
        [(1, {"a:x": 50.0}), (2, None), (3, {})],
        "file_id long, scores map<string,double>")
    s = segments.segment_scores(df, {"Everyone": F.lit(True)}, "scores", "category").collect()
    assert len(s) == 1 and math.isclose(s[0].average_weighted_score, 0.5 / 3)


def test_percentile_threshold(spark):
    df = spark.createDataFrame([(1, 0, ["a", "b", "c", "d", "e"], [0.1, 0.4, 0.25, 0.9, 0.33], None, 0.5)],
                               "doc_id long, topic_id int, words array<string>, weights array<double>, "
                               "coherence_scores array<double>, topic_quality double")
    rows = taxonomy.select_topic_words(df).orderBy("pos").collect()
    # 60th percentile is 0.358: only d and b pass, so the best three are kept
    assert math.isclose(float(np.percentile([0.1, 0.4, 0.25, 0.9, 0.33], 60)), 0.358)
    assert [r.word for r in rows] == ["d", "b", "e"]


def test_topic_deduplication(spark):
    t = "struct<topic_quality:double,words:array<string>>"
    df = spark.createDataFrame([([(0.9, ["a", "b", "c", "d", "e"]), (0.8, ["a", "b", "c", "d", "z"]),
                                  (0.85, ["p", "q", "r", "s", "t"])],)], f"c array<{t}>")
    kept = df.select(topics.filter_meaningful(F.col("c")).alias("k")).first().k
    assert [k.topic_quality for k in kept] == [0.9, 0.85]


def test_subtopic_under_two_majors_keeps_later(spark):
    tax = spark.createDataFrame([(0, "a", "x"), (1, "b", "x"), (2, "b", "y")], "ord int, major string, subtopic string")
    vec = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [0.0, 1.0])], "word string, vec array<double>")
    rows = sorted((r.ord, r.major, r.subtopic) for r in taxonomy.subtopic_vectors(tax, vec).collect())
    assert rows == [(0, "b", "x"), (2, "b", "y")]


def test_summary_placeholder(spark):
    scores = spark.createDataFrame([("Male", "a", 0.5)], "demographic string, classification string, average_weighted_score double")
    sizes = spark.createDataFrame([("Male", 3), ("Female", 2)], "demographic string, documents long")
    rows = {r.demographic: (r.first, r.second) for r in segments.top2_summary(scores, sizes).collect()}
    assert rows == {"Male": ("a", lx.NO_SECOND_CATEGORY), "Female": (lx.NO_CATEGORIES, lx.NO_CATEGORIES)}


def test_clean_content_parity_order(spark):
    assert one(spark, tx.clean_content(F.col("v")), "a &amp; b urlLink x2y") == "a amp b x y"
    assert one(spark, tx.clean_content_decoded(F.col("v")), "a &amp; b") == "a b"


def test_clean_html(spark):
    v = "<p>Hi&nbsp;there</p> see http://x.y/z or me@x.org &amp; more"
    assert one(spark, tx.clean_html(F.col("v")), v) == "Hi there see or & more"
    assert one(spark, tx.clean_html_if_needed(F.col("v")), "plain words only") == "plain words only"


def test_topic_label(spark):
    def lab(ws):
        return spark.createDataFrame([(ws,)], "w array<string>").select(tx.topic_label(F.col("w"))).first()[0]
    assert lab(["ab", "house", "cd", "garden", "tree"]) == "house_garden"
    assert lab(["ab", "cd", "ef"]) == "ab_cd"
    assert lab([]) == "unknown_topic"
