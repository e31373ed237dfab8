"""Sources, sinks, stage reuse, TSV taxonomy, phrase merge, small helpers."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from blogscope.operators import phrases, taxonomy
from blogscope.plans import segment_topics as st
from blogscope.sources import blogfiles, tables


def test_taxonomy_tsv(spark):
    lines = ["header one", "header two",
             "1\tx\tCars & Trucks\tAutomotive\t",
             "2\tx\tAutomotive\tAutomotive\t",
             "3\tx\tshort",
             "4\tx\tTV\tEntertainment\t",
             "5\tx\tCars & Trucks\tAutomotive\t"]
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "line_no int, value string")
    rows = sorted((r.ord, r.major, r.subtopic) for r in taxonomy.parse_taxonomy_tsv(df).collect())
    assert rows == [(2, "automotive", "cars_and_trucks"), (5, "entertainment", "tv")]


def test_stage_reuse_and_sinks(spark, tmp):
    path = os.path.join(tmp, "stage")
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)
    assert tables.cached_stage(spark, path, build).count() == 5
    assert tables.cached_stage(spark, path, build).count() == 5
    assert len(calls) == 1
    rep = spark.createDataFrame([("a", "x", 0.5, 1)], "demographic string, classification string, s double, rank int")
    tables.write_report(rep, os.path.join(tmp, "r.parquet"), ["demographic", "rank"])
    assert spark.read.parquet(os.path.join(tmp, "r.parquet")).count() == 1
    assert spark.read.option("header", True).csv(os.path.join(tmp, "r.csv")).count() == 1


def test_required_columns_and_first_rows(spark):
    df = spark.range(10)
    with pytest.raises(ValueError):
        tables.require_columns(df, "content")
    assert [r.id for r in tables.first_rows(df, 3, "id").collect()] == [0, 1, 2]


def test_json_decode_malformed(spark):
    df = spark.createDataFrame([('{"a:x": 1.5}',), ("bad",), (None,)], "j string")
    got = [r.m for r in df.select(tables.decode_json_map("j").alias("m")).collect()]
    assert got[0] == {"a:x": 1.5} and got[1] is None and got[2] is None


def test_greedy_merge_chain(spark):
    df = spark.createDataFrame([(["a", "b", "c"], [True, True]), (["a", "b", "c", "d"], [True, True, True]),
                                (["x"], [])], "t array<string>, f array<boolean>")
    got = [r.m for r in df.select(phrases.greedy_merge(F.col("t"), F.col("f")).alias("m")).collect()]
    assert got == [["a_b", "c"], ["a_b", "c_d"], ["x"]]


def test_phrase_detection_end_to_end(spark):
    # n(new)=n(york)=n(new york)=3 and V ~ 185: score (3-2)*185/9 ~ 20 > 8; fillers score 0
    rows = [(0, i, ["new", "york"] + [f"f{i}x{j}" for j in range(30)]) for i in range(3)]
    rows.append((0, 9, ["big", "new", "apple"]))
    df = spark.createDataFrame(rows, "doc_id long, sent_id long, tokens array<string>")
    out = {r.sent_id: r.phrased for r in phrases.detect_phrases(df, ["doc_id", "sent_id"], ["doc_id"]).collect()}
    assert all(out[i][0] == "new_york" and len(out[i]) == 31 for i in range(3))
    assert out[9] == ["big", "new", "apple"]


def test_error_column(spark):
    df = spark.createDataFrame([("",), ("text",), (None,)], "content string")
    got = [r.error for r in st.with_error(df).collect()]
    assert got == ["empty content", None, "empty content"]


def test_batch_job_writes_and_reuses_stages(spark, tmp):
    from blogscope.plans import batch_job
    out = os.path.join(tmp, "run")
    written = batch_job.run(spark, "/root/testdata/sf0.001", out, methods=("tfidf",))
    assert set(written) == {"tfidf_category_scores", "tfidf_category_specificity",
                            "tfidf_subcategory_scores", "tfidf_subcategory_specificity"}
    r = spark.read.parquet(written["tfidf_category_specificity"])
    assert r.count() > 0 and "Everyone" not in [x.demographic for x in r.select("demographic").distinct().collect()]
    before = [os.path.getmtime(p) for p in glob.glob(os.path.join(out, "blogs_en-*", "_SUCCESS"))]
    batch_job.run(spark, "/root/testdata/sf0.001", out, methods=("tfidf",))
    assert [os.path.getmtime(p) for p in glob.glob(os.path.join(out, "blogs_en-*", "_SUCCESS"))] == before


def test_text_tables_are_dealt_out_only_on_request(spark):
    plain = tables.read_table(spark, "/root/testdata/sf0.001", "documents")
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(tables.DEAL_SETTING, "6")
    try:
        dealt = tables.read_table(spark, "/root/testdata/sf0.001", "documents")
        assert dealt.rdd.getNumPartitions() == 6 and dealt.count() == plain.count()
    finally:
        spark.conf.unset(tables.DEAL_SETTING)


def test_cached_stage_depends_on_its_key(spark, tmp):
    got = [tables.cached_stage(spark, tmp + "/s", lambda n=n: spark.range(n), key=("in", n)).count() for n in (3, 5, 3)]
    assert got == [3, 5, 3]


def test_stages_are_dropped(spark):
    from blogscope.session import drop_stages, materialize
    drop_stages(spark)
    m = materialize(spark.range(5), "gone")
    path = m.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(path) and drop_stages(spark) == 1 and not os.path.exists(path)


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    from blogscope.session import checkpoint_dir
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        checkpoint_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=context))


def test_materialize_reads_back_same_rows(spark):
    from blogscope.session import materialize
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    m = materialize(df, "t")
    assert sorted(tuple(r) for r in m.collect()) == sorted(tuple(r) for r in df.collect())
    assert "Range" not in m._jdf.queryExecution().executedPlan().toString()


def test_word_vector_file_and_second_lookup(spark, tmp):
    with open(os.path.join(tmp, "v.txt"), "w") as f:
        f.write("river 0.5 1\nParis 2 3\nbad 1\nworse 1 x\n")
    vecs = tables.read_word_vectors(spark, os.path.join(tmp, "v.txt"), 2)
    assert {r["word"]: list(r["vec"]) for r in vecs.collect()} == {"river": [0.5, 1.0], "Paris": [2.0, 3.0]}
    df = spark.createDataFrame([("river", "River"), ("paris", "Paris"), ("none", "None")], "word string, original string")
    assert {r["word"] for r in taxonomy.lookup_vectors(df, vecs).collect()} == {"river"}
    got = taxonomy.lookup_vectors(df, vecs, original_col="original")
    assert got.columns == ["word", "original", "vec"] and {r["word"] for r in got.collect()} == {"river", "paris"}


def test_a_taxonomy_file_needs_rows(spark):
    lines = spark.createDataFrame([(0, "a\tb"), (1, "c\td")], "line_no int, value string")
    with pytest.raises(ValueError):
        taxonomy.parse_taxonomy_tsv(lines)


def test_files_of_a_folder_are_listed(spark, tmp):
    for name, body in (("12.male.25.Arts.Leo.xml", b"<Blog><date>1,may,2004</date><post>fine</post></Blog>"),
                       ("13.female.17.indUnk.Virgo.xml", b"\xff\xfe broken")):
        with open(f"{tmp}/{name}", "wb") as f:
            f.write(body)
    got = blogfiles.list_files(spark, tmp)
    assert got.count() == 2
    bodies = got.select("path", F.col("content").cast("string").alias("body"))
    assert [r["content"] for r in blogfiles.posts_from_text(bodies, "path", "body").collect()] == ["fine"]
