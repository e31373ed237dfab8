"""Texts in Arrow batches against the column expressions; what a pass of the topic model runs."""

import os
import random
import uuid

from pyspark.sql import functions as F

from blogscope.functions import text as tx
from blogscope.operators import language, terms, text_rows, topic_factors

BITS = ["the", "The", "and", "urlLink", "xurlLinky", "nbsp", "NBSP", "unbspbs", "Café", "für", "más", "être", "İstanbul", "Ⱥbc", "ΣΑΣ", "日本語", "½",
        "²x", "_a_", "a1b", ".", "!", "? ", ". ", ".\n", " \t", "\x0b", "…", "“quoted”", "don’t", "der", "die", "y", "el", "les", "et", "of", "to",
        "Beautiful", "mountains", "ªº", "\U0001F600", "ñ", "which", "are.", "is!", "\r\n", "&amp;"]


def _texts(n=1500, seed=1):
    rng = random.Random(seed)
    one = lambda k: "".join(rng.choice(BITS) + rng.choice(["", " ", " ", "  "]) for _ in range(k))
    return [(i, one(rng.choice([0, 1, 2, 3, 5, 9, 20, 60]))) for i in range(n)] + [(n, None), (n + 1, ""), (n + 2, "   ")]


def test_texts_equal_the_expressions(spark, monkeypatch):
    df = spark.createDataFrame(_texts(), "file_id long, content string").repartition(3)
    old = language.with_language(df, "content").where("content_language = 'en'").select(
        "file_id", terms.topic_tokens_of_clean(tx.clean_content("content")).alias("tokens"), terms.sentences("content").alias("sentences"))
    want = {r[0]: (r[1], r[2]) for r in old.collect()}
    assert len(want) > 300
    for size in (text_rows.PART_BYTES, 100):
        monkeypatch.setattr(text_rows, "PART_BYTES", size)
        assert {r[0]: (r[1], r[2]) for r in text_rows.texts_of(df, "content").collect()} == want
    assert text_rows.texts_of(df.limit(0), "content").count() == 0


def _plain_segments(sentences, tokens, least, window, step):
    clean = lambda t: [w.lower() for w in "".join(c if c.isascii() and c.isalpha() else " " for c in t).replace("urlLink", "").replace("nbsp", "").split(" ")
                       if len(w) >= 3 and w.lower() not in text_rows.STOP_WORDS]
    join = lambda x: " ".join(y for y in x if y is not None)
    s, t = sentences or [], tokens or []
    out = [g for g in (join(s[i:i + 3]) for i in range(0, len(s), 2)) if len(g.split()) >= least]
    if len(out) < 3:
        out += [join(t[i:i + window]) for i in range(0, len(t), step) if len(t[i:i + window]) >= least]
    return [clean(g) for g in out] if len(out) > 1 else []


def test_segments_equal_a_plain_version(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "of", "x", "gammanbsp", "NBSP", "delta9eps", None]
    many = lambda k: [rng.choice(words) for _ in range(k)]
    rows = [(i, [" ".join(w or "" for w in many(rng.randrange(7))) for _ in range(rng.randrange(9))], many(rng.randrange(60))) for i in range(60)]
    rows += [(None, ["one two three four five six", None, "", "  seven "], ["alpha"] * 9), (61, None, None), (62, [], None), (63, None, ["abc"] * 70)]
    df = spark.createDataFrame(rows, "doc_id long, sentences array<string>, tokens array<string>").repartition(2)
    for args in ((5, 30, 20), (2, 4, 3)):
        got = {}
        for r in text_rows.segments(df, *args).collect():
            got.setdefault(r.doc_id, []).append((r.seg_id, r.tokens))
        want = {d: list(enumerate(x)) for d, s, t in rows if (x := _plain_segments(s, t, *args))}
        assert {d: sorted(x) for d, x in got.items()} == want


def test_counts_in_the_row(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (None, ["a", None]), (2, []), (3, None)], "doc_id long, tokens array<string>")
    got = text_rows.token_counts(df, ["doc_id"], "tokens").collect()  # a row per segment, not per entry
    assert sorted(((r.doc_id, sorted(zip(r.terms, r.weights))) for r in got), key=str) == [(1, [("a", 1), ("b", 2)]), (None, [("a", 1)])]


def test_blocks_of_lists_equal_blocks_of_entries(spark):
    df = spark.createDataFrame([(d, s, [f"w{(d * s + j * j) % 7}" for j in range(d % 5)]) for d in range(30) for s in range(3)] + [(None, 0, ["w1", "w1"]), (3, 1, ["w9"])],
                               "doc_id long, seg_id int, tokens array<string>").repartition(3)
    lists = text_rows.token_counts(df, ["doc_id", "seg_id"], "tokens")
    long = terms.exploded_counts(df, ["doc_id", "seg_id"], "tokens").withColumn("weight", F.col("cnt").cast("double"))
    a, b = (topic_factors.fit(x, ["doc_id", "seg_id"], 2, passes=2) for x in (lists, long))
    a, b = ({r.term: r.lam for r in m.table.collect()} for m in (a, b))
    assert set(a) == set(b) and all(abs(x - y) < 1e-9 for t in a for x, y in zip(a[t], b[t]))


def test_a_pass_takes_the_variational_step_once_a_block(spark, tmp, monkeypatch):
    real = topic_factors.variational_step

    def counted(*args):
        open(f"{tmp}/{uuid.uuid4().hex}", "w").close()
        return real(*args)
    monkeypatch.setattr(topic_factors, "variational_step", counted)
    rows = spark.createDataFrame([(d, 0, f"w{d % 4}", 1.0) for d in range(9)], "doc_id long, seg_id int, term string, weight double").coalesce(1)
    topic_factors.fit(rows, ["doc_id", "seg_id"], 2, passes=3)
    blocks = topic_factors.term_blocks.build(rows, ["doc_id", "seg_id"]).rows.count()
    assert len(os.listdir(tmp)) == 3 * blocks
