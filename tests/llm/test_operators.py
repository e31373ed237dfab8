"""The training-data operators against brute force, on ordinary and awkward small tables."""

import collections
import hashlib
import itertools
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from blogscope.llm import common, decontaminate, ftrl, jaccard, langid, lm, neighbours, packing, pii, quality, toxicity
from blogscope.llm.token_counts import UnitCounter, token_counts

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, bucket int, words string, "
          "slot long, label int, score double")
RNG = random.Random(5)
VOCAB = ["alpha", "beta", "gamma", "delta", "the", "of", "and", "river", "stone", "cloud", "x", "walks", "sees"]


def sentence(n, rng=RNG):
    return " ".join(rng.choice(VOCAB) + rng.choice(["", "", "", ",", "s"]) for _ in range(n)) + "."


BASE = sentence(60)
ROWS = [
    (1, BASE), (2, None), (3, ""), (4, " \t\n "), (5, BASE), (6, BASE.replace("river", "brook", 1)), (6, BASE.replace("river", "brook", 1)),
    (None, BASE), (None, None), (7, sentence(3)), (8, "one two"), (9, "one two"), (10, sentence(6000)),
    (11, "naïve Été 日本語 🙂 ΑΣ İ <|endoftext|> <s> ▁ ▁▁ a  b \u0000   \x1c"), (12, "!!! 12345 ???"),
    (13, "mail a.b@c.example.com, +1 (243) 555-5526, ip 10.0.0.255 or 10.0.0.256, card 4111 1111 1111 1111 x"),
    (14, "word " * 40), (15, "x" * 5000), (2**53 + 1, sentence(20)),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "en" if t and "the" in t else None, None, 0, "k", 1, "w", 7, 3, 0.5) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def labels_of(spark, rows=((1, 1), (5, 1), (7, 0), (8, 0), (12, 0), (13, 1), (None, 1), (14, None))):
    return spark.createDataFrame(list(rows), "doc_id long, label int")


def same_ids(df, rows=ROWS):
    assert collections.Counter(r["doc_id"] for r in df.collect()) == collections.Counter(i for i, _ in rows)


# --- 3: token counts ----------------------------------------------------------------


def test_token_counts_equal_the_library(spark, docs, empty):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=common.tokenizer_path("piece_bpe_32k.model"))
    want = collections.Counter((i, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4096) for i, t in ROWS)
    assert collections.Counter(tuple(r) for r in token_counts(docs).collect()) == want
    assert token_counts(empty).count() == 0


@pytest.fixture(scope="module")
def counter():
    return UnitCounter(common.tokenizer_path("piece_bpe_32k.model"), memo_units=100)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab  ▁\n.é日1<s>", max_size=30))
def test_units_equal_the_library(counter, text):
    assert counter.counts([text]) == [len(counter.sp.encode(text))]


# --- 8: packing ---------------------------------------------------------------------


def brute_ids(text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(common.tokenizer_path("word_bpe_49k.json"))
    return t.encode(text or "", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("length", [16, 4096])
def test_packing_round_trip(spark, docs, empty, length):
    got = packing.pack(docs.repartition(3), length=length, with_ids=True).collect()
    assert packing.pack(empty).count() == 0
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] > 0
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= length
    want = collections.defaultdict(list)
    for i, t in ROWS:
        want[i] += brute_ids(t)
    assert {i: sorted(want[i]) for i in want} == {i: sorted(x for r in own for x in r["ids"]) for i, own in pieces.items()}
    for i, t in ROWS:
        if sum(i == j for j, _ in ROWS) == 1:
            assert [x for r in sorted(pieces[i], key=lambda r: r["start"]) for x in r["ids"]] == brute_ids(t)
            assert {r["doc_tokens"] for r in pieces[i]} == {len(brute_ids(t))}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.sampled_from([0, 16])), min_size=1, max_size=9))
def test_windows_cost_no_more_than_any_other(steps):
    length = 32
    pos = list(itertools.accumulate(s for s, _ in steps))
    pen = [p for _, p in steps[:-1]] + [0]

    def cost(cuts):
        total, low = 0, 0
        for k in cuts:
            n = pos[k] - low
            if n > length:
                return math.inf
            total += (0 if n == length or (n & (n - 1) == 0 and n >= 16) else length - n) + pen[k] + packing.EACH
            low = pos[k]
        return total

    last = len(pos) - 1
    best = min(cost([*c, last]) for r in range(last + 1) for c in itertools.combinations(range(last), r))
    chosen = packing.choose_windows(pos, pen, length)
    assert cost([pos.index(p) for p in chosen]) == best


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB'sdÉſıİ½²_ .\n! 日<|", max_size=25))
def test_word_encoder_equals_the_library(encoder, text):
    got = np.frombuffer(encoder.encode([text])[0], "<u4").tolist()
    assert got == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return packing.WordEncoder(common.tokenizer_path("word_bpe_49k.json"))


# --- 10: personal data --------------------------------------------------------------

PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
         ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: pii.valid_card(s)),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= sum(c.isdigit() for c in s) <= 15)]


def brute_spans(text):
    return [[m.span() for m in re.finditer(p, text, re.ASCII) if ok(m.group())] for _, p, ok in PLAIN]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1204.@+- ()é\n", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == brute_spans(text)


def test_luhn_and_long_runs():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    for text in ("a" * 200_000, "1" * 200_000, "+1" * 50_000, "@" * 100_000, "1." * 100_000):
        pii.base_spans(text)


def test_personal_data_rows(spark, docs, empty):
    tagger = pii.fit_tagger(docs)
    for t in (None, tagger):
        got = pii.personal_data(docs, t)
        same_ids(got)
        for r, (i, text) in zip(sorted(got.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"])),
                                sorted(ROWS, key=lambda r: (r[0] is None, r[0]))):
            if sum(i == j for j, _ in ROWS) > 1:
                continue
            base = brute_spans(text or "")
            assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == list(map(len, base))
            assert r["base_sha256"] == hashlib.sha256(pii.span_text(base).encode()).hexdigest()
            assert set(filter(None, pii.span_text(base).split(","))) <= set(r["spans"].split(","))
    assert pii.personal_data(empty, pii.fit_tagger(empty)).count() == 0
    clean = pii.redact(docs, tagger)
    assert clean.columns == docs.columns
    one = clean.where("doc_id = 13").first()
    assert one["text"] == "mail <email>, <phone>, ip <ip> or 10.0.0.256, card <card> x" and one["n_chars"] == len(one["text"])
    assert pii.redact_text("abcdef", [[(1, 3)], [(2, 5)], [], []]) == "a<email>f"


def test_tagger_gradient_and_windows():
    t, rng = pii.Tagger(3, seed=7), np.random.default_rng(0)
    x, y = rng.integers(40, 60, (9, 4)), np.zeros((9, 4), int)
    y[2:5, 1], y[3:8, 2] = 2, 4
    _, g = t.loss(x, y)
    for name in t.NAMES:
        p = getattr(t, name)
        for _ in range(3):
            at = tuple(rng.integers(0, s) for s in p.shape)
            if name == "x":
                at = (at[0], at[1], int(x[0, 0]))
            if name == "trans" and t.forbidden[at]:
                continue
            old = p[at]
            p[at] = old + 1e-5
            up = t.loss(x, y)[0]
            p[at] = old - 1e-5
            down = t.loss(x, y)[0]
            p[at] = old
            assert abs((up - down) / 2e-5 - g[name][at]) < 1e-6
    texts = [("see 4111 1111 1111 1111 and x@y.example.com now " + "word " * 30) for _ in range(40)]
    xs, ys = pii.training_windows(texts)
    t = pii.Tagger().fit(xs, ys, steps=60)
    stream = pii.codes("word " * 300 + texts[0])
    tags = t.tag(stream)
    assert len(tags) == len(stream)
    one = t.decode(np.ascontiguousarray(np.zeros((5, 1), np.uint8)))
    assert one.shape == (5, 1)


# --- 9: n-gram Jaccard join ---------------------------------------------------------


def brute_components(rows, size=4, percent=85):
    sets = {}
    for i, t in rows:
        w = re.split(r"[\x20\x09-\x0D]+", (t or "").translate({k: k + 32 for k in range(65, 91)}))
        w = [x for x in w if x]
        sets.setdefault(i, set()).update([tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))] if w else [])
    ids = [i for i in sets if i is not None]
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def families(seed, groups=12, most=14):
    rng, rows, n = random.Random(seed), [], 0
    passage = sentence(25, rng)
    for _ in range(groups):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([5, 12, 60, 150]))] + (passage.split() if rng.random() < 0.5 else [])
        for _ in range(rng.randrange(1, most)):
            own = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                own[rng.randrange(len(own))] = f"e{rng.randrange(10 ** 6)}"
            if rng.random() < 0.2:
                own = own[:-max(1, len(own) // 12)]
            rows.append((n, " ".join(own)))
            n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [ROWS, families(1), families(2, 25, 8), [(k, "same text here now again") for k in range(40)]])
def test_similarity_components_equal_brute_force(spark, rows):
    got = jaccard.similarity_components(frame(spark, rows).repartition(4))
    same_ids(got, rows)
    want = brute_components(rows)
    for r in got.collect():
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
    for words, percent in ((4, 85), (5, 80)):
        want = brute_components(rows, words, percent)
        kept = jaccard.keep_one(frame(spark, rows), words, percent)
        assert kept.columns == frame(spark, rows).columns
        assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted({c for _, c in want.values()})


def test_removals_tell_texts_apart_that_share_an_id(spark):
    fine, other, bench = sentence(30), " ".join(f"q{k}" for k in range(40)), " ".join(f"b{k}" for k in range(12))
    rows = [(1, fine), (2, fine), (2, other), (2, other), (3, bench), (3, "clean " + other), (None, fine), (None, bench), (4, ""), (5, None)]
    docs = frame(spark, rows).withColumn("own_hash", F.lit(1)).withColumn("own_number", F.lit(2)).withColumn("gone_id", F.lit(3))
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(
        [(1, fine), (2, other), (3, bench), (None, fine), (None, bench), (4, ""), (5, None)], key=repr)
    items = spark.createDataFrame([(1, bench)], "item_id long, text string")
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=repr) == sorted([r for r in rows if r[1] != bench], key=repr)


def test_similarity_of_an_empty_table(empty):
    assert jaccard.similarity_components(empty).count() == 0 and jaccard.keep_one(empty).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=20), min_size=1, max_size=12), st.sets(st.integers(0, 25), min_size=1, max_size=20),
       st.sampled_from([50, 85, 100]))
def test_prefix_tree_finds_the_similar_sets(sets, probe, percent):
    tree = jaccard.PrefixTree([np.array(sorted(s), np.uint64) for s in sets])
    got = sorted(tree.similar(np.array(sorted(probe), np.uint64), percent))
    assert got == [k for k, s in enumerate(sets) if 100 * len(s & probe) >= percent * len(s | probe)]


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in jaccard.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}}
    assert jaccard.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 2: decontamination -------------------------------------------------------------

ITEMS = [(1, " ".join(BASE.split()[5:40])), (2, "One, TWO!"), (3, None), (4, "!!"), (5, "one two"), (6, " ".join(BASE.split()[20:30])), (None, "x y"), (1, "word")]


def brute_contamination(rows, items, window=10):
    def words_of(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({k: k + 32 for k in range(65, 91)}))
    out = []
    for i, t in rows:
        w, hit, found = words_of(t), set(), set()
        for item, raw in items:
            own = words_of(raw)
            for k in range(max(1, len(own) - window + 1) if own and item is not None else 0):
                part = own[k:k + window]
                for s in range(len(w) - len(part) + 1):
                    if w[s:s + len(part)] == part:
                        hit.update(range(s, s + len(part)))
                        found.add(str(item))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_contamination_equals_brute_force(spark, docs, empty, block_bytes):
    rows = [(i, t if t is None or len(t) < 3000 else t[:3000]) for i, t in ROWS]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination(frame(spark, rows), items, block_bytes=block_bytes)
    assert collections.Counter(tuple(r) for r in got.collect()) == collections.Counter(brute_contamination(rows, ITEMS))
    assert decontaminate.contamination(empty, items, block_bytes=block_bytes).count() == 0
    assert not decontaminate.contamination(docs, items.limit(0)).where("contaminated").count()
    kept = decontaminate.drop_contaminated(frame(spark, rows), items)
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == sorted(r[0] for r in brute_contamination(rows, ITEMS) if r[0] and not r[5])


def test_benchmark_blocks_are_taken_one_at_a_time(spark, monkeypatch):
    log, blocks, stage = [], decontaminate.item_blocks, decontaminate.stage
    items = spark.createDataFrame([(k, f"item {k} " + sentence(12)) for k in range(5)], "item_id long, text string")

    def logged(*args):
        for b in blocks(*args):
            log.append("block")
            yield b

    monkeypatch.setattr(decontaminate, "item_blocks", logged)
    monkeypatch.setattr(decontaminate, "stage", lambda df, name: (stage(df, name), log.append(name))[0])
    got = decontaminate.contamination(frame(spark, [(r["item_id"], r["text"]) for r in items.collect()]), items, block_bytes=1)
    assert got.where("contaminated").count() == 5
    taken = [k for k, x in enumerate(log) if x == "block"]
    written = [k for k, x in enumerate(log) if x == "matches"]
    # two blocks tell that there are several; from then on one is written before another is taken
    assert len(taken) == len(written) == 5 and all(w < t for w, t in zip(written[1:], taken[2:]))


def test_proximity_matches(spark):
    test = decontaminate.TestSet([("q", b"red green blue")])
    docs = frame(spark, [(1, "red green blue"), (2, "red very green blue"), (3, "red a b c d green blue"), (4, "red green")])
    index = decontaminate.store_index(docs, test)
    assert {r["doc_id"] for r in decontaminate.phrase_matches(index, test).collect()} == {1}
    near = {r["doc_id"] for r in decontaminate.phrase_matches(index, test, slack=1).collect()}
    assert near >= {1, 2} and not near & {3, 4}
    with pytest.raises(ValueError):
        decontaminate.phrase_matches(index, test, slack=100)


# --- 1: language-model scores -------------------------------------------------------


def test_lm_scores(spark, docs, empty):
    held = common.fold(7) == 2
    got = lm.lm_scores(docs, held, ~common.fold(7).isin(2, -1)).collect()
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(i for i, _ in ROWS)
    is_held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in ROWS}
    count = collections.Counter()
    for i, t in ROWS:
        if i is not None and not is_held[i]:
            count.update(lm.tokens((t or "").encode()) + ["end"])
    total = sum(count.values())
    by_id = {i: t for i, t in ROWS}
    for r in got:
        if r["doc_id"] is None:
            continue
        w = lm.tokens((by_id[r["doc_id"]] or "").encode()) + ["end"]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (is_held[r["doc_id"]], len(w), sum(count[x] > 0 for x in w), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[x] + 1) / (total + len(count) + 1)) for x in w))
        assert math.isfinite(r["score"]) and r["score"] < 0
    assert lm.lm_scores(empty, held, ~held).count() == 0
    assert lm.lm_scores(docs, F.lit(True), F.lit(False)).where("n_known > 0 or train_tokens > 0").count() == 0


def test_attention_model_is_a_distribution_and_its_windows_agree():
    rng = np.random.default_rng(0)
    pieces = [rng.integers(3, 60, n) for n in (0, 1, 15, 16, 17, 40, 100)] + [np.tile([5, 6, 7, 8], 50) for _ in range(30)]
    m = lm.AttentionModel(60)
    first = m.fit(pieces, epochs=6)
    assert first[-1] < first[0]
    x, y, real, begins, _ = lm.blocks_of(pieces[:4])
    m.emb, m.wq = m.emb.astype(np.float64), m.wq.astype(np.float64)
    loss, g, rows = m.step(x, y, real, begins)
    for name, at in (("wq", (1, 2)), ("wc", (3, 4)), ("dist", (3,)), ("wk", (0, 5)), ("wv", (2, 2))):
        p = getattr(m, name)
        p = p.astype(np.float64)
        setattr(m, name, p)
        old = p[at]
        p[at] = old + 1e-4
        up = m.step(x, y, real, begins)[0]
        p[at] = old - 1e-4
        down = m.step(x, y, real, begins)[0]
        p[at] = old
        assert (up - down) / 2e-4 == pytest.approx(g[name][at], abs=2e-4)
    m = lm.AttentionModel(60)
    m.fit(pieces, epochs=1)
    m.finish(rng.integers(0, 9, (lm.CLASSES + 1, 60)).astype(float))
    for k in (0, 5, lm.CLASSES):
        assert np.bincount(m.class_of, np.exp(m.logp_id[k]), lm.CLASSES)[np.unique(m.class_of)] == pytest.approx(1.0, abs=1e-4)
    sizes, shares = [np.ones(len(p) + 1, int) for p in pieces], [np.zeros(len(p) + 1) for p in pieces]
    together = m.score(pieces, sizes, shares, 0.1)
    assert together == pytest.approx([m.score([p], [s], [c], 0.1)[0] for p, s, c in zip(pieces, sizes, shares)], rel=1e-4)
    assert together == pytest.approx(m.score(pieces, sizes, shares, 0.1, group=3), rel=1e-4)


def test_a_step_leaves_no_tiny_numbers_where_a_key_is_hidden():
    """Ids behind the last target get zeros, not numbers below the normal floats (slow in products)."""
    m = lm.AttentionModel(60)
    x, y = np.arange(3, 3 + 2 * lm.BLOCK).reshape(2, lm.BLOCK), np.full((2, lm.BLOCK), 5)
    real = np.zeros(x.shape, bool)
    real[0], real[1, :4] = True, True
    _, g, rows = m.step(x, y, real, np.array([True, False]))
    assert rows.tolist() == x.ravel().tolist()
    own = np.abs(g["emb"])
    assert (own[:lm.BLOCK + 4] > 0).any(axis=1).all()
    assert (own[lm.BLOCK + 4:] == 0).all()


def test_steps_do_not_depend_on_the_rows_taken_at_a_time(monkeypatch):
    rng = np.random.default_rng(6)
    m = lm.AttentionModel(60)
    m.class_of = rng.integers(0, lm.CLASSES, 60)
    x, y, real, first, _ = lm.blocks_of([rng.integers(3, 60, n) for n in (70, 0, 33, 16, 100)])
    loss, g, rows = m.step(x, y, real, first)
    for size in (1, 3, len(x) - 1):
        monkeypatch.setattr(lm, "STEP_ROWS", size)
        other, h, same = m.step(x, y, real, first)
        assert other == pytest.approx(loss, rel=1e-5) and (same == rows).all()
        for k in lm.AttentionModel.NAMES:
            assert h[k] == pytest.approx(g[k], abs=1e-6)


def test_probabilities_of_all_next_ids_sum_to_one():
    rng = np.random.default_rng(1)
    begins = np.arange(60) % 3 == 0
    pieces = [rng.integers(3, 60, 70) for _ in range(40)]
    m = lm.AttentionModel(60, begins)
    m.fit(pieces, epochs=2)
    assert not set(m.class_of[m.begins]) & set(m.class_of[~m.begins])
    m.finish(rng.integers(0, 9, (lm.CLASSES + 1, 60)).astype(float))
    for at in (0, 1, 15, 16, 17, 40, 69):
        before = pieces[0][:at]
        others = [i for i in range(60) if i != lm.END]
        rows, offsets = m.id_scores([np.append(before, i) for i in others] + [before])
        flat = rows.reshape(-1)
        total = sum(math.exp(flat[o * lm.BLOCK + at]) for o in offsets[:-1])
        assert total == pytest.approx(1.0, abs=1e-4)


def test_word_scores_mix_ids_and_shares():
    rng = np.random.default_rng(2)
    m = lm.AttentionModel(60, np.arange(60) % 2 == 0)
    m.finish(rng.integers(0, 9, (lm.CLASSES + 1, 60)).astype(float))
    pieces, sizes = np.array([4, 5, 7, 8, 10, 11]), np.array([3, 0, 1, 2, 1])
    shares = np.array([0.1, 0.0, 0.02, 0.0, 0.3])
    rows, _ = m.id_scores([pieces])
    ids = rows.reshape(-1)[:7].astype(float)
    parts = [ids[:3].sum(), math.log(0.01), ids[3], ids[4:6].sum(), ids[6]]
    want = sum(math.log10(lm.MIX * c + (1 - lm.MIX) * math.exp(p)) for c, p in zip(shares, parts))
    assert m.score([pieces], [sizes], [shares], 0.01)[0] == pytest.approx(want)


def test_classes_and_attention_layer_learn_from_every_training_document(spark, monkeypatch):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=common.tokenizer_path(lm.MODEL))
    size = sp.get_piece_size()
    words = [p[1:] for p in map(sp.id_to_piece, range(size)) if p[0] == "\u2581" and p[1:].isascii() and p[1:].islower() and p[1:].isalpha()]
    own = [w for w in words if len(sp.encode(w)) == 1][:1500]  # a text of a word that no other has
    docs = spark.createDataFrame([(k, f"{w} {w} {w}") for k, w in enumerate(own)], "doc_id long, text string").repartition(8)
    seen = []
    finish = lm.AttentionModel.finish
    monkeypatch.setattr(lm.AttentionModel, "finish", lambda self, counts: seen.append(self) or finish(self, counts))
    monkeypatch.setattr(lm, "FIRST_IDS", 2000, raising=False)  # several rounds and units
    monkeypatch.setattr(lm, "UNIT_IDS", 1000, raising=False)
    assert lm.lm_scores(docs, F.lit(False), F.lit(True)).where("score < 0").count() == len(own) == 1500
    model, ids = seen[0], [sp.encode(w)[0] for w in own]
    before = lm.AttentionModel(size, model.begins)
    assert (model.emb[ids] != before.emb[ids]).any(axis=1).all()
    unused = np.setdiff1d(np.arange(size), [*ids, lm.BEGIN, lm.END, 0])
    assert (model.emb[unused] == before.emb[unused]).all()
    assert len(np.unique(model.class_of[ids])) > 1


def test_rounds_hold_every_chunk_once():
    for n in (1, lm.FIRST_IDS, lm.FIRST_IDS + 1, 20 * lm.FIRST_IDS, 3000 * lm.FIRST_IDS):
        plan = lm.rounds_of(n)
        assert plan[0][0] == 0 and plan[-1][1] == 1 and all(a[1] == b[0] for a, b in zip(plan, plan[1:]))
        assert all(lo < hi and epochs >= 1 for lo, hi, epochs in plan)


def test_sums_of_replicas_weigh_every_unit():
    rng = np.random.default_rng(4)
    texts = [np.append(rng.integers(3, 60, 40), lm.END).astype(np.uint16) for _ in range(30)]
    model = lm.AttentionModel(60)
    got = lm.replicas(iter(texts), model, 100, 1, lm.RATE, lm.RATE / 10)
    uses = np.bincount(np.concatenate(texts), minlength=60)
    uses[lm.BEGIN] = uses[lm.END]
    assert got[-61:-1] == pytest.approx(uses) and got[-1] == 30 * 41
    stream = np.concatenate(texts)
    for cut in (stream, stream[:-7]):  # the last text may be cut
        assert lm.text_sizes(cut).sum() == len(cut)
    counts = lm.context_uses(stream, model.class_of, model.begins)
    assert counts.reshape(-1, 60).sum(axis=0) == pytest.approx(np.bincount(stream, minlength=60))


# --- 4, 5, 7: classifiers -----------------------------------------------------------


def sf(name):
    return os.path.join("/root/testdata", name)


def held_out_accuracy(spark, got, truth, column):
    j = got.where("held_out").join(truth, "doc_id").where(f"{column} is not null")
    return j.select(F.avg((F.col("predicted") == F.col(column)).cast("double"))).first()[0]


def test_language(spark, docs, empty):
    held = common.fold(4) == 2
    got = langid.language(docs, langid.fit_language(docs, held), held)
    same_ids(got)
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (2, 3, 4, 12))
    assert all(r["lang_pred"] in ("en", "und") and 0 <= r["score"] <= 1 for r in by_id.values())
    assert langid.language(empty, langid.fit_language(empty, held), held).count() == 0
    d = spark.read.parquet(sf("sf0.01") + "/documents.parquet")
    j = langid.language(d, langid.fit_language(d, held), held).where("held_out").join(d, "doc_id")
    assert j.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.98


def test_a_text_without_letters_has_no_language():
    m = langid.LanguageModel(["en", "fr"], np.ones(1 << langid.BITS))
    for text in ("", " \n", "½ ② ² Ⅷ 12 _!", "🙂 ٣"):
        assert m.predict(text) == ("und", 0.0)
    for text in ("a", "12 é", "日", "ª"):
        assert m.predict(text)[0] in ("en", "fr")


def test_language_scores_equal_a_naive_softmax():
    """One text's score from the weights, one n-gram at a time."""
    rng = np.random.default_rng(4)
    m = langid.LanguageModel(["en", "fr", "de"], rng.uniform(1, 3, 1 << langid.BITS))
    m.w = rng.standard_normal(m.w.shape)
    m.temperature = 1.7
    for text in ("The river", "a", "Été, l'été 日本"):
        at, x = langid.vector(text, m.idf)
        z = [m.w[-1][k] + sum(float(v) * m.w[int(b)][k] for b, v in zip(at, x)) for k in range(3)]
        e = [math.exp(v / m.temperature) for v in z]
        best = max(range(3), key=e.__getitem__)
        assert m.predict(text) == (m.languages[best], pytest.approx(e[best] / sum(e)))


def test_rare_languages_are_learned_from_a_bounded_sample(spark):
    rng = random.Random(4)
    words = {"en": VOCAB, "es": ["uno", "dos", "casa", "perro", "jugo"], "xx": ["жук", "дом", "лес", "мир"]}
    rows = [(k, "xx" if k % 500 == 7 else "es" if k % 100 == 3 else "en") for k in range(2000)]
    rows = [(k, x, " ".join(rng.choice(words[x]) for _ in range(30))) for k, x in rows]
    d = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    held = F.col("doc_id") % 7 == 6
    train = d.where(~held)
    ids = train.select("doc_id", F.col("lang").alias("label"))
    sample = common.bounded_sample(train, ids, 60, 1 << 20, quota=8)
    n = collections.Counter(y for _, y in sample)
    assert len(sample) == 60 and n["xx"] == 3 and n["es"] >= 8
    assert sorted(y for _, y in common.bounded_sample(train, ids, 2, 1, quota=8)) == ["en", "es", "xx"]
    model = langid.fit_language(d, held, max_rows=60)
    assert model.languages == ["en", "es", "xx"]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.language(d, model, held).collect()}
    assert all(got[k] == x for k, x, _ in rows)


def test_quality(spark, docs, empty):
    held = common.fold(4) == 2
    got = quality.quality(docs, labels_of(spark), held)
    same_ids(got)
    for r in got.collect():
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    assert quality.quality(empty, labels_of(spark), held).count() == 0
    assert {r["score"] for r in quality.quality(docs, labels_of(spark).limit(0), held).collect()} == {0.5}
    d, lab = (spark.read.parquet(f"{sf('sf0.01')}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality(d, lab.select("doc_id", F.col("quality").alias("label")), held)
    assert held_out_accuracy(spark, got, lab, "quality") > 0.94


def test_toxicity(spark, docs, empty):
    held = common.fold(3) == 1
    model = toxicity.fit_toxicity(docs, labels_of(spark), held)
    got = toxicity.toxicity(docs, model, held)
    same_ids(got)
    for r in got.collect():
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    assert toxicity.toxicity(empty, toxicity.fit_toxicity(empty, labels_of(spark), held), held).count() == 0
    d, lab = (spark.read.parquet(f"{sf('sf0.01')}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_toxicity(d, lab.select("doc_id", F.col("toxic").alias("label")), held)
    assert held_out_accuracy(spark, toxicity.toxicity(d, model, held), lab, "toxic") > 0.9
    kept = toxicity.drop_toxic(d, model)
    assert kept.schema == d.schema and kept.count() == toxicity.toxicity(d, model, held).where("predicted = 0").count()


def test_toxic_thresholds_and_languages_see_all_labelled_rows(spark):
    rng = random.Random(9)
    rows = [(k, "en", " ".join(rng.choice(VOCAB) for _ in range(20)) + (" idiot" if k % 2 else ""), k % 2) for k in range(300)]
    odd = ["uno", "dos", "tres", "casa", "perro"]
    rows += [(k, "es", " ".join(rng.choice(odd) for _ in range(20)) + (" tonto" if k % 2 else ""), k % 2) for k in range(300, 330)]
    d = spark.createDataFrame([(i, x, t) for i, x, t, _ in rows], "doc_id long, lang string, text string")
    lab = spark.createDataFrame([(i, y) for i, _, _, y in rows], "doc_id long, label int")
    held = F.col("doc_id") < 0
    # the sample holds no text of the rare language
    order = [r["doc_id"] for r in d.orderBy(F.xxhash64("doc_id", F.lit(17))).collect()]
    size = min(k for k, i in enumerate(order) if i >= 300)
    model = toxicity.fit_toxicity(d, lab, held, max_rows=size)
    assert model.languages == ["en", "es"]
    z, guess = model.logits([t.encode() for _, _, t, _ in rows])
    assert [model.languages[g] for g in guess] == [x for _, x, _, _ in rows]
    y = np.array([r[3] for r in rows])
    for k in (0, 1):  # no cut of the language's rows errs less than its threshold
        own = guess == k
        binned = np.rint(z[own] * toxicity.BINS) / toxicity.BINS
        wrong = ((binned >= model.shift[k]) != y[own]).sum()
        assert wrong == min(((binned >= c) != y[own]).sum() for c in [*binned, np.inf])
    assert model.shift[0] != model.shift[1]


def test_pooling_keeps_the_two_largest():
    m = toxicity.ToxicModel()
    rng = np.random.default_rng(1)
    x, offsets = rng.standard_normal((40, m.columns)).astype(np.float32), np.array([0, 3, 20, 40])
    x[5] = x[9]
    got = m.pooled(x.copy(), offsets)
    places, _ = m.pooled_places(x.copy(), offsets)
    assert np.allclose(got, places)
    assert toxicity.best_cut(np.array([0.0, 1.0, 5.0, 6.0]), np.array([0, 0, 1, 1])) == 3.0


def test_ftrl_learns_and_stays_sparse():
    rng = np.random.default_rng(0)
    rows = [(np.array([0 if y else 1, 2 + k % 50]), np.ones(2), float(y)) for k, y in enumerate(rng.integers(0, 2, 400))]
    w = ftrl.Ftrl(60, l1=1.0).fit(rows, 2).weights()[:, 0]
    assert w[0] > 0.5 and w[1] < -0.5 and (w[2:52] == 0).sum() > 30


# --- 6: nearest neighbours ----------------------------------------------------------


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.standard_normal(8).tolist()) for k in range(300)]
    rows += [(300 + k, rows[7][1]) for k in range(9)] + [(400, None), (401, [0.0] * 8), (402, [1.0, None] + [0.0] * 6),
                                                         (403, [float("nan")] * 8), (404, [float("inf")] * 8), (405, []), (None, [1.0] * 8),
                                                         (500, [1.0, 2.0]), (501, [2.0, 1.0]), (350, [float(x) for x in range(8)])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, shard int")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, df.where("vec_id % 50 = 0")).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    fine = {i: np.array(v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    hits = total = 0
    assert set(got) == {i for i in fine if i % 50 == 0}
    for q, own in got.items():
        truth = sorted((-float(v @ fine[q] / math.sqrt((v @ v) * (fine[q] @ fine[q]))), i) for i, v in fine.items() if i != q and len(v) == len(fine[q]))
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, len(own) + 1))
        assert [(-s, i) for _, i, s in own] == sorted((-s, i) for _, i, s in own)
        for _, i, s in own:
            assert s == pytest.approx(float(fine[i] @ fine[q] / math.sqrt((fine[i] @ fine[i]) * (fine[q] @ fine[q]))), abs=1e-12)
        hits += len({i for _, i in truth[:5]} & {i for _, i, _ in own})
        total += min(5, len(truth))
    assert hits / total >= 0.9
    assert neighbours.nearest(df.limit(0), df.limit(0)).count() == 0


def test_neighbour_blocks_are_bounded_by_the_rows_of_the_shard(monkeypatch):
    import pyarrow as pa
    v = np.random.default_rng(3).standard_normal((120, 8))
    batch = pa.RecordBatch.from_arrays([pa.array([0] * 120, pa.int32()), pa.array([i >= 100 for i in range(120)]), pa.array(range(120), pa.int64()),
                                        pa.array(v.tolist(), pa.list_(pa.float64()))], names=["shard", "is_query", "vec_id", "v"])

    def rows():
        return [tuple(r.values()) for b in neighbours.shard_answers(iter([batch]), 5, {}) for r in b.to_pylist()]

    whole, sizes, nearest = rows(), [], neighbours.Shard.nearest
    monkeypatch.setattr(neighbours, "BLOCK_PAIRS", 700, raising=False)
    monkeypatch.setattr(neighbours.Shard, "nearest", lambda self, ids, *a: (sizes.append(len(ids) * len(self.ids)), nearest(self, ids, *a))[1])
    assert rows() == whole and whole and max(sizes) <= 700


def test_only_candidates_are_multiplied():
    """Clustered vectors: few products per query, the nearest found nonetheless, and the
    candidates are those that a look-up of every vector's cell gives."""
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((40, 32))
    vectors = np.repeat(centres, 50, axis=0) + 0.1 * rng.standard_normal((2000, 32))
    ids = rng.permutation(2000).astype(np.int64)
    shard = neighbours.Shard(ids, vectors, neighbours.Hashes(32, tables=8, projections=6, probes=10))
    at = np.arange(0, 2000, 20)
    query_id, vec_id, score = shard.nearest(ids[at], vectors[at], 5)
    assert shard.products < 0.25 * len(at) * 2000
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    cosine = unit[at] @ unit.T
    cosine[np.arange(len(at)), at] = -2
    found = set(zip(query_id.tolist(), vec_id.tolist()))
    want = {(int(ids[q]), int(ids[v])) for q, row in zip(at, cosine) for v in np.argsort(-row)[:5]}
    assert len(found & want) >= 0.95 * len(want)
    place = {int(i): n for n, i in enumerate(ids)}
    assert all(abs(s - unit[place[q]] @ unit[place[v]]) < 1e-12 for q, v, s in zip(query_id.tolist(), vec_id.tolist(), score))
    query, vector = shard.candidates(unit[at[:7]])
    naive = {(q, v) for t in range(shard.hashes.tables) for q, probes in enumerate(shard.hashes.probe_keys(unit[at[:7]], t))
             for v in np.flatnonzero(np.isin(shard.hashes.keys(unit, t), probes))}
    assert set(zip(query.tolist(), vector.tolist())) == {(int(q), int(v)) for q, v in naive} and len(query) == len(naive)


@pytest.mark.parametrize("shards", [1, 3])
def test_neighbours_of_small_tables_and_outliers_are_whole(spark, monkeypatch, shards):
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(64)
    tight = centre + 0.05 * rng.standard_normal((40, 64))
    far = [*(-centre + 0.05 * rng.standard_normal((2, 64))), *rng.standard_normal((4, 64))]
    monkeypatch.setattr(neighbours, "SHARD_ROWS", -(-46 // shards))
    for vectors in (rng.standard_normal((6, 64)), rng.standard_normal((3, 64)), np.array([*tight, *far])):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
        got = collections.defaultdict(list)
        for r in neighbours.nearest(df, df).orderBy("query_id", "rank").collect():
            got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
        unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
        cosine = unit @ unit.T
        for q in range(len(vectors)):
            others = [i for i in range(len(vectors)) if i != q]
            assert [r for r, _, _ in got[q]] == list(range(1, min(5, len(others)) + 1))
            assert all(abs(s - cosine[q, i]) < 1e-9 for _, i, s in got[q])
        if len(vectors) == 46:  # no vector but its twin is near an opposite query
            for q in (40, 41):
                assert [i for _, i, _ in got[q]] == sorted((i for i in range(46) if i != q), key=lambda i: -cosine[q, i])[:5]


# --- the pipeline -------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(9)
    toxic = ["you idiot scum " + sentence(30, rng) + " moron trash" for _ in range(60)]
    fine = [" ".join(f"n{rng.randrange(3000)}" for _ in range(40)) + " " + sentence(20, rng) for _ in range(120)]
    bench = " ".join(f"b{k}" for k in range(30))
    extra = [fine[0], fine[1] + " end", bench + " " + fine[2][::-1], "write to a.b@c.example.com " + fine[3][::-1], None, ""]
    rows = [*enumerate(fine + toxic + extra), (None, "no id here"), (5, fine[5])]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(120 <= k < 180)) for k in range(180)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ids = []
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, common.stage(f(spark, docs, str(tmp_path)), "test-" + name)
        if name != "packing":
            assert docs.columns == before.columns
            ids.append(sorted(r["doc_id"] for r in docs.where("doc_id is not null").collect()))
    assert not set(range(120, 180)) & set(ids[0]) and set(range(120)) <= set(ids[0])
    assert set(ids[0]) - set(ids[1]) == {180, 181} and len(ids[1]) == len(set(ids[1]))
    assert set(ids[1]) - set(ids[2]) == {182} and ids[3] == ids[2]
    assert {r["doc_id"] for r in docs.collect() if r["doc_id"] is not None} == set(ids[3])
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == docs.columns


def test_removal_shuffles_only_rows_that_may_go(spark):
    docs = spark.createDataFrame([(i, f"text {i % 90}") for i in range(100)] + [(None, "text 1"), (5, None), (5, "other")], "doc_id long, text string")
    hashed = docs.withColumn("hash", common.text_hash())
    gone = hashed.where("doc_id % 10 = 5 or doc_id is null").select("doc_id", "hash")
    held, flag = common.maybe_in(hashed, ["doc_id", "hash"], gone, ["doc_id", "hash"])
    on = held.where(flag).count()
    assert held.where(flag).join(gone, ["doc_id", "hash"], "left_semi").count() == 12 and 13 <= on < 20
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = common.without(docs, gone, "test-removed")
        assert sorted(r["doc_id"] for r in left.where("doc_id is not null").collect()) == [i for i in range(100) if i % 10 != 5]
        assert [r["text"] for r in left.where("doc_id is null").collect()] == ["text 1"]  # a null id equals none
        assert left.columns == docs.columns
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert "Union" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" in plan  # rows without the bit pass beside the join
        assert common.without(docs, gone.limit(0), "test-removed").count() == docs.count()
        assert common.without(docs, gone.select("hash"), "test-removed").where("text = 'text 5' or text is null").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
