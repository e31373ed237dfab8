"""The filter audit against applying every order of the filters document by document."""

import collections
import itertools
import math
import re

from pyspark.sql import functions as F

from blogscope.llm import filter_audit as fa

from .test_operators import BASE, ROWS, SCHEMA, sentence

LABELS = [(1, 1, 0), (5, 0, 1), (6, 1, 1), (6, None, 0), (7, 1, None), (None, 1, 1), (10, 1, 0), (12, 0, 1), (99, 1, 1), (20, 1, 0)]
MORE = [(20, sentence(400)), (21, " ".join(f"w{k}" for k in range(250))), (22, " ".join(f"w{k}" for k in range(250))),
        (23, "LOUD " * 300), (24, "a b c " * 100), (25, "\x1c\x1d " * 250), (26, "x#y " + "The " * 250)]


def fails(text, copied):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": copied}


def expected(rows, labels):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = collections.defaultdict(list)
    for i, t, lang in rows:
        parts[lang or ""].append((fails(t, i is not None and i > least[t or ""]), i in good, i in toxic))
    out = []
    for part, own in parts.items():
        shapley, report = collections.Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = list(own)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                shapley[f] += len(gone)
                report.append((part, "".join(order), step, len(left), len(gone), sum(d[0][f] for d in own) - len(gone),
                               sum(d[0][f] and sum(d[0].values()) == 1 for d in own), sum(d[1] for d in gone), sum(d[2] for d in gone), f))
        out += [(*r[:-1], shapley[r[-1]]) for r in report]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, 0, "k", 1, "w", 7, 3, 0.5) for i, t, lang in rows], SCHEMA)


def check(spark, rows, labels):
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("mask", F.lit(9))
    got = fa.filter_audit(table(spark, rows).repartition(3), marks)
    assert sorted(tuple(r) for r in got.collect()) == expected(rows, labels)


def test_audit(spark):
    rows = [(i, t, ("en", "de", None, "")[k % 4]) for k, (i, t) in enumerate(ROWS + MORE)]
    check(spark, rows, LABELS)
    check(spark, rows, [])
    check(spark, [(1, BASE, "en"), (1, BASE, "de"), (1, BASE, "en"), (2, BASE, "en"), (None, BASE, "en")], LABELS)
    check(spark, [(3, None, None), (2, "", "x"), (4, "", "x")], LABELS)
    check(spark, [], LABELS)


def test_intervals_cover_every_order_once():
    perms = list(itertools.permutations(range(5)))
    assert [fa.lehmer_rank(p, 5) for p in perms] == list(range(math.factorial(5)))
    seen = collections.Counter()
    for mask, step, f, lo, hi in fa.removal_intervals():
        for rank in range(lo, hi):
            assert perms[rank][step - 1] == f and mask >> f & 1 and not any(mask >> g & 1 for g in perms[rank][:step - 1])
            seen[mask, rank] += 1
    assert set(seen.values()) == {1} and len(seen) == 31 * 120
