"""Filter interaction audit (operator 13): what every order of some filters removes, and where.

All a document contributes is the set of filters that it fails, a mask; counts by (part,
mask) come from one pass. In every order, a mask is removed at its first failing filter.
Orders that share their first k letters lie next to each other in lexicographic order, so
"the letters before are not in the mask, letter k is" is an interval of ranks (Lehmer ranks:
a prefix of k letters covers (n - k)! ranks). The audit adds a mask's counts at the start of
each of its intervals, takes them off at the end, and sums along the ranks: all n! orders cost
32 masks' intervals and no row of the corpus.

The failing set comes from Spark's own functions, with one shuffle of (hash of the text,
smallest id) for the copies; no text is shuffled.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

LETTERS = "ABCDE"
MEASURES = ("removed", "good_lost", "toxic_lost")
SPACE = "\t\n\u000b\f\r "


def removal_intervals(n: int = len(LETTERS)) -> list[tuple[int, int, int, int, int]]:
    """(mask, step, filter, first rank, end rank) of every run of orders in which ``mask`` is
    removed at ``step`` (from 1) by ``filter`` (its number)."""
    out = []
    for mask in range(1, 1 << n):
        for step in range(1, n + 1):
            for prefix in itertools.permutations(range(n), step):
                if mask >> prefix[-1] & 1 and not any(mask >> f & 1 for f in prefix[:-1]):
                    first = lehmer_rank(prefix, n)
                    out.append((mask, step, prefix[-1], first, first + math.factorial(n - step)))
    return out


def lehmer_rank(prefix: tuple[int, ...], n: int) -> int:
    """Lexicographic rank of the first permutation of ``n`` numbers that begins with ``prefix``."""
    left, rank = list(range(n)), 0
    for k, f in enumerate(prefix):
        rank += left.index(f) * math.factorial(n - 1 - k)
        left.remove(f)
    return rank


def failing_mask(text: Column) -> Column:
    """Filters A to D that a text fails, as bits 0 to 3: too few words, too few distinct words,
    too many capital letters, special characters. A null text is empty."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    trimmed = F.btrim(t, F.lit(SPACE))
    w = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    n, distinct = F.size(w), F.size(F.array_distinct(w))
    capitals = F.length(t) - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = [n < 200, 100 * distinct < 50 * n, 100 * capitals > 3 * F.length(t), t.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0)).cast("int")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): rows of ``docs`` by language and failing set, with those
    labelled good and toxic.

    E (the text is that of a smaller doc_id) fails in all rows but those with the smallest id
    of their text. So all rows are counted with E failing, the rows with the smallest id
    moved over to E not failing. Per text only the smallest id and its labels travel, and
    partial minima make one row per task of however many copies."""
    marks = (labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).cast("int").alias("good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int").alias("toxic")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                       failing_mask(F.col("text")).alias("mask"),
                       F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256).alias("hash"))
    copy = 1 << (len(LETTERS) - 1)
    known = rows.where("doc_id is not null")
    marked = (known.join(marks, "doc_id", "left").na.fill(0, ["good", "toxic"])
              # rows that repeat an id and text count as often as they occur
              .groupBy("doc_id", "hash", "part", "mask", "good", "toxic").agg(F.count("*").alias("n")))
    every = (marked.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
             .select("part", F.col("mask") + copy, "good", "toxic", "n"))
    of_id = (marked.groupBy("doc_id", "hash", "mask", "good", "toxic")
             .agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("parts")))
    least = (of_id.groupBy("hash").agg(F.min_by(F.struct("mask", "good", "toxic", "parts"), "doc_id").alias("r"))
             .select("r.mask", "r.good", "r.toxic", F.explode("r.parts").alias("p")).select("p.part", "mask", "good", "toxic", "p.n"))
    moved = (least.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
             .withColumn("e", F.explode(F.array(F.struct(F.lit(0).alias("bit"), F.lit(1).alias("sign")),
                                                F.struct(F.lit(copy).alias("bit"), F.lit(-1).alias("sign")))))
             .select("part", F.col("mask") + F.col("e.bit"), "good", "toxic", F.col("n") * F.col("e.sign")))
    unknown = rows.where("doc_id is null").groupBy("part", "mask").agg(F.count("*").alias("n")).select(
        "part", "mask", F.lit(0), F.lit(0), "n")
    return (every.union(moved).union(unknown).toDF("part", "mask", "good", "toxic", "n").groupBy("part", "mask")
            .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
            .where("n > 0"))


def order_audit(counts: DataFrame) -> DataFrame:
    """The report from (part, mask, n, good, toxic): a row per part, order and step."""
    spark, letters = counts.sparkSession, len(LETTERS)
    orders = math.factorial(letters)
    intervals = spark.createDataFrame(removal_intervals(), "mask int, step int, filter int, first int, end int")
    steps = spark.createDataFrame([(r, "".join(LETTERS[f] for f in p), k + 1, f)
                                   for r, p in enumerate(itertools.permutations(range(letters))) for k, f in enumerate(p)],
                                  "rank int, filter_order string, step int, filter int")
    bit = [F.col("mask").bitwiseAND(1 << k) != 0 for k in range(letters)]
    totals = counts.groupBy("part").agg(
        F.sum("n").alias("total"), F.array(*[F.sum(F.when(b, F.col("n")).otherwise(0)) for b in bit]).alias("fails"),
        F.array(*[F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0)) for k in range(letters)]).alias("only"))

    ends = F.array(F.struct(F.col("first").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("end").alias("rank"), F.lit(-1).alias("sign")))
    marks = (counts.join(F.broadcast(intervals), "mask").withColumn("e", F.explode(ends))
             .select("part", "step", "e.rank", *[(F.col(c) * F.col("e.sign")).alias(m) for c, m in zip(("n", "good", "toxic"), MEASURES)]))
    grid = totals.select("part", F.explode(F.sequence(F.lit(1), F.lit(letters))).alias("step"),
                         F.sequence(F.lit(0), F.lit(orders - 1)).alias("ranks")).select(
        "part", "step", F.explode("ranks").alias("rank"), *[F.lit(0).cast("long").alias(m) for m in MEASURES])
    changes = marks.where(F.col("rank") < orders).unionByName(grid).groupBy("part", "step", "rank").agg(*[F.sum(m).alias(m) for m in MEASURES])
    along = Window.partitionBy("part", "step").orderBy("rank")
    cells = changes.select("part", "step", "rank", *[F.sum(m).over(along).alias(m) for m in MEASURES])

    named = cells.join(F.broadcast(steps), ["rank", "step"]).join(totals, "part")
    so_far = Window.partitionBy("part", "rank").orderBy("step")
    own = F.col("filter") + 1
    return named.select(
        "part", "filter_order", "step", (F.col("total") - F.sum("removed").over(so_far)).alias("kept"), "removed",
        (F.element_at("fails", own) - F.col("removed")).alias("redundant"), F.element_at("only", own).alias("unique_fails"),
        "good_lost", "toxic_lost", F.sum("removed").over(Window.partitionBy("part", "filter")).alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (language; null: empty string), order of the filters A to E and step.

    A: under 200 words; B: fewer than half of the words distinct; C: over 3 % capital letters;
    D: a special character; E: the text of a smaller doc_id. A null text is empty, so empty
    and null texts are copies. Rows that repeat an id do not fail E by each other, and a row
    without an id fails E never and makes no other row fail it. A document is good or toxic
    if any of its label rows says so. An empty table has no part and gives no row.
    """
    return order_audit(mask_counts(docs, labels))


def op13_filter_audit(spark, sf_dir):
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
smallest AS (SELECT t, min(doc_id) AS m FROM d GROUP BY t),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN doc_id > m THEN 16 ELSE 0 END) AS mask
  FROM d LEFT JOIN smallest USING (t) LEFT JOIN l USING (doc_id)),
masks AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
letter(x, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letter a JOIN letter b ON b.x <> a.x JOIN letter c ON c.x NOT IN (a.x, b.x)
       JOIN letter d ON d.x NOT IN (a.x, b.x, c.x) JOIN letter e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)),
cells AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & CAST(before + bit AS INTEGER) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & CAST(before AS INTEGER) = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & CAST(before AS INTEGER) > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & CAST(before AS INTEGER) = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & CAST(before AS INTEGER) = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM cells
"""
