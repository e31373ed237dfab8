"""Per-document bag-of-words built from array higher-order functions.

A document's tokens live in one row, so counting them inside the row needs no
shuffle at all: sort the token array, keep the index of the last occurrence of
each distinct token, and the gaps between those indices are the counts. The
result is ``ARRAY<STRUCT<term STRING, cnt INT>>`` ordered by term. Corpus-level
statistics (document frequencies) are ``groupBy`` jobs on top of it.

An expression referenced from inside a lambda is evaluated again for every
element, and the optimizer freely substitutes column aliases (into lambdas, and
into filters it pushes down). So every intermediate array is bound once with
``let`` (``transform(array(value), v -> body)[0]``) and lambdas only ever see
lambda variables: whatever the optimizer inlines, the work stays linear.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BAG_TYPE = "array<struct<term:string,cnt:int>>"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable."""
    return F.get(F.transform(F.array(value), body), 0)


def term_counts(tokens: Column) -> Column:
    """A8 inside the row: distinct tokens with their counts, sorted by term."""
    def with_sorted(s):
        n = F.size(s)
        ends = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
                        lambda i: (i < n) & ((i == n - 1) | (F.get(s, i) != F.get(s, i + 1))))
        return let(ends, lambda e: F.transform(
            e, lambda x, k: F.struct(F.get(s, x).alias("term"),
                                     (x - F.coalesce(F.get(e, k - 1), F.lit(-1))).cast("int").alias("cnt"))))
    return let(F.sort_array(tokens), with_sorted)


def first_positions(tokens: Column) -> Column:
    """Distinct tokens with the 0-based position of their first occurrence, sorted
    by term (aligned with ``term_counts``)."""
    def with_sorted(s):
        n = F.size(s)
        starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
                          lambda i: (i < n) & ((i == 0) | (F.get(s, i)["term"] != F.get(s, i - 1)["term"])))
        return F.transform(starts, lambda i: F.get(s, i))
    return let(F.sort_array(F.transform(tokens, lambda t, i: F.struct(t.alias("term"), i.alias("pos")))),
               with_sorted)


def top_by_count(bag: Column, k: int) -> Column:
    """The ``k`` most frequent terms, ties by term ascending (Q25)."""
    keyed = F.sort_array(F.transform(bag, lambda x: F.struct((-x["cnt"]).alias("neg"),
                                                             x["term"].alias("term"))))
    return F.transform(F.slice(keyed, 1, k),
                       lambda x: F.struct(x["term"].alias("term"), (-x["neg"]).alias("cnt")))


def l2_norm(values: Column, field: str = "cnt") -> Column:
    return F.sqrt(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x[field] * x[field]))


def top_weighted(weighted: Column, k: int) -> Column:
    """The ``k`` largest ``weight`` entries, ties by the term descending (Q15)."""
    keyed = F.sort_array(F.transform(weighted, lambda x: F.struct(x["weight"].alias("weight"),
                                                                x["term"].alias("term"))))
    return F.slice(F.reverse(keyed), 1, k)
