"""Benchmark decontamination by a positional inverted index (operator 2).

The index is stored as Parquet, one segment per row: a run of documents of bounded size
with, for each term, the ascending positions at which it occurs. Positions count through
the segment and leave a gap between documents, so that no match can cross one. Documents
are never shuffled: a segment is built where its documents are read.

A test window is a list of terms. Its occurrences in a segment are found by taking the
postings of its rarest term there, moving them back by the term's offset to possible
starts, and intersecting these with the moved postings of the next rarer terms until none
is left. With a slack, terms may stand up to that many places off (proximity matches).

Only terms of the test set get postings, under its numbers of the terms: no other term can
match, and an index serves the one test set that it was stored for. Test sets are handled in
blocks of bounded bytes, each shipped to every task and its matches written before the next
is read, so a test set may be of any size.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, table, text_hash, text_list, texts, without, words

WINDOW = 10
SEGMENT_BYTES = 4 << 20  # of text in a segment (a longer document is a segment alone)
BLOCK_BYTES = 16 << 20  # of test texts handled at a time
GAP = 64  # free positions between documents; slack stays below

INDEX_SCHEMA = ("doc_ids binary, starts binary, lengths binary, terms binary, bounds binary, positions binary")
MATCH_SCHEMA = "doc_id long, n_words long, first long, item_id string, hits binary"
RESULT_SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


class TestSet:
    """Windows of a block of test items: term numbers, and the items of each window."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[tuple[int, ...], set[str]] = {}
        for item, raw in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(raw)]
            for k in range(max(1, len(ids) - window + 1) if ids else 0):
                self.windows.setdefault(tuple(ids[k:k + window]), set()).add(item)


def build_segment(docs: list[tuple], vocabulary: dict[bytes, int]) -> dict:
    """Postings of one segment. ``docs``: (doc_id or None, bytes)."""
    get = vocabulary.get
    ids, lengths = [], []
    for _, raw in docs:
        w = words(raw)
        lengths.append(len(w))
        ids.append(np.fromiter((get(x, -1) for x in w), np.int32, len(w)))
    lengths = np.array(lengths, np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + GAP)[:-1]]).astype(np.int64)
    where = [np.flatnonzero(x >= 0) for x in ids]
    term = np.concatenate([x[w] for x, w in zip(ids, where)])
    place = np.concatenate([w + s for w, s in zip(where, starts)])
    order = np.argsort(term, kind="stable")
    term, place = term[order], place[order]
    terms, first = np.unique(term, return_index=True)
    return {"doc_ids": np.array([np.iinfo(np.int64).min if d is None else d for d, _ in docs], np.int64),
            "starts": starts, "lengths": lengths, "terms": terms.astype(np.int32),
            "bounds": np.append(first, len(term)).astype(np.int64), "positions": place.astype(np.int64)}


def segments(batches, vocabulary: dict[bytes, int]):
    part, used = [], 0
    for b in batches:
        for d, raw in zip(b.column("doc_id").to_pylist(), text_list(b.column("text"))):
            if part and used + len(raw) > SEGMENT_BYTES:
                yield build_segment(part, vocabulary)
                part, used = [], 0
            part.append((d, raw))
            used += len(raw)
    if part:
        yield build_segment(part, vocabulary)


def occurrences(postings: dict[int, np.ndarray], window: tuple[int, ...], slack: int = 0) -> np.ndarray:
    """Starts at which every term of the window stands at its offset (give or take
    ``slack`` places); rarest postings first, so that most windows end after one list."""
    lists = []
    for k, t in enumerate(window):
        p = postings.get(t)
        if p is None:
            return np.empty(0, np.int64)
        lists.append((len(p), k, p))
    lists.sort(key=lambda x: x[:2])
    _, k, p = lists[0]
    start = p - k
    if slack:
        start = np.unique(np.add.outer(start, np.arange(-slack, slack + 1)).ravel())
    for _, k, p in lists[1:]:
        if not len(start):
            break
        at = np.searchsorted(p, start + (k - slack))
        start = start[(at < len(p)) & (p[np.minimum(at, len(p) - 1)] <= start + (k + slack))]
    return start


def search(segment: dict, windows: dict, slack: int = 0):
    """(document number, start in the document, window length, items) of all occurrences."""
    bounds, pos = segment["bounds"], segment["positions"]
    postings = {int(t): pos[bounds[k]:bounds[k + 1]] for k, t in enumerate(segment["terms"])}
    starts, lengths = segment["starts"], segment["lengths"]
    for window, items in windows.items():
        at = occurrences(postings, window, slack)
        if len(at):
            doc = np.searchsorted(starts, at, side="right") - 1
            inside = (doc >= 0) & (at - starts[np.maximum(doc, 0)] + len(window) <= lengths[np.maximum(doc, 0)])
            for d, s in zip(doc[inside], at[inside]):
                yield int(d), int(s - starts[d]), len(window), items


def store_index(docs: DataFrame, test: TestSet) -> DataFrame:
    """Build and store the index of all documents for the terms of ``test``, which alone may
    be searched on it."""
    vocabulary = test.vocabulary

    def run(batches):
        for s in segments(batches, vocabulary):
            yield pa.RecordBatch.from_arrays([pa.array([s[c].tobytes()], pa.binary()) for c in
                                              ("doc_ids", "starts", "lengths", "terms", "bounds", "positions")],
                                             names=["doc_ids", "starts", "lengths", "terms", "bounds", "positions"])

    return stage(texts(docs).mapInArrow(run, INDEX_SCHEMA), "postings")


def load_segment(row: dict) -> dict:
    kinds = {"terms": np.int32}
    return {k: np.frombuffer(v, kinds.get(k, np.int64)) for k, v in row.items()}


def phrase_matches(index: DataFrame, test: TestSet, slack: int = 0) -> DataFrame:
    """(doc_id, start, length, item_id) of every occurrence of every window: exact phrases,
    or proximity matches where ``slack`` (below the gap between documents) is above 0."""
    if not 0 <= slack < GAP // 2:
        raise ValueError(f"slack must be in 0..{GAP // 2 - 1}")
    windows = test.windows

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                s = load_segment(row)
                out = [(int(s["doc_ids"][d]), at, n, i) for d, at, n, items in search(s, windows, slack) for i in sorted(items)]
                for lo in range(0, len(out), 50_000):
                    part = list(zip(*out[lo:lo + 50_000]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part[0], pa.int64()), pa.array(part[1], pa.int64()), pa.array(part[2], pa.int64()),
                         pa.array(part[3], pa.string())], names=["doc_id", "start", "length", "item_id"])

    return index.mapInArrow(run, "doc_id long, start long, length long, item_id string")


def covered(n: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which of ``n`` words lie inside any (start, length)."""
    edge = np.zeros(n + 1, np.int64)
    for s, length in spans:
        edge[s] += 1
        edge[s + length] -= 1
    return np.cumsum(edge)[:n] > 0


def item_blocks(items: DataFrame, size: int = BLOCK_BYTES):
    """Test items in blocks of about ``size`` bytes, streamed to the driver."""
    part, used = [], 0
    rows = items.where("text is not null and item_id is not null").select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").cast("binary").alias("text"))
    for r in rows.toLocalIterator():
        raw = bytes(r["text"])
        if part and used + len(raw) > size:
            yield part
            part, used = [], 0
        part.append((r["item_id"], raw))
        used += len(raw)
    yield part


def summary_row(doc_id, n: int, spans: list[tuple[int, int]], items: list[str]) -> tuple:
    hit = int(covered(n, spans).sum())
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return doc_id, n, hit, len(items), digest, hit > 0


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: n_words, n_hit (words inside an occurring window), n_items (items with
    occurring windows), items_sha256 of those item ids (sorted as strings, comma-joined) and
    contaminated. One row per row of ``docs``.

    Null and empty texts have no words and no hits; items that are null or have no words
    have no windows; items with equal ids count once. With a test set of one block (the
    usual case) a segment's documents are summed up where they are searched. Beyond it the
    blocks' matches are gathered per document (each task's rows are numbered by segment and
    place, so that repeated ids stay apart).
    """
    blocks = item_blocks(items, block_bytes) if block_bytes else iter(())
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        test = TestSet(first, window)
        windows = test.windows

        def run(batches):
            for b in batches:
                for row in b.to_pylist():
                    s = load_segment(row)
                    spans, found = {}, {}
                    for d, at, n, who in search(s, windows):
                        spans.setdefault(d, []).append((at, n))
                        found.setdefault(d, set()).update(who)
                    yield result_batch(s, spans, found)

        return store_index(docs, test).mapInArrow(run, RESULT_SCHEMA)
    return by_blocks(docs, itertools.chain([first, second], blocks), window)


def result_batch(s: dict, spans: dict, found: dict) -> pa.RecordBatch:
    null = np.iinfo(np.int64).min
    rows = [summary_row(None if i == null else int(i), int(n), spans.get(d, []), list(found.get(d, ())))
            for d, (i, n) in enumerate(zip(s["doc_ids"], s["lengths"]))]
    cols = list(zip(*rows))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def by_blocks(docs: DataFrame, blocks, window: int) -> DataFrame:
    """Several blocks: one stored copy of the texts numbered by row, an index and a search
    per block, its matches written before the next block is taken, then all matches of a row
    together (a row's matches are bounded by its words times the items they touch)."""
    base = stage(texts(docs).withColumn("row", F.monotonically_increasing_id()), "numbered")
    keyed = base.select(F.col("row").alias("doc_id"), "text")
    found = None
    for block in blocks:
        test = TestSet(block, window)
        part = stage(phrase_matches(store_index(keyed, test), test), "matches")
        found = part if found is None else found.unionByName(part)
    per_row = found.groupBy(F.col("doc_id").alias("row")).agg(
        F.collect_set(F.struct("start", "length")).alias("spans"), F.sort_array(F.collect_set("item_id")).alias("items"))

    def run(batches):
        for b in batches:
            rows = [summary_row(r["doc_id"], len(words(r["text"] or b"")), [(x["start"], x["length"]) for x in r["spans"] or []],
                                list(r["items"] or [])) for r in b.to_pylist()]
            cols = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return base.join(per_row, "row", "left").select("doc_id", "text", "spans", "items").mapInArrow(run, RESULT_SCHEMA)


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` in which no window of any item occurs. A text decides for itself, so
    rows go by their text's hash: of two rows with one id only the contaminated one goes, and
    rows without an id are judged, too."""
    found = contamination(docs.select(text_hash().alias("doc_id"), "text"), items)
    return without(docs, found.where("contaminated").select(F.col("doc_id").alias("hash")), "contaminated")


def op2_decontamination(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# A DuckDB twin: windows of each length are compared as joined strings.
OP2_SQL = r"""
WITH norm AS (
  SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, list_filter(regexp_split_to_array(regexp_replace(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS key
  FROM items, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(k) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM wins),
grams AS (
  SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS key
  FROM norm, sizes, unnest(range(1, len(w) - n + 2)) AS t(k) WHERE len(w) >= n),
hits AS (SELECT g.doc_id, g.k, g.n, x.item_id FROM grams g JOIN wins x ON g.key = x.key AND g.n = x.n),
covered AS (
  SELECT doc_id, count(DISTINCT k + j) AS n_hit FROM hits, unnest(range(0, n)) AS t(j) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT n.doc_id, CAST(len(n.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
  coalesce(i.items_sha256, sha256('')) AS items_sha256, c.n_hit IS NOT NULL AS contaminated
FROM norm n LEFT JOIN covered c USING (doc_id) LEFT JOIN named i USING (doc_id)
"""
