"""N-gram Jaccard join with prefix trees (operator 9).

A document's set holds the hashes of its distinct word n-grams. Sets are put in one global
order, rarest first by counts over all documents, so that two sets can only be similar if
they share one of their first few elements. The steps, none of which holds more than a
bucket of postings, a sketch or a slice of one group in a task:

1. Read all texts: set size, a 64-bit key of the set (copies share it), a histogram of its
   hashes, and a sketch of how often each hash occurs, which fixes the order.
2. Read again: postings (element, key, size, place in the order) of each set's prefix, dealt
   by buckets of elements; sets that repeat inside a task are posted once. Elements of one
   set only are dropped there.
3. In every remaining element's group the set with the fewest rarer elements is the pivot;
   pairs of it with members that size and place allow are verified, and links joined up.
   This settles nearly all pairs inside large groups of near copies with a star of each.
4. What is left are pairs of sets in different components that share an element; all that
   size and place allow are verified too. No link is lost: a similar pair always passes at
   its first common element.

Before sets are gathered, a pair's histograms bound its overlap (the sum of the smaller
counts), which settles nearly all pairs that only chance brought together. To verify the rest,
sets are made again from their texts and gathered by probe, at most ``SLICE`` to a prefix tree. Elements run from the most common here, so that near copies share
long paths; a traversal carries the overlap down and leaves a subtree when the elements that
remain on either side cannot reach what its sizes require.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import FILTER_BITS, fresh, maybe_in, measured_stage, stage, table, text_hash, text_list, texts, without

WORDS, PERCENT = 4, 85
STAGE_WORDS, STAGE_PERCENT = 5, 80  # of the stage that removes near duplicates
SKETCH_BITS, SKETCH_PARTS = 21, 16
BINS = 256  # of a set's histogram
FLUSH = 1 << 20  # postings buffered in a task
SLICE = 256  # sets in one prefix tree

READ_SCHEMA = "doc_id long, hash long, n long, key long, bins binary, part int, counts binary"
POST_SCHEMA = "bucket int, tokens binary, keys binary, sizes binary, places binary"
GROUP_SCHEMA = "bucket int, token long, key long, n int, place int"


def ngram_set(raw: bytes, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of the lower-cased text; a shorter
    text is one n-gram, one without words has none."""
    import xxhash
    w = raw.lower().split()
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    n = max(1, len(w) - size + 1)
    out = np.full(n, np.uint64(min(len(w), size)), np.uint64)
    for k in range(min(size, len(w))):
        out = (out ^ h[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def set_key(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def histogram(s: np.ndarray) -> bytes:
    """How many elements fall into each of ``BINS`` bins, a byte each (255: that or more)."""
    return np.minimum(np.bincount((s & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes()


def slot(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def least_overlap(n1, n2, percent: int = PERCENT):
    """Common elements that two sets of these sizes need: 100 i >= percent (n1 + n2 - i)."""
    return -(-percent * (n1 + n2) // (100 + percent))


def rare_first(s: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    return s[np.lexsort((s, ranks[slot(s)]))]


# --- reading -----------------------------------------------------------------------


def read_rows(batches, size: int):
    """A row per document, then the task's sketch in parts."""
    names = ["doc_id", "hash", "n", "key", "bins", "part", "counts"]
    kinds = [*[pa.int64()] * 4, pa.binary(), pa.int32(), pa.binary()]
    counts, any_rows = np.zeros(1 << SKETCH_BITS, np.int64), False
    for b in batches:
        ns, keys, bins = [], [], []
        for raw in text_list(b.column("text")):
            s = ngram_set(raw, size)
            ns.append(len(s))
            keys.append(set_key(s) if len(s) else None)
            bins.append(histogram(s) if len(s) else None)
            np.add.at(counts, slot(s), 1)
        m = len(ns)
        any_rows = any_rows or m > 0
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("hash"), pa.array(ns, pa.int64()), pa.array(keys, pa.int64()),
                                          pa.array(bins, pa.binary()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names=names)
    if any_rows:
        for k, part in enumerate(np.split(counts, SKETCH_PARTS)):
            row = [*[[None]] * 5, [k], [part.astype(np.min_scalar_type(int(part.max()))).tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, kinds)], names=names)


def sketch_ranks(read: DataFrame) -> np.ndarray:
    """Counts of all tasks added up, as one byte on a logarithmic scale: a total order with
    the hash as the tie-break. ``2 ** SKETCH_BITS`` numbers, however many documents."""

    def add(batches):
        sums = {}
        for b in batches:
            for part, raw in zip(b.column("part").to_pylist(), b.column("counts").to_pylist()):
                counts = np.frombuffer(raw, f"u{len(raw) * SKETCH_PARTS >> SKETCH_BITS}")  # as narrow as the task's counts allow
                sums[part] = sums.get(part, 0) + counts.astype(np.int64)
        for part, c in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([c.tobytes()], pa.binary())],
                                             names=["part", "counts"])

    rows = (read.where("part is not null").select("part", "counts").repartition(SKETCH_PARTS, "part")
            .mapInArrow(add, "part int, counts binary").collect())
    total = np.zeros(1 << SKETCH_BITS)
    width = len(total) // SKETCH_PARTS
    for r in rows:
        total[r["part"] * width:(r["part"] + 1) * width] += np.frombuffer(r["counts"], np.int64)
    return np.minimum(np.round(12 * np.log2(total + 1)), 255).astype(np.uint8)


def posting_rows(batches, ranks: np.ndarray, buckets: int, size: int, percent: int):
    """Prefix postings of the task's distinct sets, as one row per bucket and flush."""
    names = ["bucket", "tokens", "keys", "sizes", "places"]
    seen, held, used = set(), [], 0

    def flush():
        token = np.concatenate([h[0] for h in held])
        each = [len(h[0]) for h in held]
        key = np.repeat(np.array([h[1] for h in held], np.int64), each)
        n = np.repeat(np.array([h[2] for h in held], np.int32), each)
        place = np.concatenate([np.arange(k, dtype=np.int32) for k in each])
        home = (token % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((token, home))
        edges = np.searchsorted(home[order], np.arange(buckets + 1))
        rows = [(int(b), *(x[order[edges[b]:edges[b + 1]]].tobytes() for x in (token, key, n, place)))
                for b in np.flatnonzero(np.diff(edges))]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), [pa.int32()] + [pa.binary()] * 4)], names=names)

    for b in batches:
        for raw in text_list(b.column("text")):
            s = ngram_set(raw, size)
            if not len(s) or (key := set_key(s)) in seen:
                continue
            seen.add(key)
            if len(seen) > 1_000_000:
                seen.clear()
            prefix = rare_first(s, ranks)[:len(s) - -(-percent * len(s) // 100) + 1]
            held.append((prefix, key, len(s)))
            used += len(prefix)
            if used >= FLUSH:
                yield flush()
                held, used = [], 0
    if held:
        yield flush()


def group_rows(batches):
    """Postings of elements that at least two sets have, bucket by bucket."""
    names = ["bucket", "token", "key", "n", "place"]

    def close(bucket, held):
        token, key, n, place = (np.concatenate([np.frombuffer(h[k], t) for h in held])
                                for k, t in enumerate((np.uint64, np.int64, np.int32, np.int32)))
        order = np.lexsort((key, token))
        token, key, n, place = (x[order] for x in (token, key, n, place))
        new = np.r_[True, (token[1:] != token[:-1]) | (key[1:] != key[:-1])]  # a set posted by several tasks
        token, key, n, place = (x[new] for x in (token, key, n, place))
        same = np.r_[False, token[1:] == token[:-1], False]
        keep = same[1:] | same[:-1]
        for lo in range(0, int(keep.sum()), 1 << 16):
            cut = np.flatnonzero(keep)[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cut), bucket, np.int32)), pa.array(token[cut].view(np.int64)), pa.array(key[cut]),
                 pa.array(n[cut]), pa.array(place[cut])], names=names)

    bucket, held = None, []
    for b in batches:
        for r in b.to_pylist():
            if r["bucket"] != bucket:
                if held:
                    yield from close(bucket, held)
                bucket, held = r["bucket"], []
            held.append((r["tokens"], r["keys"], r["sizes"], r["places"]))
    if held:
        yield from close(bucket, held)


# --- candidates --------------------------------------------------------------------


def fits(n1, left1, n2, left2, percent: int):
    """Whether two sets can be similar if the shared element is their first common one:
    sizes near enough, and enough elements from it on in both."""
    need = least_overlap(n1, n2, percent)
    return (left1 >= need) & (left2 >= need) & (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2))


def pair_rows(batches, percent: int, pivots: bool):
    """Distinct candidate pairs of each bucket (probe, key). With ``pivots`` each group's
    pivot with its members, else all pairs of sets in different components."""
    names = ["probe", "key"]

    def pairs_of(key, n, left, comp):
        if pivots:
            # the fewest rarer elements for its size; ties to the smaller key
            k = np.lexsort((key, (n - left) / n))[0]
            ok = fits(n[k], left[k], n, left, percent)
            ok[k] = False
            return [(np.full(int(ok.sum()), key[k]), key[ok])]
        own, inverse, size = np.unique(comp, return_inverse=True, return_counts=True)
        if len(own) < 2:
            return []
        main = size.argmax()
        out = []
        rest = np.flatnonzero(inverse != main)  # each pair has an end outside the largest component
        for lo in range(0, len(rest), 256):
            a = rest[lo:lo + 256, None]
            ok = fits(n[a], left[a], n[None], left[None], percent) & (inverse[a] != inverse[None])
            # both ends outside: once, from the one that comes first
            ok &= (inverse[None] == main) | (np.arange(len(n))[None] > a)
            i, j = np.nonzero(ok)
            out.append((key[a[i, 0]], key[j]))
        return out

    def close(held):
        token, key, n, place, comp = (np.concatenate([h[k] for h in held]) for k in range(5))
        order = np.lexsort((key, token))
        token, key, n, place, comp = (x[order] for x in (token, key, n, place, comp))
        n = n.astype(np.int64)
        edges = np.flatnonzero(np.r_[True, token[1:] != token[:-1], True])
        seen = set()
        for a, b in zip(edges[:-1], edges[1:]):
            for p, k in pairs_of(key[a:b], n[a:b], n[a:b] - place[a:b], comp[a:b]):
                seen.update(zip(np.minimum(p, k).tolist(), np.maximum(p, k).tolist()) if not pivots else zip(p.tolist(), k.tolist()))
            if len(seen) >= 1 << 18:
                yield batch(seen)
                seen = set()
        if seen:
            yield batch(seen)

    def batch(seen):
        p, k = zip(*seen)
        return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(k, pa.int64())], names=names)

    bucket, held = None, []
    for b in batches:
        at = b.column("bucket").to_numpy()
        cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("token", "key", "n", "place", "comp")]
        edges = np.flatnonzero(np.r_[True, at[1:] != at[:-1], True]) if len(at) else []
        for lo, hi in zip(edges[:-1], edges[1:]):
            if at[lo] != bucket:
                if held:
                    yield from close(held)
                bucket, held = at[lo], []
            held.append([c[lo:hi] for c in cols])
    if held:
        yield from close(held)


# --- verification ------------------------------------------------------------------


class PrefixTree:
    """A path-compressed trie over element sequences (all in one order). Nodes are
    (segment, depth after it, sets that end here, children, smallest and largest size)."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        order = sorted(range(len(sets)), key=lambda k: sets[k].astype(">u8").tobytes())
        self.root = self.node(order, 0) if order else None

    def node(self, own: list[int], depth: int):
        a, b = self.sets[own[0]], self.sets[own[-1]]
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[depth:m] != b[depth:m])
        end = depth + int(differ[0]) if len(differ) else m
        here = [k for k in own if len(self.sets[k]) == end]
        children, group = [], []
        for k in own:
            if len(self.sets[k]) == end:
                continue
            if group and self.sets[group[0]][end] != self.sets[k][end]:
                children.append(self.node(group, end))
                group = []
            group.append(k)
        if group:
            children.append(self.node(group, end))
        sizes = [len(self.sets[k]) for k in own]
        return a[depth:end], end, here, children, min(sizes), max(sizes)

    def similar(self, probe: np.ndarray, percent: int = PERCENT):
        """Numbers of the sets similar to ``probe`` (sorted distinct elements)."""
        if self.root is None or not len(probe):
            return
        stack = [(self.root, 0)]
        while stack:
            (segment, depth, here, children, least, most), overlap = stack.pop()
            at = np.minimum(np.searchsorted(probe, segment), len(probe) - 1)
            overlap += int((probe[at] == segment).sum())
            if overlap + min(len(probe) - overlap, most - depth) < least_overlap(len(probe), least, percent):
                continue
            for k in here:
                if 100 * overlap >= percent * (len(probe) + depth - overlap):
                    yield k
            stack.extend((c, overlap) for c in children)


def set_rows(batches, bits: np.ndarray, size: int):
    """Sets of the documents whose filter bit is on."""
    names = ["doc_id", "key", "elements"]
    for b in batches:
        at = b.column("slot").to_numpy()
        rows = [(d, s) for d, s in ((b.column("doc_id")[int(k)].as_py(), ngram_set(b.column("text")[int(k)].as_py() or b"", size))
                                    for k in np.flatnonzero((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1)) if len(s)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([set_key(r[1]) for r in rows], pa.int64()),
                 pa.array([r[1].tobytes() for r in rows], pa.binary())], names=names)


def link_rows(batches, ranks: np.ndarray, percent: int):
    """Links of each probe's slice: its own row first, then the slice's sets."""
    group, probe, keys, sets = None, None, [], []

    def close():
        tree = PrefixTree([rare_first(s, ranks)[::-1] for s in sets])
        got = [(group[0], keys[k]) for k in tree.similar(probe, percent)]
        return pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64())],
                                          names=["a", "b"])

    for b in batches:
        for r in b.to_pylist():
            own, s = (r["probe"], r["slice"]), np.frombuffer(r["elements"], np.uint64)
            if own != group:
                if sets:
                    yield close()
                group, probe, keys, sets = own, s, [], []
            if r["key"] is not None:
                keys.append(r["key"])
                sets.append(s)
    if sets:
        yield close()


def filter_bits(ids: DataFrame) -> np.ndarray:
    """A bit array of ``2 ** FILTER_BITS`` in which the slots of all ids are on."""
    words = (ids.select(F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS)).alias("s")).select(
        F.shiftright("s", 5).alias("w"), F.expr("shiftleft(1L, CAST(s & 31 AS INT))").alias("b"))
        .groupBy("w").agg(F.bit_or("b").alias("b")))
    got = words.toArrow()  # the filter's words (2 ** 18 at most), however many ids
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    out[got.column("w").to_numpy()] = got.column("b").to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (probe, key) whose histograms allow the overlap that their sizes need; a
    bin that is full on both sides allows any."""

    def run(batches):
        for b in batches:
            n = [b.column(c).to_numpy() for c in ("n1", "n2")]
            h = [np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("h1", "h2")]
            both = np.minimum(h[0], h[1])
            fine = (both.sum(axis=1, dtype=np.int64) >= least_overlap(n[0], n[1], percent)) | (both == 255).any(axis=1)
            yield b.select(["probe", "key"]).filter(pa.array(fine, pa.bool_()))

    first = classes.select(F.col("key").alias("probe"), F.col("n").alias("n1"), F.col("bins").alias("h1"))
    second = classes.select("key", F.col("n").alias("n2"), F.col("bins").alias("h2"))
    return pairs.join(first, "probe").join(second, "key").select("probe", "key", "n1", "n2", "h1", "h2").mapInArrow(
        run, "probe long, key long")


def verify(docs: DataFrame, pairs: DataFrame, classes: DataFrame, ranks, size: int, percent: int) -> tuple[DataFrame, int]:
    """Links (a, b), written out, and their number, among candidate ``pairs`` (probe, key). Only texts of candidates are made
    into sets again (a bit filter picks them at the scan); a probe with many partners is
    dealt over slices. ``ranks`` is a broadcast."""
    near, flag = maybe_in(classes, ["key"], pairs.select("probe").union(pairs.select("key")), ["probe"])
    classes = near.where(flag).drop(flag)  # only their histograms are shuffled
    pairs = stage(possible(pairs, classes, percent), "jaccard-possible")
    wanted = stage(pairs.select("probe").union(pairs.select("key")).distinct()
                   .join(classes.select(F.col("key").alias("probe"), "first_id"), "probe")
                   .select(F.col("probe").alias("key"), F.col("first_id").alias("doc_id")), "jaccard-wanted")
    bits = docs.sparkSession.sparkContext.broadcast(filter_bits(wanted))
    slotted = texts(docs, F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << FILTER_BITS)).alias("slot"))
    # both ends of a candidate's text agree on its key, so rows that repeat an id count once
    sets = stage(slotted.where("doc_id is not null").mapInArrow(lambda batches: set_rows(batches, bits.value, size),
                                                                "doc_id long, key long, elements binary")
                 .join(wanted, ["key", "doc_id"]).select("key", "elements").dropDuplicates(["key"]), "jaccard-sets")
    slices = pairs.groupBy("probe").agg(F.ceil(F.count("*") / SLICE).cast("int").alias("slices"))
    members = (pairs.join(slices, "probe").withColumn("slice", F.pmod(F.xxhash64("key"), F.col("slices")).cast("int"))
               .join(sets, "key").select("probe", "slice", "key", "elements"))
    probes = (slices.join(sets.withColumnRenamed("key", "probe"), "probe")
              .select("probe", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
                      F.lit(None).cast("long").alias("key"), "elements"))
    links = (probes.unionByName(members).repartition("probe", "slice").sortWithinPartitions("probe", "slice", "key")
             .mapInArrow(lambda batches: link_rows(batches, ranks.value, percent), "a long, b long"))
    found, seen = measured_stage(links, "jaccard-links", n=F.count("*"))
    bits.destroy()
    return found, seen["n"]


# --- components --------------------------------------------------------------------


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b), the root being the smallest node that
    is reachable; ``known`` (node, root) holds what earlier links gave and is built upon.
    Large-star and small-star steps in turn, each written out, until nothing changes; a node
    with many links is met by partial minima and skew-split joins only."""
    given = links.select("a", "b")
    if known is not None:
        given = given.union(known.select(F.col("node").alias("a"), F.col("root").alias("b")))
    mark = {"n": F.count("*"), "h": F.sum(F.xxhash64("a", "b") % (1 << 30))}
    edges, before = measured_stage(given.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                                   "links", **mark)
    while before["n"]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).where("a <> b")
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        edges, after = measured_stage(small, "links", **mark)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def linked_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, hash of the text, n, key, root, component_id) of every row of ``docs``: key
    names the set (null without words), root the component of sets, component_id its
    smallest doc_id."""
    spark = docs.sparkSession
    buckets = max(16, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    read = stage(texts(docs, text_hash().alias("hash")).mapInArrow(lambda batches: read_rows(batches, words), READ_SCHEMA), "jaccard-read")
    rows = read.where("part is null").select("doc_id", "hash", "n", "key", "bins")
    ranks = spark.sparkContext.broadcast(sketch_ranks(read))  # 2 ** SKETCH_BITS bytes
    classes = stage(rows.where("key is not null and doc_id is not null").groupBy("key")
                    .agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("bins").alias("bins")), "jaccard-classes")

    posted = (texts(docs).where("doc_id is not null")
              .mapInArrow(lambda batches: posting_rows(batches, ranks.value, buckets, words, percent), POST_SCHEMA))
    groups = stage(posted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(group_rows, GROUP_SCHEMA), "jaccard-groups")

    def candidates(labelled: DataFrame, pivots: bool, name: str) -> DataFrame:
        dealt = labelled.repartition("bucket").sortWithinPartitions("bucket")
        return stage(dealt.mapInArrow(lambda batches: pair_rows(batches, percent, pivots), "probe long, key long").distinct(), name)

    stars = candidates(groups.withColumn("comp", F.col("key")), True, "jaccard-stars")
    links, _ = verify(docs, stars, classes, ranks, words, percent)
    joined = stage(components(links), "jaccard-components")
    labelled = (groups.join(joined.withColumnRenamed("node", "key"), "key", "left")
                .select("bucket", "token", "key", "n", "place", F.coalesce("root", "key").alias("comp")))
    tried = stars.select(F.least("probe", "key").alias("probe"), F.greatest("probe", "key").alias("key"))
    rest = candidates(labelled, False, "jaccard-rest").join(tried, ["probe", "key"], "left_anti")
    more, found = verify(docs, rest, classes, ranks, words, percent)
    ranks.destroy()
    if found:
        joined = stage(components(more, joined), "jaccard-components")

    named = joined.join(classes.select(F.col("key").alias("node"), "first_id"), "node")
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_key = (classes.select("key", "first_id").join(joined.withColumnRenamed("node", "key"), "key", "left")
              .join(smallest, "root", "left").select("key", F.coalesce("root", "key").alias("root"),
                                                     F.coalesce("component_id", "first_id").alias("component_id")))
    return (rows.drop("bins").join(by_key, "key", "left")
            .select("doc_id", "hash", "n", "key", "root", F.coalesce("component_id", "doc_id").alias("component_id")))


def similarity_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    Documents link where 100 * intersection >= percent * union of their n-gram sets;
    component_id is the smallest doc_id reachable. Null texts and texts without words have
    empty sets, link with nothing and are their own component. Repeated rows and copies are
    one class. Rows without an id take the component of their copies that have one (null
    where none has), and neither name nor join others. An empty table gives an empty result.
    """
    return linked_rows(docs, words, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, words: int = STAGE_WORDS, percent: int = STAGE_PERCENT) -> DataFrame:
    """Rows of ``docs`` without the near duplicates: of each group of linked documents the row
    with the smallest doc_id stays (of several texts under that id the one with the smallest
    hash). Documents are told apart by id and text: where an id repeats with different texts,
    each text is judged for itself, and rows that repeat id and text count as one, of which
    one stays. Rows without an id stay, and so do empty texts under different ids."""
    found = stage(linked_rows(docs, words, percent).where("doc_id is not null").select("doc_id", "hash", "root"), "jaccard-found")
    own = F.struct("doc_id", "hash")
    first = found.where("root is not null").groupBy("root").agg(F.min(own).alias("first"))
    copies = found.where("root is not null").join(first, "root").where(own != F.col("first")).select("doc_id", "hash")
    left = without(docs, copies, "jaccard-removed")
    again, seen = measured_stage(found.groupBy("doc_id", "hash").count().where("count > 1").select("doc_id", "hash"),
                                 "jaccard-repeated", n=F.count("*"))
    if not seen["n"]:
        return left
    h, n = fresh(docs, "own_hash"), fresh(docs, "own_number")
    hashed = left.withColumn(h, text_hash())
    same = (hashed["doc_id"].cast("long") == again["doc_id"]) & (hashed[h] == again["hash"])
    once = hashed.join(again, same, "left_semi").withColumn(n, F.row_number().over(Window.partitionBy("doc_id", h).orderBy("text")))
    return without(left, again, "jaccard-again").unionByName(once.where(F.col(n) == 1).select(*docs.columns))


def op9_similarity_components(spark, sf_dir):
    return similarity_components(table(spark, sf_dir, "documents"))
