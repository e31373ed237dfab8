"""Shared helpers: reading texts, id folds, Arrow batches, bounded training samples."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

# Rows and bytes of an Arrow batch handed to Python, well under Spark's defaults: rows
# here are whole texts or blobs of postings.
BATCH_ROWS = 2048
BATCH_BYTES = 8 << 20
FILTER_BITS = 23  # of a filter that is broadcast: 2 ** 17 words at most, however many rows


def tune(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches that whole texts travel in."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back:
    cuts lineage, and a lost executor costs a re-read instead of a recomputation.
    ``session.drop_stages`` deletes such tables at the end of a job."""
    return materialize(df, name, "zstd")


def texts(docs: DataFrame, *more) -> DataFrame:
    """(doc_id, text as bytes, extra columns). Bytes, because Python then never fails on
    a string that is no valid UTF-8."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").cast("binary").alias("text"), *more)


def fold(mod: int, col: str = "doc_id"):
    """crc32 of the id as text, modulo ``mod``; -1 for a null id (never trained on)."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % mod, F.lit(-1)).cast("int")


def text_list(column) -> list[bytes]:
    """Bytes of an Arrow text column, null as empty."""
    return [x or b"" for x in column.to_pylist()]


def measured_stage(df: DataFrame, name: str, **measures) -> tuple[DataFrame, dict]:
    """``stage``, and aggregates over the rows that it writes, without a job of their own."""
    seen = Observation()
    out = stage(df.observe(seen, *[c.alias(k) for k, c in measures.items()]), name)
    return out, seen.get


def text_hash():
    """64-bit hash of a row's text: what a decision about a text is keyed by (beside the id,
    which different texts may share)."""
    return F.xxhash64(F.col("text").cast("string"))


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def maybe_in(rows: DataFrame, key: list, wanted: DataFrame, wanted_key: list) -> tuple[DataFrame, str]:
    """``rows`` with a boolean column, and its name: true for every row whose ``key`` occurs in
    ``wanted``, and for few others. The keys' slots in an array of bits are broadcast, in words."""
    def slot(cols):
        return F.pmod(F.xxhash64(*cols), F.lit(1 << FILTER_BITS))

    at, word, bits, flag = (fresh(rows, n) for n in ("own_slot", "own_word", "own_bits", "own_flag"))
    words = (wanted.select(slot(wanted_key).alias(at)).select(F.shiftright(at, 6).alias(word), F.expr(f"shiftleft(1L, CAST({at} & 63 AS INT))").alias(bits))
             .groupBy(word).agg(F.bit_or(bits).alias(bits)))
    held = rows.withColumn(at, slot(key)).withColumn(word, F.shiftright(at, 6))
    on = F.coalesce(F.expr(f"shiftrightunsigned({bits}, CAST({at} & 63 AS INT)) & 1L") == 1, F.lit(False))
    return held.join(F.broadcast(words), word, "left").withColumn(flag, on).drop(at, word, bits), flag


def without(docs: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """Rows of ``docs`` whose columns differ from all ``rows``, which has the values of
    (doc_id, text hash) or of the text hash alone, as doc_id and hash or only hash; a null
    id equals none. ``rows`` are written first, and a filter of bits picks the rows of ``docs``
    that may be among them: where the join shuffles, only these texts do."""
    by_id = "doc_id" in rows.columns
    gone = stage(rows.select(*([F.col("doc_id").cast("long").alias("gone_id")] if by_id else []),
                             F.col("hash").alias("gone_hash")).distinct(), name)
    own = fresh(docs, "own_hash")
    hashed = docs.withColumn(own, text_hash())
    key = [F.col("doc_id").cast("long")] if by_id else []
    flagged, flag = maybe_in(hashed, [*key, F.col(own)], gone, [F.col(c) for c in gone.columns])
    doubtful = flagged.where(flag)
    same = doubtful[own] == gone["gone_hash"]
    if by_id:
        same &= doubtful["doc_id"].cast("long") == gone["gone_id"]
    return flagged.where(~F.col(flag)).unionByName(doubtful.join(gone, same, "left_anti")).drop(own, flag)


def decode(raw: bytes) -> str:
    return raw.decode("utf-8", "replace")


def bounded_sample(docs: DataFrame, labels: DataFrame, max_rows: int, max_bytes: int,
                   seed: int = 17, quota: int = 0) -> list[tuple[bytes, object]]:
    """(whole text, label) of at most ``max_rows`` rows and ``max_bytes`` of text.

    ``labels`` has (doc_id, label), one row per trainable document. Rows are taken in
    the order of a hash of the id, each with its whole text; texts that no longer fit
    are left out, never cut. Both bounds are documented parameters of the callers. Two
    passes: ids and lengths first (``limit`` after ``orderBy`` keeps ``max_rows`` small
    rows per task), then the texts of the chosen ids by a broadcast of at most
    ``max_rows`` ids.

    With a ``quota``, each distinct label first takes its own first ``quota`` rows (within
    half of both bounds, dealt evenly over the labels, but one row each in any case), so
    that every label of the table is in the sample.
    """
    spark = docs.sparkSession
    ids = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    size = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"),
                                                 F.octet_length(F.col("text").cast("string")).alias("size"))
    order = F.xxhash64(F.col("doc_id"), F.lit(seed))
    sized = (size.join(ids, "doc_id").groupBy("doc_id").agg(F.max("size").alias("size"), F.first("label").alias("label"))
             .withColumn("o", order))
    rows = sorted(sized.orderBy("o", "doc_id").limit(max_rows).collect(), key=lambda r: (r["o"], r["doc_id"]))
    own, used = set(), 0
    if quota:
        number = {r["label"]: r["n"] for r in sized.groupBy("label").agg(F.count("*").alias("n")).collect()}
        most = max(1, min(quota, max_rows // (2 * max(len(number), 1))))
        first = first_rows(sized, number, most)
        rows = sorted({r["doc_id"]: r for r in [*rows, *first]}.values(), key=lambda r: (r["o"], r["doc_id"]))
        taken = {k: [0, 0] for k in number}
        for r in rows:
            t = taken[r["label"]]
            if not t[0] or t[0] < most and t[1] + r["size"] <= max_bytes // (2 * len(number)):
                own.add(r["doc_id"])
                t[0], t[1], used = t[0] + 1, t[1] + r["size"], used + r["size"]
    chosen, left = {}, max_rows - len(own)
    for r in rows:
        if r["doc_id"] in own:
            chosen[r["doc_id"]] = (len(chosen), r["label"])
        elif left > 0 and (used + r["size"] <= max_bytes or not chosen and not own):
            chosen[r["doc_id"]] = (len(chosen), r["label"])
            used, left = used + r["size"], left - 1
    if not chosen:
        return []
    pick = spark.createDataFrame([(k,) for k in chosen], "doc_id long")
    got = {}
    for r in texts(docs).join(F.broadcast(pick), "doc_id").toLocalIterator():
        got[r["doc_id"]] = max(got.get(r["doc_id"], b""), bytes(r["text"] or b""))
    return [(got[k], chosen[k][1]) for k in sorted(got, key=lambda k: chosen[k][0])]


def first_rows(sized: DataFrame, number: dict, most: int) -> list:
    """At least the ``most`` first rows of every label in the order of the hash ``o``: those
    below a bound that several times as many are expected under (all, of a rare label)."""
    if not number:
        return []
    bounds = [(k, int(min(-2**63 + 2**64 * (4 * most + 40) // n, 2**63 - 1))) for k, n in number.items()]
    spark = sized.sparkSession
    kind = sized.schema["label"].dataType.simpleString()
    return (sized.join(F.broadcast(spark.createDataFrame(bounds, f"label {kind}, bound long")), "label")
            .where("o <= bound").drop("bound").collect())


# ASCII bytes that are no letter or digit become a space; upper case becomes lower case;
# bytes of other alphabets stay. ``split`` then cuts words at ASCII white space.
WORD_TABLE = bytes((c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32)
                   for c in range(256))


def words(raw: bytes) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters of the lower-cased text."""
    return raw.translate(WORD_TABLE).split()


def word_hashes(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """crc32 of every token of every list, and the offsets (len + 1) of the lists."""
    offsets = np.zeros(len(docs) + 1, np.int64)
    np.cumsum([len(d) for d in docs], out=offsets[1:])
    out = np.empty(int(offsets[-1]), np.uint32)
    for k, d in enumerate(docs):
        out[offsets[k]:offsets[k + 1]] = list(map(zlib.crc32, d))
    return out, offsets


def mix(h: np.ndarray, mult: int) -> np.ndarray:
    """Spread 32-bit hashes (multiply and shift; wraps around)."""
    x = h.astype(np.uint64) * np.uint64(mult)
    return x ^ (x >> np.uint64(29))


def segment_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of consecutive segments, zero for empty ones."""
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, dtype=np.float64, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file (the default of the ``path`` parameters)."""
    import public_tokenizers
    return public_tokenizers.path(name)
