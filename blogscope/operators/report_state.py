"""Reports kept up to date batch by batch.

A batch of blogs adds one small table to the state: for every segment and classification the
sum of its shares and the number of rows, plus the segment's size on a row whose
classification is NULL. Sums are exact decimals, so the state after any number of batches, in
any order, is that of all blogs at once. Each batch owns a folder, complete once its marker is
there: a batch that is run again changes nothing, one that was cut off is written anew. Batches
must not share blogs (``skip_processed`` sees to that).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..sources.tables import stage_exists
from .segments import segment_names

STATE = "demographic STRING, level STRING, classification STRING, total DECIMAL(38,12), n LONG, batch STRING"


def batch_sums(docs: DataFrame, segments: dict[str, Column], scores_col: str = "scores") -> DataFrame:
    """(demographic, level, classification, total, n) of one batch, both levels in one pass.

    Entries are summed per combination of segments before they are copied to the segments."""
    both = F.flatten(F.transform(F.map_entries(scores_col), lambda e: F.array(
        F.struct(F.lit("category").alias("level"), tx.category_of(e["key"]).alias("key"), e["value"].alias("value")),
        F.struct(F.lit("subcategory").alias("level"), e["key"].alias("key"), e["value"].alias("value")))))
    marks = F.transform(F.array(F.lit("category"), F.lit("subcategory")), lambda x: F.struct(
        x.alias("level"), F.lit(None).cast("string").alias("key"), F.lit(0.0).alias("value")))
    rows = docs.select(segment_names(segments).alias("_segs"), F.explode(
        F.concat(F.coalesce(both, F.array().cast("array<struct<level:string,key:string,value:double>>")), marks)).alias("e"))
    share = (F.col("e.value").cast("decimal(24,12)") / 100).cast("decimal(28,12)")
    combined = rows.groupBy("_segs", F.col("e.level").alias("level"), F.col("e.key").alias("classification")).agg(
        F.sum(share).alias("total"), F.count(F.lit(1)).alias("n"))
    return (combined.select(F.explode("_segs").alias("demographic"), "level", "classification", "total", "n")
                    .groupBy("demographic", "level", "classification")
                    .agg(F.sum("total").cast("decimal(38,12)").alias("total"), F.sum("n").alias("n")))


def add_batch(docs: DataFrame, segments: dict[str, Column], state_dir: str, batch: str, scores_col: str = "scores") -> bool:
    """Add batch ``batch`` to the state; False if it was there already."""
    path = f"{state_dir}/batch={batch}"
    if stage_exists(docs.sparkSession, path):
        return False
    batch_sums(docs, segments, scores_col).write.mode("overwrite").parquet(path)
    return True


def report(spark: SparkSession, state_dir: str, level: str = "category") -> DataFrame:
    """A3/A4/A5 from the state: (demographic, classification, average_weighted_score), to be
    ranked or compared (``segments.rank_within``, ``segments.specificity``) like a full one."""
    s = spark.read.schema(STATE).parquet(state_dir).where(F.col("level") == level)
    s = s.groupBy("demographic", "classification").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    sizes = s.where(F.col("classification").isNull()).select("demographic", F.col("n").alias("_docs"))
    return s.where(F.col("classification").isNotNull()).join(sizes, "demographic").select(
        "demographic", "classification", (F.col("total").cast("double") / F.col("_docs")).alias("average_weighted_score"))
