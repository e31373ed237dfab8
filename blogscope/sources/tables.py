"""Parquet/CSV sources and sinks, stage reuse."""

from __future__ import annotations

import hashlib
import os
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


# tables whose rows carry whole texts, and the setting that deals them out
TEXT_TABLES = {"documents", "pages", "conversations", "benchmark"}
DEAL_SETTING = "spark.blogscope.textTasks"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a scale-factor folder (column pruning and filter
    pushdown are left to the scan).

    A split never cuts a parquet row group. For text tables laid out as one large row
    group (the bench's), the session may name a number of tasks in ``DEAL_SETTING`` to deal
    the rows to; unset, as on a cluster whose files have many row groups, nothing moves.
    """
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    tasks = spark.conf.get(DEAL_SETTING, None)
    return df.repartition(int(tasks)) if tasks and name in TEXT_TABLES else df


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """A single file, a folder or a list of partition files."""
    return spark.read.parquet(*paths)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """Parquet (snappy, statistics by default); folders created by the writer."""
    w = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header next to a parquet output (nested columns as JSON text)."""
    flat = df.select(*[F.to_json(c).alias(c) if isinstance(t, (str,)) and t.startswith(("array", "map", "struct"))
                       else F.col(c) for c, t in df.dtypes])
    flat.write.mode(mode).option("header", True).csv(path)


def write_report(df: DataFrame, path: str, sort_cols: list[str] | None = None) -> None:
    """R1-R4 sinks: parquet plus a CSV twin (``path`` without extension + .csv), the CSV
    from the parquet just written."""
    write_parquet(df.orderBy(*sort_cols) if sort_cols else df, path)
    base, _ = os.path.splitext(path)
    write_csv(df.sparkSession.read.parquet(path), base + ".csv")


def stage_exists(spark: SparkSession, path: str) -> bool:
    """A stage output is complete when its ``_SUCCESS`` marker exists (any FS)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def cached_stage(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                 partition_by: list[str] | None = None, key: tuple = ()) -> DataFrame:
    """Read the stage output when it is complete, else compute, write and read it.

    Reading back the written table also cuts the lineage for later stages. ``key`` holds
    what the output depends on (input folder, parameters); its digest is part of the path,
    so that another input or parameter never meets an old output.
    """
    if key:
        path = f"{path}-{hashlib.md5(repr(key).encode()).hexdigest()[:12]}"
    if not stage_exists(spark, path):
        write_parquet(build(), path, partition_by=partition_by)
    return spark.read.parquet(path)


def decode_json_map(col, value_type: str = "double"):
    """JSON object text -> MAP<STRING, value_type>; malformed or NULL -> NULL (Q11)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, f"map<string,{value_type}>", {"mode": "PERMISSIVE"})


def encode_json(col):
    """Nested value -> JSON text (only at an export edge)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_json(c)


def read_word_vectors(spark: SparkSession, path: str, dims: int) -> DataFrame:
    """A text file of word vectors (word, then numbers, separated by spaces) as
    (word, vec ARRAY<FLOAT>); lines with another number of fields or a field that is no
    number are left out."""
    f = F.split("value", " ")
    rows = spark.read.text(path).where(F.size(f) == dims + 1)
    vec = F.transform(F.slice(f, 2, dims), lambda x: x.try_cast("float"))
    return (rows.select(F.get(f, 0).alias("word"), vec.alias("vec"))
                .where((F.col("word") != "") & F.forall("vec", lambda x: x.isNotNull())))


def attach_metadata(facts: DataFrame, files: DataFrame, fact_key: str = "file_id",
                    file_key: str = "id") -> DataFrame:
    """Left join of posts/blogs to file metadata. The files table (one row per
    file) is small next to the text; AQE turns this into a broadcast join when the
    measured side is under the threshold and keeps a shuffle join otherwise."""
    return facts.join(files.withColumnRenamed(file_key, fact_key), fact_key, "left")


def skip_processed(todo: DataFrame, done: DataFrame, key: str = "file_id") -> DataFrame:
    """J2 (+A7): rows whose key is not among the already processed ids."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def union_results(*parts: DataFrame) -> DataFrame:
    """Previous + new results by column name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def require_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Fail early (on the driver, from the schema only) when a column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"DataFrame must contain {missing}")
    return df


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """An ordered ``limit`` (deterministic, unlike a bare limit)."""
    return df.orderBy(*order).limit(n) if n > 0 else df
