"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC timestamps (dates are epoch based), AQE for
# runtime coalescing and skew-join splitting, and no UI server.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[8]", shuffle_partitions: int | None = None,
                app_name: str = "blogscope", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster ``master`` comes from spark-submit; pass ``master=None`` to keep it. The
    number of shuffle partitions is the cluster's too unless it is given.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable defaults to a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Where it is unset, a session on one machine gets a private folder (tests); on a cluster
    that folder would be a different one on every executor, so it is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="blogscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


_STAGES: list[str] = []


def materialize(df, name: str, compression: str = "snappy", by: str | None = None):
    """Write ``df`` once as parquet under the shared checkpoint folder and read it
    back: the work runs once (``checkpoint(eager=True)`` on an unpersisted plan
    computes it twice: once to count, once to write), lineage is cut, and a lost
    executor re-reads files instead of recomputing. ``drop_stages`` deletes them. A folder per value
    of the last column, if ``by`` names it, lets what asks for one value read no other."""
    base = checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    w = df.write.option("compression", compression)
    (w.partitionBy(by) if by else w).parquet(path)
    _STAGES.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def last_stage() -> str:
    """The path of the newest stage."""
    return _STAGES[-1]


def drop_stage(spark: SparkSession, path: str) -> None:
    """Delete one stage that nothing reads any more. Plans that are gone are collected here and in
    the JVM, upon which Spark deletes their shuffle files: in a loop of many stages they
    would otherwise stay until the driver happens to collect."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    _STAGES.remove(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stages_so_far() -> int:
    return len(_STAGES)


def drop_stages(spark: SparkSession, keep: int = 0) -> int:
    """Delete the stages written so far (at the end of a job) but the first ``keep``; returns how many."""
    jvm, conf, n = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    while len(_STAGES) > keep:
        p = jvm.org.apache.hadoop.fs.Path(_STAGES.pop())
        n += bool(p.getFileSystem(conf).delete(p, True))
    return n
