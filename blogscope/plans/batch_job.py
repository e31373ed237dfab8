"""The whole batch run, stage by stage, with outputs reused when complete.

    python -m blogscope.plans.batch_job <sf_dir> <out_dir>

Stages (each a parquet folder under ``out_dir``, skipped when its ``_SUCCESS``
marker exists, and read back so later stages start from files, not lineage):

  blogs_en        English blogs: demographics + topic tokens
  tfidf_classes   TF-IDF path: per blog taxonomy key -> percent (X4)
  lda_classes     LDA path: per blog taxonomy key -> percent (X3)
  reports/<method>_{category,subcategory}_{scores,specificity}.parquet (+ .csv)
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

from ..operators import segments, taxonomy
from ..session import apply_conf, checkpoint_dir, drop_stages, get_session, materialize
from ..sources.tables import cached_stage, write_report
from . import lda_topics
from . import segment_topics as st


def reports(docs: DataFrame) -> dict[str, DataFrame]:
    """R1-R4 for one classification column (``scores`` map per blog)."""
    segs = segments.default_segments()
    out = {}
    for level in ("category", "subcategory"):
        # aggregated once; score and specificity reports are cut from the written stage
        scores = materialize(segments.segment_scores(docs, segs, "scores", level), f"{level}-scores")
        out[f"{level}_scores"] = segments.rank_within(scores, "average_weighted_score")
        out[f"{level}_specificity"] = segments.rank_within(segments.specificity(scores), "popularity_bias_score")
    return out


def run(spark: SparkSession, sf_dir: str, out_dir: str, methods=("tfidf", "lda")) -> dict[str, str]:
    apply_conf(spark)
    checkpoint_dir(spark)
    written = {}
    blogs = cached_stage(spark, os.path.join(out_dir, "blogs_en"),
                         lambda: st.english_tokens(spark, sf_dir), key=(sf_dir,))
    demo = segments.prepare_demographics(blogs.select("file_id", "gender", "age", "industry"))
    for method in methods:
        path = os.path.join(out_dir, f"{method}_classes")
        if method == "tfidf":
            build = lambda: st.classify_tokens(spark, sf_dir, blogs)
        else:
            build = lambda: lda_topics.classified(spark, sf_dir)
        classes = cached_stage(spark, path, build, key=(sf_dir, method))
        maps = taxonomy.classification_map(classes).withColumnRenamed("doc_id", "file_id")
        docs = demo.join(maps, "file_id", "left")
        for name, df in reports(docs).items():
            target = os.path.join(out_dir, "reports", f"{method}_{name}.parquet")
            write_report(df, target, ["demographic", "rank"])
            written[f"{method}_{name}"] = target
    return written


def main(argv: list[str]) -> None:
    sf_dir, out_dir = argv[1], argv[2]
    spark = get_session(master=None)  # spark-submit names it
    for k, v in run(spark, sf_dir, out_dir).items():
        print(k, v)
    drop_stages(spark)


if __name__ == "__main__":
    main(sys.argv)
