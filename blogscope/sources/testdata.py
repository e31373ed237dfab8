"""How the driver's tables stand in for the blog corpus (see FIXTURES.md).

* ``documents`` left-joined to ``labels`` -> blogs with demographics:
  gender from ``quality`` (1 male, 0 female), age from the text length (``toxic``
  rows get an unparsable age), industry from ``source``; every demographic is
  NULL for unlabelled documents, which exercises the NULL rules (Q7, Q8).
* ``embeddings`` -> word vectors: a word takes the vector whose ``vec_id`` is the
  first 32 bits of its md5, modulo the number of vectors (same in SQL).
* ``pages`` -> raw files (metadata in the URL host, repeated ``<p>`` elements).
* ``conversations`` -> posts (``conv_id`` = blog, ``turn`` = order).

Every expression here has a twin in the oracle SQL of ``__spark_entry__.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# FIXED VALUES: sources mapped to industries.
STUDENT_SOURCES = ["src0", "src5", "src10", "src15"]
UNKNOWN_INDUSTRY_SOURCES = ["src9", "src19"]


def blogs_with_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_id, content, gender, age, industry, source, lang, n_chars)."""
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").select(
        "doc_id", "quality", "toxic", F.lit(True).alias("_labelled"))
    # labels is at most one row per document: AQE picks broadcast or shuffle by its measured size
    j = docs.join(labels, "doc_id", "left")
    lab = F.col("_labelled").isNotNull()
    gender = F.when(F.col("quality") == 1, "male").when(F.col("quality") == 0, "female")
    age = (F.when(~lab, F.lit(None).cast("string"))
            .when(F.col("toxic") == 1, F.lit("unknown"))
            .otherwise((F.lit(13) + F.col("n_chars") % 37).cast("string")))
    industry = (F.when(~lab, F.lit(None).cast("string"))
                 .when(F.col("source").isin(STUDENT_SOURCES), F.lit("Student"))
                 .when(F.col("source").isin(UNKNOWN_INDUSTRY_SOURCES), F.lit("indUnknown"))
                 .otherwise(F.concat(F.lit("Industry"), F.substring("source", 4, 10))))
    return j.select(F.col("doc_id").alias("file_id"), F.col("text").alias("content"),
                    gender.alias("gender"), age.alias("age"), industry.alias("industry"),
                    "source", "lang", "n_chars")


def word_index(word: Column, n_vectors: Column) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("long"), n_vectors)


def hashed_lookup(embeddings: DataFrame, letters: int | None = None):
    """S10/J3 as a lookup function: rows get the vector of ``pmod(md5 prefix, n)``, of the
    word or of its first ``letters``.
    The embedding table is a dimension (thousands of rows); AQE broadcasts it."""
    n = embeddings.select(F.count(F.lit(1))).scalar()
    dim = embeddings.select("vec_id", F.col("embedding").alias("vec"))

    def lookup(df: DataFrame, word_col: str = "word") -> DataFrame:
        keyed = df.withColumn("_vec_id", word_index(F.substring(word_col, 1, letters) if letters else F.col(word_col), n))
        return keyed.join(dim.withColumnRenamed("vec_id", "_vec_id"), "_vec_id").drop("_vec_id")
    return lookup


def posts_from_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts in the shape of the XML extraction: (file_id, pos, date, content, role)."""
    conv = read_table(spark, sf_dir, "conversations")
    return conv.select(F.col("conv_id").alias("file_id"), F.col("turn").alias("pos"),
                       F.lit(None).cast("timestamp").alias("date"), F.col("text").alias("content"), "role")


def pages_as_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as raw files: the URL host plays the dotted file name."""
    pages = read_table(spark, sf_dir, "pages")
    host = F.regexp_extract("url", r"^[a-zA-Z]+://([^/?#]+)", 1)
    return pages.select("page_id", "url", host.alias("file_name"), "html")
