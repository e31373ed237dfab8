"""Raw blog files: metadata from file names, posts from lenient XML.

A file is named ``timestamp.gender.age.industry.sign.xml`` and holds repeated
``<date>d,month,yyyy</date><post>text</post>`` pairs, often malformed (stray
``&``, invalid UTF-8). Everything is column expressions over the
``binaryFile`` source: no per-file Python, one task per file split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import text as tx

META_PARTS = ["scrapping_timestamp", "gender", "age", "industry", "star_sign"]


def list_files(spark: SparkSession, folder: str, glob: str = "*.xml") -> DataFrame:
    """The files of a folder with their bytes (path, content BINARY)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                 .load(folder).select("path", "content"))


def metadata_from_name(name_col) -> list[Column]:
    """The five dot-separated parts of a file stem; missing parts are NULL (Q2)."""
    c = F.col(name_col) if isinstance(name_col, str) else name_col
    parts = F.split(c, r"\.")
    cols = [F.get(parts, i).alias(n) for i, n in enumerate(META_PARTS[:4])]
    cols.append(F.regexp_replace(F.get(parts, 4), r"\.xml$", "").alias("star_sign"))
    return cols


def file_stem(path_col) -> Column:
    """Last path segment without the ``.xml`` extension."""
    c = F.col(path_col) if isinstance(path_col, str) else path_col
    return F.regexp_replace(F.substring_index(c, "/", -1), r"\.xml$", "")


def file_id(*cols) -> Column:
    """A stable 64-bit id of the metadata parts (the original hash was salted per run, Q1)."""
    return F.xxhash64(*cols)


def files_table(files: DataFrame, path_col: str = "path") -> DataFrame:
    """S1+S2: (id, scrapping_timestamp, gender, age, industry, star_sign, file_path)."""
    named = files.select(F.col(path_col).alias("file_path"), *metadata_from_name(file_stem(path_col)))
    return named.select(file_id(*META_PARTS).alias("id"), *META_PARTS, "file_path")


def bytes_to_text(content_col) -> Column:
    """Invalid UTF-8 sequences replaced by U+FFFD."""
    c = F.col(content_col) if isinstance(content_col, str) else content_col
    return F.make_valid_utf8(c.cast("string")) if hasattr(F, "make_valid_utf8") else c.cast("string")


def element_texts(text_col, tag: str) -> Column:
    """Inner text of every ``<tag>`` element: tags inside removed, entities decoded, trimmed."""
    c = F.col(text_col) if isinstance(text_col, str) else text_col
    raw = F.regexp_extract_all(c, F.lit(rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), 1)
    return F.transform(raw, lambda t: tx.strip_ws(tx.decode_xml_entities(F.regexp_replace(t, "<[^>]*>", ""))))


def posts_from_text(df: DataFrame, id_col: str, text_col: str,
                    date_tag: str = "date", post_tag: str = "post") -> DataFrame:
    """S3 (+Q4, Q5): ``(file_id, pos, date_text, content)``; dates and posts paired by
    position, the longer list truncated; a file with nothing parsable gives no rows."""
    fixed = tx.escape_stray_ampersands(F.col(text_col))
    dates = element_texts(fixed, date_tag)
    posts = element_texts(fixed, post_tag)
    pairs = F.arrays_zip(dates.alias("d"), posts.alias("p"))
    n = F.least(F.size(dates), F.size(posts))
    return (df.select(F.col(id_col).alias("file_id"), pairs.alias("_z"), n.alias("_n"))
              .select("file_id", "_n", F.posexplode("_z").alias("pos", "_x"))
              .where(F.col("pos") < F.col("_n"))
              .select("file_id", "pos", F.col("_x.d").alias("date_text"), F.col("_x.p").alias("content")))


def month_number(name_col) -> Column:
    """Month name (any listed language, any case) -> 1..12, NULL if unknown.
    The dimension is a fixed 48-entry list, so it is inlined as a literal map."""
    pairs = sorted({(name, i + 1) for names in lx.MONTH_NAMES.values() for i, name in enumerate(names)})
    m = F.create_map(*[F.lit(x) for kv in pairs for x in kv])
    c = F.col(name_col) if isinstance(name_col, str) else name_col
    return F.element_at(m, F.lower(tx.strip_ws(c)))


def parse_day_first_date(col) -> Column:
    """``day,month,year`` with the month as a name (several languages) or a
    number -> TIMESTAMP (UTC midnight); NULL when it cannot be read."""
    c = F.col(col) if isinstance(col, str) else col
    parts = F.split(tx.strip_ws(F.regexp_replace(c, ",", " ")), f"{tx.WS}+")
    day = F.get(parts, 0).try_cast("int")
    mon = F.coalesce(month_number(F.get(parts, 1)), F.get(parts, 1).try_cast("int"))
    year = F.get(parts, 2).try_cast("int")
    ok = (F.size(parts) == 3) & day.isNotNull() & mon.isNotNull() & year.isNotNull()
    return F.when(ok, F.try_make_timestamp(year, mon, day, F.lit(0), F.lit(0), F.lit(0)))


def blogs_from_posts(posts: DataFrame, key: str = "file_id", order_cols: list[str] | None = None,
                     content: str = "content", date: str | None = "date") -> DataFrame:
    """A1: posts -> one row per blog: content joined by a blank line in order
    (date, nulls first, then position), post count, total characters, first and
    last date (only when the posts have a date)."""
    order = order_cols or ([date, "pos"] if date else ["pos"])
    by = ", ".join(f"`{o}` ASC NULLS FIRST" for o in order)
    aggs = [F.expr(f"listagg(`{content}`, '\\n\\n') WITHIN GROUP (ORDER BY {by})").alias("content"),
            F.count(F.lit(1)).alias("post_count"),
            F.sum(F.length(content)).alias("total_content_length")]
    if date:
        aggs += [F.min(date).alias("earliest_post_date"), F.max(date).alias("latest_post_date")]
    return posts.groupBy(key).agg(*aggs)
