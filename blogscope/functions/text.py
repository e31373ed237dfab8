"""Scalar text expressions (Catalyst built-ins only, no UDFs).

Regular expressions are written so Java (Spark) and RE2 read them the same way:
``\\s`` is spelled out as the ASCII class ``WS`` (RE2's ``\\s`` lacks \\x0B).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as lx

WS_CHARS = r" \t\n\x0B\f\r"          # regex spelling
WS_SET = " \t\n\x0b\f\r"              # the characters themselves
WS = f"[{WS_CHARS}]"
NON_WS = f"[^{WS_CHARS}]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Strip leading/trailing ASCII whitespace (plain ``trim`` only removes spaces)."""
    return F.trim(_c(col), F.lit(WS_SET))


def collapse_ws(col) -> Column:
    return F.trim(F.regexp_replace(_c(col), f"{WS}+", " "))


def clean_content(col) -> Column:
    """Every non-letter to space, literal junk/entities, whitespace collapsed.

    The entity replacements run after the letters-only step, so they never match
    (kept for parity; see ``clean_content_decoded`` for the useful order).
    """
    # Runs of non-letters (whitespace included) become one space: identical once
    # whitespace is collapsed, and afterwards only spaces remain, so the final
    # collapse only has to look for double spaces (left by removed words).
    c = F.regexp_replace(_c(col), "[^a-zA-Z]+", " ")
    for old, new in lx.CONTENT_LITERAL_REPLACEMENTS:
        c = F.replace(c, F.lit(old), F.lit(new))
    return F.trim(F.regexp_replace(c, " {2,}", " "))


def clean_content_decoded(col) -> Column:
    """P3 with entities decoded first, so ``amp``/``quot`` do not survive as words."""
    c = _c(col)
    for old, new in lx.CONTENT_LITERAL_REPLACEMENTS:
        c = F.replace(c, F.lit(old), F.lit(new))
    c = F.regexp_replace(c, f"[^a-zA-Z{WS_CHARS}]", " ")
    return collapse_ws(c)


def clean_industry(col) -> Column:
    """``indUnknown`` -> ``unknown``."""
    return F.replace(_c(col), F.lit("indUnknown"), F.lit("unknown"))


def clean_html(col) -> Column:
    """P5: tags to space, entities decoded in order, URLs and e-mails out, whitespace collapsed."""
    c = F.regexp_replace(_c(col), "<[^>]+>", " ")
    for old, new in lx.HTML_ENTITY_REPLACEMENTS:
        c = F.replace(c, F.lit(old), F.lit(new))
    c = F.regexp_replace(c, f"https?://{NON_WS}+", " ")
    c = F.regexp_replace(c, f"{NON_WS}+@{NON_WS}+", " ")
    return collapse_ws(c)


def clean_html_if_needed(col) -> Column:
    """P5, skipped when it is the identity: without '<', '&', ':', '@', non-space
    whitespace, double or edge spaces nothing in P5 can match (e.g. on P3 output)."""
    c = _c(col)
    return F.when(c.rlike(r"[<&:@\t\n\x0B\f\r]|  |^ | $"), clean_html(c)).otherwise(c)


def escape_stray_ampersands(col) -> Column:
    """S3/Q4: every ``&`` not starting amp;/lt;/gt;/apos;/quot; becomes ``&amp;``."""
    # Java has look-ahead but RE2 does not; the oracle side spells it differently.
    return F.regexp_replace(_c(col), "&(?!amp;|lt;|gt;|apos;|quot;)", "&amp;")


def decode_xml_entities(col) -> Column:
    c = _c(col)
    for old, new in lx.XML_ENTITY_REPLACEMENTS:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def letters_lower_tokens(col) -> Column:
    """T1 tokens: lower-case, keep a-z, split on whitespace (empty tokens removed)."""
    c = F.regexp_replace(F.lower(_c(col)), "[^a-z]+", " ")
    return F.filter(F.split(F.trim(c), " "), lambda t: t != "")


def word_tokens(col) -> Column:
    """Maximal runs of Unicode letters, in text order (original case)."""
    return F.regexp_extract_all(_c(col), F.lit(r"(\p{L}+)"), 1)


def stop_word_filter(tokens: Column, stop_words) -> Column:
    sw = list(stop_words)
    return F.filter(tokens, lambda t: ~t.isin(sw))


def age_group(age_col, unknown_age_as: str = lx.AGE_GT20) -> Column:
    """P8+P9: non-strict numeric cast, <=20 else >20 (unparsable/null -> ``unknown_age_as``)."""
    n = _c(age_col).try_cast("double")
    return (F.when(n.isNotNull() & (n <= 20), F.lit(lx.AGE_LE20))
            .when(n.isNotNull(), F.lit(lx.AGE_GT20))
            .otherwise(F.lit(unknown_age_as)))


def is_student(industry_col) -> Column:
    """P10: industry == 'Student' (NULL industry stays NULL: in neither segment)."""
    return _c(industry_col) == F.lit(lx.STUDENT_INDUSTRY)


def category_of(key_col) -> Column:
    """Part before the first ':' (whole string when there is none)."""
    return F.substring_index(_c(key_col), ":", 1)


def topic_label(words_col) -> Column:
    """First <=2 of the top-4 words longer than 3 chars, else first 2, else unknown_topic."""
    w = _c(words_col)
    meaningful = F.filter(F.slice(w, 1, 4), lambda x: F.length(x) > 3)
    return (F.when(w.isNull() | (F.size(w) == 0), F.lit(lx.UNKNOWN_TOPIC_LABEL))
            .when(F.size(meaningful) > 0, F.array_join(F.slice(meaningful, 1, 2), "_"))
            .otherwise(F.array_join(F.slice(w, 1, 2), "_")))


def tfidf_label(words_col) -> Column:
    """First two words joined by a space."""
    return F.array_join(F.slice(_c(words_col), 1, 2), " ")


def valid_topic_words(words_col) -> Column:
    """Trimmed length > 2 and no space-separated part of <= 2 chars."""
    return F.filter(
        _c(words_col),
        lambda w: (F.length(F.trim(w)) > 2)
        & F.forall(F.split(w, " "), lambda p: F.length(p) > 2))


def label_parts(label_col) -> Column:
    """Parts of a ``_``-joined label longer than 2 chars."""
    return F.filter(F.split(_c(label_col), "_"), lambda p: F.length(p) > 2)


def normalise_term(col) -> Column:
    """P19: '/' and '_' to space."""
    return F.translate(_c(col), "/_", "  ")


def phrase_words(col) -> Column:
    """A phrase as lower-cased words (``_`` counts as a space)."""
    return F.filter(F.split(F.lower(F.translate(_c(col), "_", " ")), " "), lambda t: t != "")
