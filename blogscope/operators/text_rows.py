"""Votes, tokens, sentences and segments of texts in Arrow batches.

The same rows as the column expressions of ``language.detect_language``, ``terms.topic_tokens_of_clean`` of
``text.clean_content`` and ``terms.sentences``, many texts at a time: runs of word bytes are found by
numpy, and what depends on a word alone (its clean form, its length, whose function word it is) is worked
out once per distinct word. Texts are looked at in parts of ``PART_BYTES``, or one text.
"""

from __future__ import annotations

import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions import lexicon as lx

PART_BYTES = 1 << 22
MIN_CHARS = 10  # of a text's words and the spaces between them, for a vote
REMOVED = [a for a, b in lx.CONTENT_LITERAL_REPLACEMENTS if a.isalpha()]  # after the letters-only step nothing else can match
STOP_WORDS = list(lx.ENGLISH_STOP_WORDS)
LANGUAGES = {lang: list(words) for lang, words in sorted(lx.LANGUAGE_STOP_WORDS.items())}

ASCII_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
SENTENCE_END = np.isin(np.arange(256), list(b".!?"))
# 1: an ASCII byte of a word; 2: begins two bytes below U+0240; 3: goes on; 4: E2; 5: begins anything else
KIND = np.array([int(chr(b).isalnum() or b == 95) if b < 128 else 3 if b < 0xC0 else 2 if 0xC2 <= b <= 0xC8 else 4 if b == 0xE2 else 5
                 for b in range(256)], np.uint8)
LATIN_WORD = np.array([unicodedata.category(chr(c))[0] in "LN" for c in range(0x240)])
DOTTED_I = 0x130  # the only one of these whose lower case is no single letter


def text_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls are empty."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    data = texts.buffers()[2]
    body = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return body, offsets - offsets[0]


def runs(body: np.ndarray, offsets: np.ndarray, mask: np.ndarray):
    """(the runs of ``mask`` inside each text as strings, how many of them lie before each offset)."""
    new = np.empty(len(mask), bool)
    new[:1] = True
    np.logical_not(mask[:-1], out=new[1:])
    new[offsets[offsets < len(mask)]] = True
    begin = np.flatnonzero(new[mask])
    bounds = np.searchsorted(np.flatnonzero(new & mask), offsets)
    data = body[mask]
    ends = np.append(begin, len(data)).astype(np.int32)
    return pa.StringArray.from_buffers(len(begin), pa.py_buffer(ends), pa.py_buffer(data)), bounds


def clean_words(texts):
    """(codes, words, bounds): the T2 tokens of cleaned texts, one text after the other."""
    body, offsets = text_bytes(texts)
    found, bounds = runs(body, offsets, ASCII_LETTER[body])
    coded = found.dictionary_encode()
    codes, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    for x in REMOVED:
        words = pc.replace_substring(words, x, "")
    words = pc.ascii_lower(words)
    keep = pc.and_(pc.greater_equal(pc.binary_length(words), 3), pc.invert(pc.is_in(words, pa.array(STOP_WORDS, pa.string()))))
    on = keep.to_numpy(zero_copy_only=False)[codes] if len(words) else np.zeros(0, bool)
    return codes[on], words, np.append(0, np.cumsum(on))[bounds]


def votes(texts) -> np.ndarray:
    """The number of the language of every text in ``LANGUAGES``, -1 where there is none."""
    body, offsets = text_bytes(texts)
    kind = KIND[body]
    mask, odd = kind == 1, np.zeros(len(texts), bool)
    if kind.max(initial=0) > 1:
        def mark(at):
            odd[np.searchsorted(offsets, at, side="right") - 1] = True

        mark(np.flatnonzero(kind == 5))
        at = np.flatnonzero(kind == 2)
        cut = at + 1 >= len(body)
        mark(at[cut])
        at = at[~cut]
        code = (body[at] & 31).astype(np.int32) << 6 | body[at + 1] & 63
        mark(at[code == DOTTED_I])
        at = at[LATIN_WORD[code]]
        mask[at] = mask[at + 1] = True
        at = np.flatnonzero(kind == 4)
        mark(at[(at + 1 >= len(body)) | (body[np.minimum(at + 1, len(body) - 1)] != 0x80)])  # U+2000 to U+203F holds no word
    found, bounds = runs(body, offsets, mask)
    coded = found.dictionary_encode()
    codes, words = coded.indices.to_numpy(zero_copy_only=False), pc.utf8_lower(coded.dictionary)

    def per_text(values):
        return np.diff(np.append(0, np.cumsum(values.to_numpy(zero_copy_only=False).astype(np.int64)[codes]))[bounds]) if len(words) else np.zeros(len(texts), np.int64)

    hits = np.stack([per_text(pc.is_in(words, pa.array(w, pa.string()))) for w in LANGUAGES.values()])
    chars = per_text(pc.add(pc.utf8_length(words), 1)) - 1
    for i in np.flatnonzero(odd):
        own = re.findall(r"\w+", (texts[int(i)].as_py() or "").lower())
        hits[:, i] = [sum(w in words for w in own) for words in map(set, LANGUAGES.values())]
        chars[i] = sum(len(w) + 1 for w in own) - 1
    return np.where((chars >= MIN_CHARS) & (hits.max(axis=0) > 0), hits.argmax(axis=0), -1)


def sentence_lists(texts, min_chars: int):
    """An array of the sentences of every text."""
    body, offsets = text_bytes(texts)
    space = SPACE[body]
    cut = np.zeros(len(body), bool)
    cut[1:] = space[1:] & SENTENCE_END[body[:-1]]
    cut[offsets[offsets < len(body)]] = True
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(body))
    solid = np.flatnonzero(~space)
    lo, hi = np.searchsorted(solid, first), np.searchsorted(solid, last)
    first, last = solid[lo[hi > lo]], solid[hi[hi > lo] - 1] + 1
    chars = np.append(0, np.cumsum(body & 0xC0 != 0x80))
    long = chars[last] - chars[first] >= min_chars
    first, last = first[long], last[long]
    ends = np.append(np.stack([first, last], axis=1).ravel(), len(body)).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(body)).take(pa.array(np.arange(0, 2 * len(first), 2)))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(first, offsets), pa.int32()), pieces)


def token_lists(texts):
    codes, words, bounds = clean_words(texts)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words.take(pa.array(codes)))


def parts(batch, column: str, most: int):
    """Slices of a batch whose texts hold ``most`` bytes together, or one text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    before, lo = np.append(0, np.cumsum(sizes)), 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(before, before[lo] + most, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def texts_of(df: DataFrame, column: str, language: str = "en", tokens: bool = True, sentences: bool = True, min_chars: int = 21) -> DataFrame:
    """The rows whose ``column`` is voted to be in ``language``: the other columns, then ``tokens`` and
    ``sentences`` of the text."""
    rest = [c for c in df.columns if c != column]
    strings = T.ArrayType(T.StringType())
    made = [*["tokens"] * tokens, *["sentences"] * sentences]
    wanted = list(LANGUAGES).index(language)

    def run(batches):
        for batch in (p for b in batches for p in parts(b, column, PART_BYTES)):
            own = batch.filter(pa.array(votes(batch.column(column)) == wanted))
            if own.num_rows:
                texts = own.column(column)
                out = [*[token_lists(texts)] * tokens, *[sentence_lists(texts, min_chars)] * sentences]
                yield pa.RecordBatch.from_arrays([*[own.column(c) for c in rest], *out], names=[*rest, *made])
    return df.select(*rest, column).mapInArrow(run, T.StructType([*[df.schema[c] for c in rest], *[T.StructField(c, strings) for c in made]]))


# --- segments --------------------------------------------------------------------------


def ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """first[0], ..., last[0] - 1, first[1], ..."""
    n = last - first
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)


def chunks(sizes: np.ndarray, width: int, step: int):
    """(list, first, last) of the chunks of lists of ``sizes``: ``width`` wide at most, one every ``step``."""
    n = -(-sizes // step)
    of = np.repeat(np.arange(len(sizes)), n)
    first = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * step
    return of, first, np.minimum(first + width, sizes[of])


def segment_rows(batch, min_topic_size: int, window: int, step: int):
    """(doc_id, seg_id, tokens) of rows (doc_id, sentences, tokens)."""
    def lists(name):
        c = batch.column(name)
        sizes = pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        return sizes, np.cumsum(sizes) - sizes, c.flatten()

    sizes, start, texts = lists("sentences")
    body, offsets = text_bytes(texts)
    words = np.diff(runs(body, offsets, ~SPACE[body])[1])
    codes, terms, bounds = clean_words(texts)
    of, first, last = chunks(sizes, 3, 2)
    first, last = first + start[of], last + start[of]
    total = np.append(0, np.cumsum(words))
    on = np.maximum(total[last] - total[first], 1) >= min_topic_size
    of, first, last = of[on], bounds[first[on]], bounds[last[on]]
    few = np.bincount(of, minlength=len(sizes)) < 3
    if few.any():  # windows of tokens, cleaned like any text
        sizes, start, own = lists("tokens")
        at = np.flatnonzero(few)
        codes2, terms2, bounds2 = clean_words(own.take(pa.array(ranges(start[at], start[at] + sizes[at]))))
        start = np.cumsum(sizes[at]) - sizes[at]
        of2, first2, last2 = chunks(sizes[at], window, step)
        on = last2 - first2 >= min_topic_size
        of2, first2, last2 = of2[on], first2[on] + start[of2[on]], last2[on] + start[of2[on]]
        first, last = (np.append(a, bounds2[b] + len(codes)) for a, b in ((first, first2), (last, last2)))
        of = np.append(of, at[of2])
        codes, terms = np.append(codes, codes2 + len(terms)), pa.concat_arrays([terms, terms2])
        order = np.argsort(of, kind="stable")
        of, first, last = of[order], first[order], last[order]
    on = np.bincount(of, minlength=len(sizes))[of] >= 2
    of, first, last = of[on], first[on], last[on]
    ends = np.append(0, np.cumsum(last - first))
    place = np.arange(len(of)) - np.searchsorted(of, of)
    tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), terms.take(pa.array(codes[ranges(first, last)])))
    return pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(of)), pa.array(place, pa.int32()), tokens], names=["doc_id", "seg_id", "tokens"])


def segments(blogs: DataFrame, min_topic_size: int, window: int, step: int, rows: int = 256) -> DataFrame:
    """W6 + W7 of (doc_id, sentences, tokens), ``rows`` blogs at a time."""
    schema = T.StructType([blogs.schema["doc_id"], T.StructField("seg_id", T.IntegerType()), T.StructField("tokens", T.ArrayType(T.StringType()))])

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, rows):
                yield segment_rows(b.slice(lo, rows), min_topic_size, window, step)
    return blogs.select("doc_id", "sentences", "tokens").mapInArrow(run, schema)


def count_rows(batch, tokens: str, most: int = 1 << 20):
    """Batches (the other columns, terms, weights) of the rows that have tokens, ``most`` tokens or one row at a time."""
    sizes = pc.fill_null(pc.list_value_length(batch.column(tokens)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    before, lo = np.append(0, np.cumsum(sizes)), 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(before, before[lo] + most, side="right")) - 1)
        own, n = batch.slice(lo, hi - lo), sizes[lo:hi]
        coded = own.column(tokens).flatten().dictionary_encode()
        codes = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        width = len(coded.dictionary) + 1
        key, count = np.unique((np.repeat(np.arange(len(n)), n) * width + codes)[codes >= 0], return_counts=True)
        row, first = np.unique(key // width, return_index=True)
        ends, names = pa.array(np.append(first, len(key)), pa.int32()), [c for c in own.schema.names if c != tokens]
        yield pa.RecordBatch.from_arrays([*[own.column(c).take(pa.array(row)) for c in names],
                                          pa.ListArray.from_arrays(ends, coded.dictionary.take(pa.array(key % width))),
                                          pa.ListArray.from_arrays(ends, pa.array(count, pa.float64()))], names=[*names, "terms", "weights"])
        lo = hi


def token_counts(df: DataFrame, key: list[str], tokens: str) -> DataFrame:
    """A8 with a row per row that has tokens: (key..., terms, weights), its distinct tokens and how often each occurs."""
    def run(batches):
        for b in batches:
            yield from count_rows(b, "_tokens")
    return df.select(*key, df[tokens].alias("_tokens")).mapInArrow(run, T.StructType([
        *[df.schema[k] for k in key], T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("weights", T.ArrayType(T.DoubleType()))]))


# executors need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
