"""DuckDB twins of the registered queries (tables are pre-registered views).

Each Spark query in ``__spark_entry__.py`` has its SQL here, written from the
same definitions: the CTE fragments below mirror the library functions one to
one (demographics adapter, language vote, clean-up, tokens, TF-IDF, hashed word
vectors, taxonomy scoring, segments). Floating results are rounded the same way
on both sides (scores 6 digits, percentages 2) before ranking.
"""

from __future__ import annotations

from blogscope.functions import lexicon as lx
from blogscope.sources import testdata as td

WS = r" \t\n\x0B\f\r"


def _q(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _replace_chain(expr: str, pairs) -> str:
    for old, new in pairs:
        expr = f"replace({expr}, '{old.replace(chr(39), chr(39) * 2)}', '{new.replace(chr(39), chr(39) * 2)}')"
    return expr


def collapse(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '[{WS}]+', ' ', 'g'))"


def clean_content(expr: str) -> str:
    e = f"regexp_replace({expr}, '[^a-zA-Z{WS}]+', ' ', 'g')"
    return collapse(_replace_chain(e, lx.CONTENT_LITERAL_REPLACEMENTS))


def clean_html(expr: str) -> str:
    e = f"regexp_replace({expr}, '<[^>]+>', ' ', 'g')"
    e = _replace_chain(e, lx.HTML_ENTITY_REPLACEMENTS)
    e = f"regexp_replace({e}, 'https?://[^{WS}]+', ' ', 'g')"
    e = f"regexp_replace({e}, '[^{WS}]+@[^{WS}]+', ' ', 'g')"
    return collapse(e)


def topic_tokens(expr: str) -> str:
    return (f"list_transform(list_filter(regexp_extract_all({expr}, '(\\p{{L}}+)', 1), "
            f"lambda t: length(t) >= 3 AND lower(t) NOT IN ({_q(lx.ENGLISH_STOP_WORDS)})), lambda t: lower(t))")


def vote_clean(expr: str) -> str:
    return collapse(f"regexp_replace({expr}, '[^\\p{{L}}\\p{{N}}_{WS}]', ' ', 'g')")


def detect_language(expr: str) -> str:
    toks = f"string_split(lower({vote_clean(expr)}), ' ')"
    counts = {lang: f"len(list_filter({toks}, lambda x: x IN ({_q(ws)})))"
              for lang, ws in sorted(lx.LANGUAGE_STOP_WORDS.items())}
    m = "greatest(" + ", ".join(counts.values()) + ")"
    best = "CASE WHEN " + m + " = 0 THEN 'unknown' " + " ".join(
        f"WHEN {c} = {m} THEN '{lang}'" for lang, c in counts.items()) + " END"
    return (f"CASE WHEN {expr} IS NULL OR length(trim({expr}, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) < 3 "
            f"THEN 'unknown' WHEN length({vote_clean(expr)}) < 10 THEN 'unknown' ELSE {best} END")


def blogs_cte() -> str:
    """Documents with demographics (adapter), language, clean content, P4, English only."""
    return f"""
blogs_raw AS (
  SELECT d.doc_id AS file_id, d.text AS content,
    CASE WHEN l.quality = 1 THEN 'male' WHEN l.quality = 0 THEN 'female' END AS gender,
    CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.toxic = 1 THEN 'unknown'
         ELSE CAST(13 + d.n_chars % 37 AS VARCHAR) END AS age,
    CASE WHEN l.doc_id IS NULL THEN NULL
         WHEN d.source IN ({_q(td.STUDENT_SOURCES)}) THEN 'Student'
         WHEN d.source IN ({_q(td.UNKNOWN_INDUSTRY_SOURCES)}) THEN 'indUnknown'
         ELSE 'Industry' || substr(d.source, 4, 10) END AS industry
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
blogs_lang AS (
  SELECT file_id, gender, age, replace(industry, 'indUnknown', 'unknown') AS industry,
         {detect_language('content')} AS content_language,
         {clean_content('content')} AS content
  FROM blogs_raw),
blogs AS MATERIALIZED (SELECT * FROM blogs_lang WHERE content_language = 'en'),
demo AS MATERIALIZED (
  SELECT file_id, gender,
    CASE WHEN TRY_CAST(age AS DOUBLE) IS NOT NULL AND TRY_CAST(age AS DOUBLE) <= 20 THEN '<=20'
         ELSE '>20' END AS age_group,
    industry = 'Student' AS is_student
  FROM blogs)"""


def tfidf_cte(top_n: int = 5, max_features: int = 1000) -> str:
    return f"""
tok AS (SELECT file_id AS doc_id, unnest({topic_tokens(clean_html('content'))}) AS term FROM blogs),
tc AS (SELECT doc_id, term, count(*) AS cnt FROM tok GROUP BY doc_id, term),
tk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY cnt DESC, term ASC) AS fr FROM tc),
kept AS (SELECT doc_id, term, cnt FROM tk WHERE fr <= {max_features}),
tw AS (SELECT doc_id, term, cnt / sqrt(sum(cnt * cnt) OVER (PARTITION BY doc_id)) AS weight FROM kept),
tr AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term DESC) AS pos FROM tw),
topic_words AS MATERIALIZED (SELECT doc_id, term AS word, weight, pos FROM tr WHERE pos <= {top_n} AND weight > 0),
topics AS MATERIALIZED (SELECT doc_id, avg(weight) AS topic_quality,
                  string_agg(word, ' ' ORDER BY pos) AS words_text, count(*) AS n_words
           FROM topic_words GROUP BY doc_id)"""


def taxonomy_values() -> str:
    rows, i = [], 0
    for major, subs in lx.FALLBACK_TAXONOMY.items():
        for s in subs:
            rows.append(f"({i}, '{major}', '{s}')")
            i += 1
    return "VALUES " + ", ".join(rows)


def classification_cte(min_similarity: float = 0.10, top_n: int = 25) -> str:
    """W5 + X2 + X1 + J4 + X4 on the TF-IDF topics, hashed word vectors."""
    return f"""
nvec AS (SELECT count(*) AS n FROM embeddings),
thr AS (SELECT doc_id, CASE WHEN count(*) > 3 THEN quantile_cont(weight, 0.6) ELSE min(weight) END AS t
        FROM topic_words GROUP BY doc_id),
passing AS (SELECT w.doc_id, count(*) FILTER (WHERE w.weight >= thr.t) AS n_pass
            FROM topic_words w JOIN thr USING (doc_id) GROUP BY w.doc_id),
sel AS (SELECT w.* FROM topic_words w JOIN thr USING (doc_id) JOIN passing USING (doc_id)
        WHERE (passing.n_pass >= 3 AND w.weight >= thr.t) OR (passing.n_pass < 3 AND w.pos <= 3)),
wv AS (SELECT s.doc_id, s.weight * (0.5 + 0.2) AS cw, CAST(e.embedding AS DOUBLE[]) AS v
       FROM sel s CROSS JOIN nvec
       JOIN embeddings e ON e.vec_id = ('0x' || substr(md5(s.word), 1, 8))::BIGINT % nvec.n),
wv_long AS (SELECT doc_id, cw, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM wv),
tv_long AS (SELECT doc_id, i, sum(cw * x) / sum(cw) AS x FROM wv_long GROUP BY doc_id, i),
tv AS (SELECT doc_id, list(x ORDER BY i) AS vec FROM tv_long GROUP BY doc_id),
tax AS (SELECT * FROM ({taxonomy_values()}) t(ord, major, subtopic)),
sv AS (SELECT t.ord, t.major, t.subtopic, CAST(e.embedding AS DOUBLE[]) AS vec
       FROM tax t CROSS JOIN nvec JOIN embeddings e ON e.vec_id = ('0x' || substr(md5(t.subtopic), 1, 8))::BIGINT % nvec.n),
cosines AS (SELECT tv.doc_id, sv.ord, sv.major || ':' || sv.subtopic AS classification,
                   list_dot_product(tv.vec, sv.vec) / (sqrt(list_dot_product(tv.vec, tv.vec))
                     * sqrt(list_dot_product(sv.vec, sv.vec))) * (0.5 + 0.5 * tp.topic_quality) AS ws
            FROM tv JOIN topics tp USING (doc_id) CROSS JOIN sv),
best AS (SELECT doc_id, classification, max(round(ws * 100, 2)) AS pct, min(ord) AS ord
         FROM cosines WHERE ws >= {min_similarity} GROUP BY doc_id, classification),
classified AS MATERIALIZED (SELECT doc_id, classification, pct,
                      row_number() OVER (PARTITION BY doc_id ORDER BY pct DESC, ord ASC) AS rank
               FROM best QUALIFY rank <= {top_n})"""


SEGMENTS = [
    (lx.SEGMENT_MALE, "gender = 'male'"), (lx.SEGMENT_FEMALE, "gender = 'female'"),
    (lx.SEGMENT_AGE_LE20, f"age_group = '{lx.AGE_LE20}'"), (lx.SEGMENT_AGE_GT20, f"age_group = '{lx.AGE_GT20}'"),
    (lx.SEGMENT_STUDENTS, "is_student = true"), (lx.SEGMENT_NON_STUDENTS, "is_student = false"),
    (lx.SEGMENT_EVERYONE, "true"),
]


def segments_cte() -> str:
    parts = " UNION ALL ".join(f"SELECT '{n}' AS demographic, file_id FROM demo WHERE {p}" for n, p in SEGMENTS)
    return f"""
seg AS ({parts}),
seg_n AS (SELECT demographic, count(*) AS docs FROM seg GROUP BY demographic)"""


def scores_cte(level: str) -> str:
    key = "split_part(c.classification, ':', 1)" if level == "category" else "c.classification"
    return f"""
seg_sum AS (SELECT s.demographic, {key} AS classification, sum(c.pct / 100.0) AS total
            FROM seg s JOIN classified c ON c.doc_id = s.file_id GROUP BY 1, 2),
scores AS (SELECT demographic, classification, total / docs AS average_weighted_score
           FROM seg_sum JOIN seg_n USING (demographic))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def classification_sql() -> str:
    return _with(blogs_cte(), tfidf_cte(), classification_cte()) + \
        "\nSELECT doc_id, classification, pct, CAST(rank AS BIGINT) AS rank FROM classified"


def report_sql(level: str, kind: str) -> str:
    head = _with(blogs_cte(), tfidf_cte(), classification_cte(), segments_cte(), scores_cte(level))
    if kind == "score":
        return head + """
SELECT demographic, classification, round(average_weighted_score, 6) AS average_weighted_score,
       row_number() OVER (PARTITION BY demographic
                          ORDER BY round(average_weighted_score, 6) DESC, classification) AS rank
FROM scores"""
    return head + """,
spec AS (SELECT s.demographic, s.classification,
                s.average_weighted_score / (coalesce(e.average_weighted_score, 0) + 1e-12) AS popularity_bias_score
         FROM scores s LEFT JOIN (SELECT * FROM scores WHERE demographic = 'Everyone') e USING (classification)
         WHERE s.demographic <> 'Everyone')
SELECT demographic, classification, round(popularity_bias_score, 6) AS popularity_bias_score,
       row_number() OVER (PARTITION BY demographic
                          ORDER BY round(popularity_bias_score, 6) DESC, classification) AS rank
FROM spec"""


def summary_sql(level: str) -> str:
    none, second = ((lx.NO_CATEGORIES, lx.NO_SECOND_CATEGORY) if level == "category"
                    else (lx.NO_TOPICS, lx.NO_SECOND_TOPIC))
    return _with(blogs_cte(), tfidf_cte(), classification_cte(), segments_cte(), scores_cte(level)) + f""",
ranked AS (SELECT *, row_number() OVER (PARTITION BY demographic
                  ORDER BY round(average_weighted_score, 6) DESC, classification) AS rank FROM scores),
firsts AS (SELECT demographic, max(CASE WHEN rank = 1 THEN classification END) AS c1,
                  max(CASE WHEN rank = 2 THEN classification END) AS c2 FROM ranked GROUP BY demographic)
SELECT n.demographic, coalesce(f.c1, '{none}') AS first,
       CASE WHEN f.c1 IS NULL THEN '{none}' ELSE coalesce(f.c2, '{second}') END AS second
FROM seg_n n LEFT JOIN firsts f USING (demographic)"""


def segment_sizes_sql() -> str:
    return _with(blogs_cte(), segments_cte()) + "\nSELECT demographic, docs AS documents FROM seg_n"


def crosstab_sql() -> str:
    return _with(blogs_cte()) + """
SELECT is_student, count(*) FILTER (WHERE age_group = '<=20') AS "<=20",
       count(*) FILTER (WHERE age_group = '>20') AS ">20"
FROM demo GROUP BY is_student"""


def tfidf_topics_sql() -> str:
    return _with(blogs_cte(), tfidf_cte()) + """
SELECT doc_id, words_text, split_part(words_text, ' ', 1) || CASE WHEN n_words > 1 THEN ' ' || split_part(words_text, ' ', 2) ELSE '' END AS label,
       round(topic_quality, 6) AS topic_quality
FROM topics"""


# --- sources, clean-up, language, terms -------------------------------------------

TRIM_WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def file_metadata_sql() -> str:
    host = "regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1)"
    parts = f"string_split({host}, '.')"
    cols = ["scrapping_timestamp", "gender", "age", "industry"]
    sel = ", ".join(f"{parts}[{i + 1}] AS {c}" for i, c in enumerate(cols))
    return f"""
WITH m AS (SELECT page_id, {sel}, regexp_replace({parts}[5], '\\.xml$', '') AS star_sign FROM pages)
SELECT *, md5(concat_ws('.', scrapping_timestamp, gender, age, industry, star_sign)) AS id FROM m"""


def page_posts_sql() -> str:
    dec = _replace_chain("regexp_replace(t, '<[^>]*>', '', 'g')", lx.XML_ENTITY_REPLACEMENTS)
    return f"""
WITH e AS (SELECT page_id, list_transform(regexp_extract_all(html, '(?s)<p(?:\\s[^>]*)?>(.*?)</p>', 1),
                                          lambda t: trim({dec}, {TRIM_WS})) AS ps FROM pages)
SELECT page_id, CAST(generate_subscripts(ps, 1) - 1 AS INTEGER) AS pos, unnest(ps) AS content FROM e"""


def blogs_from_posts_sql() -> str:
    return """
SELECT conv_id AS file_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS content,
       count(*) AS post_count, sum(length(text)) AS total_content_length
FROM conversations GROUP BY conv_id"""


def language_vote_sql() -> str:
    return f"SELECT doc_id, lang, {detect_language('text')} AS content_language FROM documents"


def language_distribution_sql() -> str:
    return f"SELECT content_language, count(*) AS count FROM ({language_vote_sql()}) GROUP BY 1"


def clean_content_sql() -> str:
    c = clean_content("text")
    return f"SELECT doc_id, md5({c}) AS clean_md5, length({c}) AS clean_length FROM documents"


def clean_html_sql() -> str:
    c = clean_html("html")
    return f"SELECT page_id, md5({c}) AS clean_md5, length({c}) AS clean_length FROM pages"


def json_props_sql() -> str:
    return """
SELECT j.key AS key, count(*) AS n, round(sum(CAST(j.value AS DOUBLE)), 6) AS total
FROM events, json_each(events.props) AS j GROUP BY j.key"""


def date_parse_sql(event_date_language: dict) -> str:
    cases = " ".join(f"WHEN '{et}' THEN [{_q(lx.MONTH_NAMES[lang])}]"
                     for et, lang in sorted(event_date_language.items()))
    return f"""
SELECT event_id, concat_ws(',', day(ts), (CASE event_type {cases} END)[month(ts)], year(ts)) AS date_text,
       CAST(date_trunc('day', ts) AS TIMESTAMP) AS parsed_date
FROM events"""


def word_frequencies_sql() -> str:
    toks = (f"list_filter(list_filter(string_split(trim(regexp_replace(lower(text), '[^a-z]+', ' ', 'g')), ' '), "
            f"lambda t: t <> '' AND t NOT IN ({_q(lx.ENGLISH_STOP_WORDS)})), lambda t: length(t) > 1 AND length(t) >= 2)")
    return f"""
WITH tk AS (SELECT doc_id, {toks} AS toks FROM documents),
u AS (SELECT doc_id, unnest(toks) AS term, generate_subscripts(toks, 1) AS pos FROM tk),
c AS (SELECT doc_id, term, count(*) AS cnt, min(pos) AS first FROM u GROUP BY doc_id, term),
m AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY cnt DESC, first) AS rm FROM c),
l AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY cnt, first) AS rl FROM c WHERE cnt > 1)
SELECT d.doc_id,
       coalesce((SELECT string_agg(term, ',' ORDER BY rm) FROM m WHERE m.doc_id = d.doc_id AND rm <= 10), '') AS most_common,
       coalesce((SELECT string_agg(term, ',' ORDER BY rl) FROM l WHERE l.doc_id = d.doc_id AND rl <= 10), '') AS least_common
FROM documents d"""


def sentences_sql() -> str:
    marked = f"regexp_replace(text, '([.!?])[{WS}]+', '\\1' || chr(1), 'g')"
    return f"""
WITH s AS (SELECT doc_id, list_filter(list_transform(string_split({marked}, chr(1)), lambda x: trim(x, {TRIM_WS})),
                                     lambda x: length(x) >= 21) AS ss FROM documents)
SELECT doc_id, CAST(len(ss) AS BIGINT) AS n_sentences,
       CAST(coalesce(list_sum(list_transform(ss, lambda x: length(x))), 0) AS BIGINT) AS total_chars FROM s"""


def _english_tokens_cte() -> str:
    return f"""
etok AS (SELECT file_id AS doc_id, unnest({topic_tokens(clean_html('content'))}) AS term FROM blogs),
ecnt AS (SELECT doc_id, term, count(*) AS cnt FROM etok GROUP BY doc_id, term)"""


def _tfidf_top(counts: str, doc: str, top_n: int) -> str:
    return f"""
dfs AS (SELECT term, count(*) AS df FROM {counts} GROUP BY term),
nd AS (SELECT count(DISTINCT {doc}) AS n FROM {counts}),
raw AS (SELECT c.{doc}, c.term, c.cnt * (ln((1.0 + nd.n) / (1.0 + dfs.df)) + 1.0) AS raw
        FROM {counts} c JOIN dfs USING (term) CROSS JOIN nd),
nw AS (SELECT {doc}, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY {doc})) AS weight FROM raw),
rk AS (SELECT *, row_number() OVER (PARTITION BY {doc} ORDER BY weight DESC, term DESC) AS rank FROM nw)
SELECT {doc}, rank, term, round(weight, 6) AS weight FROM rk WHERE rank <= {top_n}"""


def corpus_tfidf_sql() -> str:
    return _with(blogs_cte(), _english_tokens_cte(), _tfidf_top("ecnt", "doc_id", 5))


def _segment_counts_cte() -> str:
    return segments_cte() + """,
scnt AS (SELECT s.demographic, c.term, sum(c.cnt) AS cnt FROM seg s JOIN ecnt c ON c.doc_id = s.file_id
         GROUP BY 1, 2)"""


def segment_top_terms_sql() -> str:
    return _with(blogs_cte(), _english_tokens_cte(), _segment_counts_cte()) + """
SELECT demographic, rank, term, cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY demographic ORDER BY cnt DESC, term) AS rank FROM scnt)
WHERE rank <= 2"""


def segment_tfidf_sql() -> str:
    return _with(blogs_cte(), _english_tokens_cte(), _segment_counts_cte(), _tfidf_top("scnt", "demographic", 2))


def event_windows_sql() -> str:
    return """
SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
       event_type, count(*) AS events, round(sum(value), 6) AS value
FROM events GROUP BY 1, 2, 3"""



def _phrase_pass(src: str, p: str, min_count: int, threshold: float) -> str:
    """One phrase pass over CTE ``src`` (doc_id, sent_id, toks) -> CTE ``{p}new``."""
    return f"""
{p}un AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(toks) AS w FROM {src}) GROUP BY 1, 2),
{p}pp AS (SELECT doc_id, sent_id, i, toks[i + 1] AS a, toks[i + 2] AS b
          FROM (SELECT doc_id, sent_id, toks, unnest(range(0, len(toks) - 1)) AS i FROM {src})),
{p}pc AS (SELECT doc_id, a, b, count(*) AS n_ab FROM {p}pp GROUP BY 1, 2, 3),
{p}vu AS (SELECT doc_id, count(*) AS vu FROM {p}un GROUP BY 1),
{p}vb AS (SELECT doc_id, count(*) AS vb FROM {p}pc GROUP BY 1),
{p}ph AS (SELECT pc.doc_id, pc.a, pc.b FROM {p}pc pc JOIN {p}vu vu USING (doc_id) LEFT JOIN {p}vb vb USING (doc_id)
          JOIN {p}un ua ON ua.doc_id = pc.doc_id AND ua.w = pc.a
          JOIN {p}un ub ON ub.doc_id = pc.doc_id AND ub.w = pc.b
          WHERE CAST(pc.n_ab - {min_count} AS DOUBLE) * (vu.vu + coalesce(vb.vb, 0)) / (ua.n * ub.n) > {threshold}),
{p}fl AS (SELECT pp.doc_id, pp.sent_id, pp.i FROM {p}pp pp JOIN {p}ph ph USING (doc_id, a, b)),
{p}mg AS (SELECT doc_id, sent_id, i FROM (
            SELECT doc_id, sent_id, i, min(i) OVER (PARTITION BY doc_id, sent_id, g) AS run_start FROM (
              SELECT *, i - row_number() OVER (PARTITION BY doc_id, sent_id ORDER BY i) AS g FROM {p}fl))
          WHERE (i - run_start) % 2 = 0),
{p}tp AS (SELECT doc_id, sent_id, toks, unnest(toks) AS t, generate_subscripts(toks, 1) - 1 AS j FROM {src}),
{p}new AS (SELECT tp.doc_id, tp.sent_id,
                  list(CASE WHEN mj.i IS NOT NULL THEN tp.t || '_' || tp.toks[tp.j + 2] ELSE tp.t END ORDER BY tp.j) AS toks
           FROM {p}tp tp
           LEFT JOIN {p}mg mj ON mj.doc_id = tp.doc_id AND mj.sent_id = tp.sent_id AND mj.i = tp.j
           LEFT JOIN {p}mg mp ON mp.doc_id = tp.doc_id AND mp.sent_id = tp.sent_id AND mp.i = tp.j - 1
           WHERE mp.i IS NULL GROUP BY 1, 2)"""


def phrases_sql() -> str:
    marked = f"regexp_replace(text, '([.!?])[{WS}]+', '\\1' || chr(1), 'g')"
    return f"""
WITH en AS MATERIALIZED (SELECT doc_id, text FROM documents WHERE {detect_language('text')} = 'en'),
ss AS (SELECT doc_id, list_filter(list_transform(string_split({marked}, chr(1)), lambda x: trim(x, {TRIM_WS})),
                                  lambda x: length(x) >= 21) AS ss FROM en),
sent AS (SELECT doc_id, CAST(generate_subscripts(ss, 1) - 1 AS BIGINT) AS sent_id, unnest(ss) AS s FROM ss),
tk AS MATERIALIZED (SELECT doc_id, sent_id, list_filter(string_split({clean_content('s')}, ' '), lambda t: t <> '') AS toks
       FROM sent),""" + _phrase_pass("tk", "a_", 2, 8.0) + "," + _phrase_pass("a_new", "b_", 1, 10.0) + """
SELECT doc_id, sent_id, array_to_string(toks, ' ') AS phrased FROM b_new"""



def _sentence_list(expr: str) -> str:
    marked = f"regexp_replace({expr}, '([.!?])[{WS}]+', '\\1' || chr(1), 'g')"
    return (f"list_filter(list_transform(string_split({marked}, chr(1)), lambda x: trim(x, {TRIM_WS})), "
            f"lambda x: length(x) >= 21)")


def semantic_segments_sql() -> str:
    return f"""
WITH en AS MATERIALIZED (SELECT doc_id, text FROM documents WHERE {detect_language('text')} = 'en'),
ss AS (SELECT doc_id, text, {_sentence_list('text')} AS ss FROM en),
g AS (SELECT doc_id, text,
        list_filter([array_to_string(ss[i + 1:i + 3], ' ') FOR i IN range(0, len(ss), 2)],
                    lambda t: len(string_split({collapse('t')}, ' ')) >= 5) AS grp,
        {topic_tokens(clean_content('text'))} AS tk FROM ss),
w AS (SELECT doc_id, CASE WHEN len(grp) < 3 THEN list_concat(grp,
          [array_to_string(tk[i + 1:i + 30], ' ') FOR i IN range(0, len(tk), 20) IF len(tk[i + 1:i + 30]) >= 5])
        ELSE grp END AS segs FROM g),
u AS (SELECT doc_id, CAST(generate_subscripts(segs, 1) - 1 AS BIGINT) AS seg_id, unnest(segs) AS seg
      FROM w WHERE len(segs) >= 2)
SELECT doc_id, seg_id, array_to_string({topic_tokens(clean_content('seg'))}, ' ') AS tokens_text FROM u"""


def segment_tfidf_ngram_sql() -> str:
    grams = " || ".join(
        f"[array_to_string(toks[i + 1:i + {n}], ' ') FOR i IN range(0, len(toks) - {n} + 1)]" for n in (1, 2, 3))
    return f"""
WITH sg AS MATERIALIZED ({semantic_segments_sql()}),
segs AS (SELECT doc_id, seg_id, list_filter(string_split(tokens_text, ' '), lambda t: t <> '') AS toks FROM sg),
g AS (SELECT doc_id, seg_id, unnest({grams}) AS term FROM segs),
c AS (SELECT doc_id, seg_id, term, count(*) AS cnt FROM g GROUP BY 1, 2, 3),
ns AS (SELECT doc_id, count(*) AS n FROM segs GROUP BY 1),
d AS (SELECT doc_id, term, count(*) AS df, sum(cnt) AS total FROM c GROUP BY 1, 2),
j AS (SELECT d.*, ns.n, (df >= 2 AND df <= 0.85 * n) AS strict, (df >= 1 AND df <= 0.85 * n) AS loose
      FROM d JOIN ns USING (doc_id)),
k0 AS (SELECT *, max(CAST(strict AS INTEGER)) OVER (PARTITION BY doc_id) AS anyk FROM j),
k1 AS (SELECT * FROM k0 WHERE CASE WHEN anyk = 1 THEN strict ELSE loose END),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY total DESC, term) AS r FROM k1)
      WHERE r <= 1000),
w AS (SELECT c.doc_id, c.seg_id, c.term, (1.0 + ln(c.cnt)) * (ln((1.0 + k.n) / (1.0 + k.df)) + 1.0) AS raw
      FROM c JOIN k USING (doc_id, term)),
nw AS (SELECT *, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id, seg_id)) AS weight FROM w)
{MATRIX_DIGEST}"""


MATRIX_DIGEST = """SELECT doc_id, seg_id, count(*) AS n_terms, round(sum(weight), 5) AS weight_sum,
  md5(string_agg(term, ',' ORDER BY term)) AS terms_md5 FROM nw GROUP BY 1, 2"""


def corpus_segment_tfidf_sql() -> str:
    return _corpus_matrix_cte() + MATRIX_DIGEST


def projected_gram_sql(r: int = 16) -> str:
    return _corpus_matrix_cte() + f""",
p AS (SELECT doc_id, seg_id, d.j, sum(CASE WHEN ascii(substr(md5(term), d.j + 1, 1)) % 2 = 1 THEN weight ELSE -weight END) AS y
      FROM nw, (SELECT unnest(range({r})) AS j) d GROUP BY 1, 2, 3)
SELECT a.j AS i, b.j AS j, round(sum(a.y * b.y), 4) AS g FROM p a JOIN p b USING (doc_id, seg_id) GROUP BY 1, 2"""


def _corpus_matrix_cte() -> str:
    grams = " || ".join(
        f"[array_to_string(toks[i + 1:i + {n}], ' ') FOR i IN range(0, len(toks) - {n} + 1)]" for n in (1, 2, 3))
    return f"""
WITH sg AS MATERIALIZED ({semantic_segments_sql()}),
segs AS (SELECT doc_id, seg_id, list_filter(string_split(tokens_text, ' '), lambda t: t <> '') AS toks FROM sg),
g AS (SELECT doc_id, seg_id, unnest({grams}) AS term FROM segs),
c AS (SELECT doc_id, seg_id, term, count(*) AS cnt FROM g GROUP BY 1, 2, 3),
ns AS (SELECT count(*) AS n FROM segs),
k AS (SELECT term, count(*) AS df, any_value(ns.n) AS n FROM c CROSS JOIN ns GROUP BY 1 HAVING df >= 2 AND df <= 0.85 * any_value(ns.n)),
w AS (SELECT c.doc_id, c.seg_id, c.term, (1.0 + ln(c.cnt)) * (ln((1.0 + k.n) / (1.0 + k.df)) + 1.0) AS raw
      FROM c JOIN k USING (term)),
nw AS (SELECT *, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id, seg_id)) AS weight FROM w)
"""


def top_term_sentences_sql() -> str:
    return _with(blogs_cte(), _english_tokens_cte(), _segment_counts_cte()) + f""",
top AS (SELECT demographic, term FROM (
  SELECT *, row_number() OVER (PARTITION BY demographic ORDER BY cnt DESC, term) AS rank FROM scnt) WHERE rank <= 2),
pair AS (SELECT demographic, list(term) AS pair FROM top GROUP BY 1),
raw AS (SELECT doc_id AS file_id, {_sentence_list('text')} AS ss FROM documents
        WHERE doc_id IN (SELECT file_id FROM blogs)),
sents AS (SELECT file_id, unnest(ss) AS s, CAST(generate_subscripts(ss, 1) - 1 AS BIGINT) AS sent_id FROM raw),
st AS (SELECT file_id, sent_id, s, {topic_tokens(clean_content('s'))} AS toks FROM sents)
SELECT p.demographic, st.file_id, st.sent_id, st.s AS text
FROM st JOIN seg ON seg.file_id = st.file_id JOIN pair p ON p.demographic = seg.demographic
WHERE len(list_intersect(st.toks, p.pair)) = len(p.pair)"""


def method_agreement_sql() -> str:
    return f"""
WITH a AS ({segment_top_terms_sql()}), b AS ({segment_tfidf_sql()}),
sa AS (SELECT demographic, list(DISTINCT term) AS la FROM a GROUP BY 1),
sb AS (SELECT demographic, list(DISTINCT term) AS lb FROM b GROUP BY 1),
j AS (SELECT coalesce(sa.demographic, sb.demographic) AS demographic, coalesce(la, []) AS la, coalesce(lb, []) AS lb
      FROM sa FULL JOIN sb USING (demographic))
SELECT demographic, CAST(len(list_intersect(la, lb)) AS BIGINT) AS common,
       round(CASE WHEN len(list_distinct(list_concat(la, lb))) > 0
             THEN len(list_intersect(la, lb)) / len(list_distinct(list_concat(la, lb))) ELSE 0.0 END, 6) AS jaccard
FROM j"""



def topic_quality_sql() -> str:
    return _with(blogs_cte(), tfidf_cte()) + """,
tw8 AS (SELECT doc_id, word, weight, pos, weight / sum(weight) OVER (PARTITION BY doc_id) AS p,
               count(*) OVER (PARTITION BY doc_id) AS n FROM topic_words WHERE pos <= 8),
ent AS (SELECT doc_id, max(n) AS n, -sum(p * ln(p + 1e-10)) AS h, sum(weight) AS total FROM tw8 GROUP BY doc_id),
wl AS (SELECT doc_id, list(word ORDER BY pos) AS words FROM topic_words GROUP BY doc_id),
stems AS (SELECT doc_id, count(DISTINCT substr(word, 1, 4)) AS s FROM topic_words
          WHERE pos <= 6 AND length(word) > 3 GROUP BY doc_id)
SELECT wl.doc_id,
       CASE WHEN len(wl.words) = 0 THEN 'unknown_topic'
            WHEN len(list_filter(wl.words[1:4], lambda w: length(w) > 3)) > 0
              THEN array_to_string(list_filter(wl.words[1:4], lambda w: length(w) > 3)[1:2], '_')
            ELSE array_to_string(wl.words[1:2], '_') END AS label,
       round(0.5 * 0.5
             + 0.3 * CASE WHEN e.n > 1 AND e.total > 0 THEN 1 - e.h / ln(e.n) ELSE 0.0 END
             + 0.2 * least(1.0, coalesce(st.s, 0) / 4.0), 6) AS topic_quality
FROM wl JOIN ent e USING (doc_id) LEFT JOIN stems st USING (doc_id)"""


# --- the model path's use half on source topics ------------------------------------


def _source_topics_cte() -> str:
    vec = "('0x' || substr(md5(substr({w}, 1, 1)), 1, 8))::BIGINT % nvec.n"
    return _english_tokens_cte() + f""",
nvec AS (SELECT count(*) AS n FROM embeddings),
stc AS MATERIALIZED (SELECT d.source, c.term, sum(c.cnt) AS cnt FROM ecnt c JOIN documents d USING (doc_id) GROUP BY 1, 2),
sdf AS (SELECT term, count(*) AS df FROM stc GROUP BY term),
sn AS (SELECT count(DISTINCT source) AS n FROM stc),
sraw AS (SELECT s.source, s.term, s.cnt * (ln((1.0 + sn.n) / (1.0 + sdf.df)) + 1.0) AS raw
         FROM stc s JOIN sdf USING (term) CROSS JOIN sn),
snw AS (SELECT source, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY source)) AS weight FROM sraw),
stop AS MATERIALIZED (SELECT CAST(substr(source, 4, 10) AS INTEGER) AS topic_id, term, weight,
         row_number() OVER (PARTITION BY source ORDER BY weight DESC, term DESC) AS rank FROM snw QUALIFY rank <= 20),
bn AS (SELECT doc_id, sum(cnt) AS n FROM ecnt GROUP BY 1),
shares AS MATERIALIZED (SELECT c.doc_id, t.topic_id, sum(c.cnt) / max(bn.n) AS share
         FROM ecnt c JOIN stop t USING (term) JOIN bn USING (doc_id) GROUP BY 1, 2),
tv6 AS (SELECT t.topic_id, t.rank - 1 AS pos, t.term, t.weight, CAST(e.embedding AS DOUBLE[]) AS v
        FROM stop t CROSS JOIN nvec JOIN embeddings e ON e.vec_id = {vec.format(w='t.term')}),
cen_l AS (SELECT topic_id, i, avg(x) AS x FROM (
          SELECT topic_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM tv6 WHERE pos < 8) GROUP BY 1, 2),
cen AS (SELECT topic_id, list(x ORDER BY i) AS c FROM cen_l GROUP BY 1),
sim AS (SELECT t.topic_id, t.pos, t.term, t.weight,
               list_dot_product(v, c) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(c, c))) AS sim
        FROM tv6 t JOIN cen USING (topic_id)),
kept6 AS (SELECT * FROM sim WHERE (sim > 0.25 AND pos < 15) OR sim > 0.35),
nk AS (SELECT topic_id, count(*) AS nk FROM kept6 GROUP BY 1),
rr AS (SELECT k.topic_id, k.pos, k.term, k.weight, k.sim AS coh FROM kept6 k JOIN nk USING (topic_id) WHERE nk >= 5
       UNION ALL
       SELECT s.topic_id, s.rank - 1, s.term, s.weight, 0.5 FROM stop s LEFT JOIN nk USING (topic_id)
       WHERE coalesce(nk, 0) < 5 AND s.rank <= 8),
rl AS MATERIALIZED (SELECT topic_id, list(term ORDER BY pos) AS words, list(weight ORDER BY pos) AS ws,
                           list(coh ORDER BY pos) AS cs, list(coh ORDER BY coh DESC) AS best FROM rr GROUP BY 1),
dq AS (SELECT topic_id, words, ws, cs, list_avg(cs) AS semantic_coherence,
         least(1.0, CASE WHEN len(cs) >= 3 THEN 0.5 * best[1] + 0.3 * best[2] + 0.2 * best[3] ELSE list_avg(cs) END) AS coh_part,
         list_transform(ws[1:8], lambda x: x / list_sum(ws[1:8])) AS p8,
         len(list_distinct(list_transform(list_filter(words[1:6], lambda w: length(w) > 3), lambda w: substr(w, 1, 4)))) AS stems,
         list_filter(words[1:4], lambda w: length(w) > 3) AS named FROM rl),
described AS MATERIALIZED (SELECT topic_id, words[1:10] AS words, ws[1:10] AS ws, cs[1:10] AS cs, semantic_coherence,
         array_to_string(CASE WHEN len(named) > 0 THEN named[1:2] ELSE words[1:2] END, '_') AS label,
         0.5 * coh_part
         + 0.3 * CASE WHEN len(p8) > 1 THEN 1 + list_sum(list_transform(p8, lambda x: x * ln(x + 1e-10))) / ln(len(p8)) ELSE 0.0 END
         + 0.2 * least(1.0, stems / 4.0) AS q FROM dq),
dups AS (SELECT coalesce(list(a.topic_id * 100000 + b.topic_id), []) AS d FROM described a, described b
         WHERE len(list_intersect(a.words[1:5], b.words[1:5])) / least(len(a.words[1:5]), len(b.words[1:5])) > 0.6),
cand AS (SELECT s.doc_id, s.topic_id, d.q, max(d.q) OVER (PARTITION BY s.doc_id) AS mx, avg(d.q) OVER (PARTITION BY s.doc_id) AS mean
         FROM (SELECT DISTINCT doc_id, topic_id FROM shares) s JOIN described d USING (topic_id)),
above AS (SELECT doc_id, list([topic_id] ORDER BY q DESC, topic_id) AS ids FROM cand
          WHERE q >= greatest(CASE WHEN mx > 0.3 THEN 0.7 * mx ELSE greatest(0.8 * mx, mean) END, 0.01) GROUP BY 1),
kept AS MATERIALIZED (SELECT doc_id, unnest(list_reduce(ids, lambda acc, x: CASE
            WHEN len(list_filter(acc, lambda a: list_contains(d, a * 100000 + x[1]))) > 0 THEN acc ELSE list_concat(acc, x) END)[1:3]) AS topic_id
         FROM above CROSS JOIN dups),
dw AS (SELECT topic_id, q, unnest(words) AS word, unnest(ws) AS weight, unnest(cs) AS coh, generate_subscripts(words, 1) AS pos FROM described),
dthr AS (SELECT topic_id, CASE WHEN count(*) > 3 THEN quantile_cont(weight, 0.6) ELSE min(weight) END AS t FROM dw GROUP BY 1),
dpass AS (SELECT dw.topic_id, count(*) FILTER (WHERE weight >= t) AS n FROM dw JOIN dthr USING (topic_id) GROUP BY 1),
dord AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY weight DESC, pos) AS r FROM dw),
dsel AS (SELECT o.* FROM dord o JOIN dthr USING (topic_id) JOIN dpass USING (topic_id)
         WHERE (dpass.n >= 3 AND o.weight >= dthr.t) OR (dpass.n < 3 AND o.r <= 3)),
dv AS (SELECT s.topic_id, s.q, s.weight * (s.coh + 0.2) AS cw, CAST(e.embedding AS DOUBLE[]) AS v
       FROM dsel s CROSS JOIN nvec JOIN embeddings e ON e.vec_id = {vec.format(w='s.word')}),
dvl AS (SELECT topic_id, q, cw, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM dv),
dvs AS (SELECT topic_id, any_value(q) AS q, i, sum(cw * x) / sum(cw) AS x FROM dvl GROUP BY topic_id, i),
dvec AS (SELECT topic_id, any_value(q) AS q, list(x ORDER BY i) AS vec FROM dvs GROUP BY 1),
tax AS (SELECT * FROM ({taxonomy_values()}) t(ord, major, subtopic)),
sv AS (SELECT t.ord, t.major, t.subtopic, CAST(e.embedding AS DOUBLE[]) AS vec
       FROM tax t CROSS JOIN nvec JOIN embeddings e ON e.vec_id = {vec.format(w='t.subtopic')}),
tkey AS (SELECT dvec.topic_id, sv.ord, sv.major || ':' || sv.subtopic AS classification,
                list_dot_product(dvec.vec, sv.vec) / (sqrt(list_dot_product(dvec.vec, dvec.vec))
                  * sqrt(list_dot_product(sv.vec, sv.vec))) * (0.5 + 0.5 * dvec.q) AS ws FROM dvec CROSS JOIN sv),
xbest AS (SELECT kept.doc_id, classification, max(round(ws * 100, 2)) AS pct, min(ord) AS ord
          FROM kept JOIN tkey USING (topic_id) WHERE ws >= 0.5 GROUP BY 1, 2),
classified AS MATERIALIZED (SELECT doc_id, classification, pct,
          row_number() OVER (PARTITION BY doc_id ORDER BY pct DESC, ord ASC) AS rank FROM xbest QUALIFY rank <= 25)"""


def source_topics_sql(select: str) -> str:
    return _with(blogs_cte(), _source_topics_cte()) + "\n" + select


SOURCE_TOPIC_SELECTS = {
    "m3_topic_shares": "SELECT doc_id, topic_id, round(share, 6) AS share FROM shares",
    "m6_reranked_words": """SELECT topic_id, array_to_string(words, ' ') AS words_text,
       array_to_string(list_transform(cs, lambda x: printf('%.4f', round(x, 4))), ' ') AS coherence_text FROM rl""",
    "m8_described_topics": """SELECT topic_id, label, array_to_string(words, ' ') AS words_text,
       round(q, 6) AS topic_quality, round(semantic_coherence, 6) AS semantic_coherence FROM described""",
    "w11_kept_topics": "SELECT doc_id, topic_id FROM kept",
    "a12_blog_summary": """SELECT doc_id, count(*) AS num_topics, round(avg(q), 6) AS average_topic_quality,
       array_to_string(list_sort(list_distinct(list_filter(flatten(list(words)), lambda w: length(w) > 2))), ' ') AS words_text,
       array_to_string(list_sort(list_distinct(list_filter(flatten(list(string_split(label, '_'))), lambda p: length(p) > 2))), ' ') AS labels_text
       FROM kept JOIN described USING (topic_id) GROUP BY doc_id""",
    "x3_source_taxonomy": "SELECT doc_id, classification, pct, CAST(rank AS BIGINT) AS rank FROM classified",
}


def source_report_sql(level: str, kind: str) -> str:
    """The reports on the classification of the source topics."""
    usual = report_sql(level, kind)
    head = _with(blogs_cte(), tfidf_cte(), classification_cte(), segments_cte(), scores_cte(level))
    assert usual.startswith(head)
    return _with(blogs_cte(), _source_topics_cte(), segments_cte(), scores_cte(level)) + usual[len(head):]


# --- raw files, taxonomy files and the small operators -----------------------------


def post_pairs_sql() -> str:
    months = ", ".join(f"'{m}'" for m in lx.MONTH_NAMES["en"])
    return f"""
SELECT conv_id AS file_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos,
  CASE WHEN turn % 7 = 6 THEN 'no date'
       ELSE concat_ws(',', conv_id % 28 + 1, ([{months}])[turn % 12 + 1], '2004') END AS date_text,
  trim({_replace_chain("regexp_replace(text || ' & more', '<[^>]*>', '', 'g')", lx.XML_ENTITY_REPLACEMENTS)}, {TRIM_WS}) AS content,
  CASE WHEN turn % 7 = 6 THEN NULL ELSE make_timestamp(2004, turn % 12 + 1, conv_id % 28 + 1, 0, 0, 0.0) END AS date
FROM conversations"""


def dated_blogs_sql() -> str:
    return f"""
WITH p AS ({post_pairs_sql()}),
b AS (SELECT file_id, md5(string_agg(content, chr(10) || chr(10) ORDER BY date NULLS FIRST, pos)) AS content_md5,
        count(*) AS post_count, CAST(sum(length(content)) AS BIGINT) AS total_content_length,
        min(date) AS earliest_post_date, max(date) AS latest_post_date FROM p GROUP BY 1)
SELECT b.*, c.c_mktsegment AS industry FROM b LEFT JOIN customer c ON c.c_custkey = b.file_id"""


def taxonomy_tsv_sql() -> str:
    return """
SELECT CAST(n_nationkey AS INTEGER) AS ord, replace(replace(lower(r_name), ' ', '_'), '&', 'and') AS major,
       replace(replace(lower(n_name || ' & Co'), ' ', '_'), '&', 'and') AS subtopic
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey >= 2 AND n_nationkey % 11 <> 10"""


def subtopic_vectors_sql() -> str:
    return """
WITH t AS (SELECT CAST(p_partkey AS INTEGER) AS ord, p_brand AS major, p_type AS subtopic FROM part),
last AS (SELECT subtopic, major, min(ord) OVER (PARTITION BY subtopic) AS first_ord,
                row_number() OVER (PARTITION BY subtopic ORDER BY ord DESC) AS r FROM t),
d AS (SELECT first_ord AS ord, major, subtopic FROM last WHERE r = 1),
n AS (SELECT count(*) AS n FROM embeddings),
w AS (SELECT ord, major, subtopic, unnest(string_split(lower(subtopic), ' ')) AS word FROM d),
v AS (SELECT w.*, CAST(e.embedding AS DOUBLE[]) AS v FROM w CROSS JOIN n
      JOIN embeddings e ON e.vec_id = ('0x' || substr(md5(word), 1, 8))::BIGINT % n.n WHERE length(word) > 4),
l AS (SELECT ord, major, subtopic, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v),
m AS (SELECT ord, major, subtopic, i, avg(x) AS x FROM l GROUP BY 1, 2, 3, 4)
SELECT ord, major, subtopic, round(max(x) FILTER (WHERE i = 1), 6) AS v0, round(sum(x), 5) AS v_sum FROM m GROUP BY 1, 2, 3"""


def row_errors_sql() -> str:
    return f"""
SELECT doc_id, CASE WHEN text IS NULL OR length(trim(text, {TRIM_WS})) = 0 THEN 'empty content'
  WHEN len({topic_tokens(clean_content('text'))}) = 0 THEN 'no terms' END AS error FROM documents"""


def industries_sql() -> str:
    return _with(blogs_cte()) + """
SELECT replace(industry, 'indUnknown', 'unknown') AS industry, count(*) AS blogs FROM blogs_raw GROUP BY 1"""


SMALL_SQL = {
    "j2_unprocessed": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
    "j2_no_urgent_order": """SELECT c_custkey, c_mktsegment FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""",
    "u1_union": """SELECT c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL SELECT s_name, NULL, s_acctbal FROM supplier""",
    "p14_first_orders": "SELECT o_orderdate, o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 50",
    "s11_topic_json": """SELECT c_nationkey, c_mktsegment AS segment, count(*) AS customers FROM customer GROUP BY 1, 2""",
    "e6_topics_over_time": """
WITH n AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS topic, count(*) AS n FROM orders GROUP BY 1, 2),
s AS (SELECT *, n / sum(n) OVER (PARTITION BY month) AS share FROM n)
SELECT month, topic, n, round(share, 6) AS share, row_number() OVER (PARTITION BY month ORDER BY n DESC, topic) AS rank,
  round(share - lag(share) OVER (PARTITION BY topic ORDER BY month), 6) AS change FROM s""",
}


def lemma_counts_sql() -> str:
    """T1 tokens, then the tables of forms and suffix rules."""
    rules = ", ".join(f"('{a}', {'NULL' if b is None else chr(39) + b + chr(39)})" for a, b in lx.NOUN_SUFFIX_RULES.items())
    forms = ", ".join(f"('{a}', '{b}')" for a, b in lx.IRREGULAR_PLURALS.items())
    return f"""
WITH tok AS (SELECT doc_id, unnest(list_filter(regexp_extract_all(lower(text), '[a-z]+'),
               lambda t: t NOT IN ({_q(lx.ENGLISH_STOP_WORDS)}) AND length(t) > 1)) AS word FROM documents),
w AS (SELECT DISTINCT word FROM tok),
r(suffix, replacement) AS (VALUES {rules}),
f(form, lemma) AS (VALUES {forms}),
cut AS (SELECT word, length(suffix) AS l, substr(word, 1, length(word) - length(suffix)) || replacement AS made
        FROM w JOIN r ON ends_with(word, suffix) AND length(word) >= length(suffix) + 2),
kept AS (SELECT word, max(l) AS kl FROM cut WHERE made IS NULL GROUP BY word),
ok AS (SELECT c.word, c.l, c.made FROM cut c LEFT JOIN kept k ON k.word = c.word
       WHERE c.made IS NOT NULL AND (k.kl IS NULL OR c.l > k.kl) AND c.made IN (SELECT word FROM w)),
best AS (SELECT word, arg_max(made, l) AS made FROM ok GROUP BY word),
lem AS (SELECT w.word, coalesce(f.lemma, b.made, w.word) AS lemma FROM w LEFT JOIN f ON f.form = w.word LEFT JOIN best b ON b.word = w.word)
SELECT lemma, count(*) AS n, count(DISTINCT doc_id) AS documents FROM tok JOIN lem USING (word) WHERE length(lemma) > 1 GROUP BY lemma"""


def terms_over_time_sql(top_n: int = 10) -> str:
    return f"""
WITH p AS ({post_pairs_sql()}),
t AS (SELECT file_id, pos, strftime(date, '%Y-%m') AS month, unnest({topic_tokens('content')}) AS term FROM p WHERE date IS NOT NULL),
n AS (SELECT month, term, count(*) AS cnt, count(DISTINCT (file_id, pos)) AS texts FROM t GROUP BY 1, 2),
m AS (SELECT month, count(DISTINCT (file_id, pos)) AS n FROM t GROUP BY 1),
b AS (SELECT month, coalesce(sum(n) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM m),
s AS (SELECT n.*, coalesce(sum(texts) OVER (PARTITION BY term ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM n),
w AS (SELECT month, term, cnt, texts, round(cnt * (ln((1.0 + before) / (1.0 + seen)) + 1), 6) AS weight FROM s JOIN b USING (month)),
r AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY weight DESC, term) AS rank FROM w)
SELECT month, rank, term, cnt, texts, weight FROM r WHERE rank <= {top_n}"""
