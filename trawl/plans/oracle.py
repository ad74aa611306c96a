"""DuckDB SQL for the correctness gate, written from the reference semantics.

Independent of the Spark code path on purpose: its own patterns, stop words and entity
list; tokens are unnested and numbered with a window, the stemmer is a CASE chain over CTE
columns, and markup is removed element by element. Every query reads the pre-registered
driver views (pages, documents, benchmark, events, ...).
"""

from __future__ import annotations

from trawl.plans.inputs import CONTENT_TYPE, CRAWL_WORKERS, FETCH_START, LITERAL_QUERIES, QUERY_ID_OFFSET
from trawl.plans.oracle_crawl import crawl_sql

# Fixed values of the reference: white space, trimmed punctuation and stop words.
WS = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
CUT = """.,!?()[]{}:;"''"""
STOP_WORDS = """a all an and any are as at be both but by can did do does doing done down each few for from had has have he
how in is it its more most no nor not of on only other own same so some such than that the they this to too up very was
were what when where which who why will with""".split()
STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
TITLE_RE = r"(?is)<title(?:\s[^<>]*)?>([^<]*)"
# Character references that the pages hold, also in the old form without a semicolon; "&amp" comes last.
REFERENCES = (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"))


def _decode_named(x: str) -> str:
    for name, ch in REFERENCES:
        x = f"regexp_replace({x}, '&{name};?', '{ch}', 'g')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def _strip_raw(h: str) -> str:
    x = f"regexp_replace(coalesce({h}, ''), '(?s)<!--.*?-->', ' ', 'g')"
    for tag in ("script", "style", "noscript"):
        x = f"regexp_replace({x}, '(?is)<{tag}(?:\\s[^<>]*)?>.*?</{tag}[^<>]*>', ' ', 'g')"
    return x


def _trim_ws(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}|{WS}$', '', 'g')"


# corpus CTEs: doc_id, url, title, clean_text
CORPUS = {
    "documents": """
corpus AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id,
         'doc://' || source || '/' || CAST(doc_id AS VARCHAR) AS url,
         'No Title' AS title, coalesce(text, '') AS clean_text
  FROM documents)""",
    "pages": f"""
pages_raw AS (
  SELECT CAST(page_id AS BIGINT) AS doc_id, url, {_strip_raw('html')} AS h FROM pages),
pages_titled AS (
  SELECT doc_id, url, h,
         {_trim_ws(_decode_named("list_filter(regexp_extract_all(h, '" + TITLE_RE + "', 1), lambda t: t <> '')[-1]"))} AS t
  FROM pages_raw),
corpus AS (
  SELECT doc_id, url,
         CASE WHEN coalesce(t, '') = '' THEN 'No Title' ELSE t END AS title,
         trim(regexp_replace(regexp_replace({_decode_named("regexp_replace(h, '<[!/]?[a-zA-Z](?:\"[^\"]*\"|[^\">])*>', ' ', 'g')")},
                                            '&[a-zA-Z]+;', ' ', 'g'), '{WS}', ' ', 'g')) AS clean_text
  FROM pages_titled)""",
}


def _stem_case(src: str, step: int) -> str:
    rules = {
        1: [("sses", f"left({src}, length({src}) - 2)"), ("ies", f"left({src}, length({src}) - 2)"),
            ("ss", src), ("s", f"left({src}, length({src}) - 1)")],
        2: [("eed", f"left({src}, length({src}) - 1)"), ("ed", f"left({src}, length({src}) - 2)"),
            ("ing", f"left({src}, length({src}) - 3)")],
        3: [("ization", f"left({src}, length({src}) - 5) || 'ize'"),
            ("ational", f"left({src}, length({src}) - 5) || 'ate'"),
            ("fulness", f"left({src}, length({src}) - 4)"), ("ousness", f"left({src}, length({src}) - 4)"),
            ("iveness", f"left({src}, length({src}) - 4)")],
        4: [("ize", f"left({src}, length({src}) - 3)"), ("ate", f"left({src}, length({src}) - 3)"),
            ("al", f"left({src}, length({src}) - 2)")],
    }[step]
    whens = " ".join(f"WHEN {src} LIKE '%{suf}' THEN {out}" for suf, out in rules)
    return f"CASE WHEN strlen(w) < 3 THEN {src} {whens} ELSE {src} END"


def tokens_cte(src: str = "corpus", out: str = "tokens", p: str = "") -> str:
    """CTEs turning src(doc_id, clean_text) into out(doc_id, pos, term)."""
    return f"""
{p}words AS (
  SELECT doc_id, unnest(ws) AS raw, generate_subscripts(ws, 1) AS wi
  FROM (SELECT doc_id, regexp_split_to_array(lower(clean_text), '{WS}') AS ws FROM {src})),
{p}trimmed AS (SELECT doc_id, wi, trim(raw, '{CUT}') AS w FROM {p}words WHERE raw <> ''),
{p}kept AS (SELECT doc_id, wi, w FROM {p}trimmed WHERE w <> '' AND w NOT IN ({STOP})),
{p}numbered AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY wi) - 1 AS INTEGER) AS pos, w FROM {p}kept),
{p}st1 AS (SELECT doc_id, pos, w, {_stem_case('w', 1)} AS s1 FROM {p}numbered),
{p}st2 AS (SELECT doc_id, pos, w, {_stem_case('s1', 2)} AS s2 FROM {p}st1),
{p}st3 AS (SELECT doc_id, pos, w, {_stem_case('s2', 3)} AS s3 FROM {p}st2),
{out} AS (SELECT doc_id, pos, {_stem_case('s3', 4)} AS term FROM {p}st3)"""


TOKENS = tokens_cte()

INDEX = f"""
postings AS (
  SELECT term, doc_id, CAST(count(*) AS INTEGER) AS frequency, CAST(min(pos) AS INTEGER) AS first_pos,
         list_sort(list(pos)) AS positions
  FROM tokens GROUP BY term, doc_id),
docs AS (
  SELECT c.doc_id, c.url, c.title, CAST(coalesce(k.n, 0) AS INTEGER) AS length, c.clean_text
  FROM corpus c LEFT JOIN (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id) k USING (doc_id)),
term_stats AS (SELECT term, count(*) AS doc_count FROM postings GROUP BY term)"""


def _queries_cte() -> str:
    lits = ", ".join(f"({qid}, '{q}')" for qid, q in LITERAL_QUERIES)
    return f"""
queries AS (
  SELECT CAST(query_id AS BIGINT) AS query_id, query FROM (VALUES {lits}) v(query_id, query)
  UNION ALL
  SELECT CAST({QUERY_ID_OFFSET} + item_id AS BIGINT) AS query_id, text AS query FROM benchmark),
qwords AS (
  SELECT query_id, unnest(ws) AS term, generate_subscripts(ws, 1) AS wi
  FROM (SELECT query_id, list_filter(regexp_split_to_array(lower(query), '{WS}'), lambda x: x <> '') AS ws
        FROM queries)),
qterms AS (SELECT query_id, term, count(*) AS qtf FROM qwords GROUP BY query_id, term)"""


SCORES = """
n_docs AS (SELECT count(*) AS n FROM docs),
hits AS (
  SELECT q.query_id, p.doc_id,
         q.qtf * p.frequency * ln(n_docs.n / s.doc_count)
           * (CASE WHEN p.first_pos < 100 THEN 1.2 ELSE 1.0 END)
           * (CASE WHEN contains(lower(d.title), p.term) THEN 1.5 ELSE 1.0 END) AS c
  FROM qterms q JOIN postings p ON p.term = q.term JOIN term_stats s ON s.term = q.term
       JOIN docs d ON d.doc_id = p.doc_id CROSS JOIN n_docs),
scores AS (SELECT query_id, doc_id, round(sum(c), 6) AS score FROM hits GROUP BY query_id, doc_id),
ranked AS (
  SELECT query_id, doc_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rnk
  FROM scores)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n"


def _search(kind: str, n: int = 5, index: str = INDEX) -> str:
    return _with(CORPUS[kind], TOKENS, index, _queries_cte(), SCORES) + f"""
SELECT r.query_id, CAST(r.rnk AS INTEGER) AS rank, r.doc_id, d.url, d.title, r.score,
       CAST(trunc(r.score * 1000) AS BIGINT) AS doc_score, '' AS snippet
FROM ranked r JOIN docs d USING (doc_id) WHERE r.rnk <= {n}"""


def _snippets(kind: str, n: int = 5) -> str:
    return _with(CORPUS[kind], TOKENS, INDEX, _queries_cte(), SCORES) + f"""
, firsts AS (
  SELECT r.query_id, r.doc_id, min(instr(lower(d.clean_text), w.term)) FILTER (WHERE instr(lower(d.clean_text), w.term) > 0) AS p
  FROM ranked r JOIN docs d USING (doc_id) JOIN qwords w ON w.query_id = r.query_id
  WHERE r.rnk <= {n} GROUP BY r.query_id, r.doc_id)
SELECT r.query_id, CAST(r.rnk AS INTEGER) AS rank, r.doc_id, d.url, d.title, r.score,
       CAST(trunc(r.score * 1000) AS BIGINT) AS doc_score,
       CASE WHEN f.p IS NULL THEN '' ELSE substring(d.clean_text, greatest(f.p - 30, 1), 160) END AS snippet
FROM ranked r JOIN docs d USING (doc_id) LEFT JOIN firsts f ON f.query_id = r.query_id AND f.doc_id = r.doc_id
WHERE r.rnk <= {n}"""


def _suggestions(kind: str, n: int = 5) -> str:
    return _with(CORPUS[kind], TOKENS, INDEX, _queries_cte()) + f"""
, matching AS (SELECT DISTINCT q.query_id, p.doc_id FROM qterms q JOIN postings p ON p.term = q.term),
co AS (
  SELECT m.query_id, p.term, count(*) AS doc_count
  FROM matching m JOIN postings p ON p.doc_id = m.doc_id
  WHERE NOT EXISTS (SELECT 1 FROM qterms q WHERE q.query_id = m.query_id AND q.term = p.term)
  GROUP BY m.query_id, p.term),
top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY doc_count DESC, term) AS rnk FROM co)
SELECT query_id, CAST(rnk AS INTEGER) AS rank, term, CAST(doc_count AS BIGINT) AS doc_count
FROM top WHERE rnk <= {n}"""


def _response(kind: str, n: int = 5) -> str:
    return _with(CORPUS[kind], TOKENS, INDEX, _queries_cte(), SCORES) + f"""
, matching AS (SELECT DISTINCT q.query_id, p.doc_id FROM qterms q JOIN postings p ON p.term = q.term),
co AS (
  SELECT m.query_id, p.term, count(*) AS doc_count
  FROM matching m JOIN postings p ON p.doc_id = m.doc_id
  WHERE NOT EXISTS (SELECT 1 FROM qterms q WHERE q.query_id = m.query_id AND q.term = p.term)
  GROUP BY m.query_id, p.term),
sug AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY doc_count DESC, term) AS rnk FROM co),
res AS (SELECT query_id, count(*) AS n, string_agg(CAST(rnk AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR), ','
                                                   ORDER BY rnk) AS s
        FROM ranked WHERE rnk <= {n} GROUP BY query_id),
sg AS (SELECT query_id, string_agg(term, ',' ORDER BY rnk) AS s FROM sug WHERE rnk <= {n} GROUP BY query_id)
SELECT q.query_id, CAST(coalesce(res.n, 0) AS INTEGER) AS n_results, coalesce(res.s, '') AS results,
       coalesce(sg.s, '') AS suggestions
FROM queries q LEFT JOIN res USING (query_id) LEFT JOIN sg USING (query_id)"""


def _search_tf(kind: str) -> str:
    # The query goes through the document analysis: the same token CTEs run on queries.
    q_corpus = """
q_corpus AS (SELECT query_id AS doc_id, query AS clean_text FROM queries)"""
    return _with(CORPUS[kind], TOKENS, INDEX, _queries_cte(), q_corpus,
                 tokens_cte("q_corpus", "q_tokens", "q_")) + """
, qt AS (SELECT doc_id AS query_id, term, count(*) AS qtf FROM q_tokens GROUP BY doc_id, term)
SELECT q.query_id, p.doc_id, d.url, CAST(sum(q.qtf * p.frequency) AS BIGINT) AS tf_score
FROM qt q JOIN postings p ON p.term = q.term JOIN docs d ON d.doc_id = p.doc_id
GROUP BY q.query_id, p.doc_id, d.url"""


def oracle_sql() -> dict[str, str]:
    base_d = _with(CORPUS["documents"], TOKENS, INDEX)
    base_p = _with(CORPUS["pages"], TOKENS, INDEX)
    q = {
        "tokenize": _with(CORPUS["documents"], TOKENS) + """
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_terms,
       string_agg(term, ' ' ORDER BY pos) AS terms FROM tokens GROUP BY doc_id""",
        "postings": base_d + """
SELECT term, doc_id, frequency, first_pos, array_to_string(positions, ',') AS positions FROM postings""",
        "postings_pages": base_p + """
SELECT term, doc_id, frequency, first_pos, array_to_string(positions, ',') AS positions FROM postings""",
        "term_doc_count": base_d + "SELECT term, CAST(doc_count AS BIGINT) AS doc_count FROM term_stats",
        "doc_lengths": base_d + "SELECT doc_id, length FROM docs",
        "index_stats": base_d + """
SELECT (SELECT count(*) FROM term_stats) AS total_terms, (SELECT count(*) FROM docs) AS total_documents""",
        "index_stats_ext": base_d + """
SELECT (SELECT count(*) FROM term_stats) AS total_terms, (SELECT count(*) FROM docs) AS total_documents,
       (SELECT count(*) FROM postings) AS total_postings,
       (SELECT CAST(sum(frequency) AS BIGINT) FROM postings) AS total_positions""",
        "stopword_share": f"""
WITH words AS (
  SELECT doc_id, unnest(ws) AS raw
  FROM (SELECT doc_id, regexp_split_to_array(lower(coalesce(text, '')), '{WS}') AS ws FROM documents)),
trimmed AS (SELECT doc_id, trim(raw, '{CUT}') AS w FROM words WHERE raw <> '')
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS INTEGER) AS n_words, CAST(coalesce(n_empty, 0) AS INTEGER) AS n_empty,
       CAST(coalesce(n_stop, 0) AS INTEGER) AS n_stop, CAST(coalesce(n_kept, 0) AS INTEGER) AS n_kept
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE w = '') AS n_empty,
         count(*) FILTER (WHERE w IN ({STOP})) AS n_stop,
         count(*) FILTER (WHERE w <> '' AND w NOT IN ({STOP})) AS n_kept
  FROM trimmed GROUP BY doc_id) t USING (doc_id)""",
        "clean_text": _with(CORPUS["pages"]) + "SELECT doc_id AS page_id, clean_text FROM corpus",
        "page_title": _with(CORPUS["pages"]) + "SELECT doc_id AS page_id, title FROM corpus",
        "page_first_title": f"""
WITH raw AS (SELECT page_id, {_strip_raw('html')} AS h FROM pages),
t AS (SELECT page_id, list_filter(list_transform(
        list_filter(regexp_extract_all(h, '{TITLE_RE}', 1), lambda x: x <> ''),
        lambda x: {_trim_ws(_decode_named('x'))}), lambda x: x <> '') AS ts FROM raw)
SELECT page_id, coalesce(ts[1], 'No Title') AS title FROM t""",
        "query_terms": _with(_queries_cte()) + """
SELECT query_id, CAST(wi - 1 AS INTEGER) AS term_pos, term FROM qwords""",
        "query_term_idf": _with(CORPUS["documents"], TOKENS, INDEX, _queries_cte()) + """
SELECT q.query_id, q.term, q.qtf, s.doc_count, round(ln((SELECT count(*) FROM docs) / s.doc_count), 9) AS idf
FROM qterms q JOIN term_stats s ON s.term = q.term""",
        "search_scores": _with(CORPUS["documents"], TOKENS, INDEX, _queries_cte(), SCORES) + """
SELECT query_id, doc_id, score, CAST(trunc(score * 1000) AS BIGINT) AS doc_score FROM scores""",
        "search_topk": _search("documents"),
        "search_topk_blocks": _search("documents"),
        "search_missing_docs": _search("documents", index=INDEX.replace("docs AS (", "all_docs AS (")
                                       + ",\ndocs AS (SELECT * FROM all_docs WHERE doc_id % 7 <> 0)"),
        "search_topk_pages": _search("pages"),
        "search_snippets": _snippets("pages"),
        "matching_docs": _with(CORPUS["documents"], TOKENS, INDEX, _queries_cte()) + """
SELECT DISTINCT q.query_id, p.doc_id FROM qterms q JOIN postings p ON p.term = q.term""",
        "suggestions": _suggestions("documents"),
        "suggestions_pages": _suggestions("pages"),
        "search_tf": _search_tf("documents"),
        "search_response": _response("pages"),
    }
    q.update(crawl_sql(_with, _strip_raw, _decode_named, _trim_ws))
    q["index_roundtrip"] = q["import_legacy_index"] = q["postings"]
    q["stream_index"] = base_p + """
SELECT p.term, p.frequency, p.first_pos, array_to_string(p.positions, ',') AS positions, c.url
FROM postings p JOIN corpus c USING (doc_id)"""
    q["stream_worker_stats"] = q["worker_stats"]
    q["to_crawl_output"] = base_p + _crawl_output("(SELECT length FROM docs d WHERE d.doc_id = page_id)")
    q["scan_crawl_output"] = q["page_files"] = _crawl_output("0")
    q["stream_tick_stats"] = base_p + """
SELECT (SELECT count(*) FROM docs) AS total_documents, (SELECT count(*) FROM term_stats) AS total_terms,
       CAST(0 AS BIGINT) AS quarantined"""
    # Eight files, three a batch: the source deletes a batch's files once the next one is committed.
    q["stream_clean_source"] = base_p + "SELECT url, title, length, CAST(2 AS BIGINT) AS files_left FROM docs"
    q["stream_replay"] = q["stream_index"]
    q["header_counts"] = """
SELECT 'Content-Type' AS header, count(*) AS pages, count(DISTINCT 1) AS distinct_values FROM pages"""
    return q


def _crawl_output(word_count: str) -> str:
    ts = "strftime(TIMESTAMP '{start}' + to_seconds(page_id), '%Y%m%d_%H%M%S')".format(start=FETCH_START)
    w = f"CAST(page_id % {CRAWL_WORKERS} AS INTEGER)"
    return f"""
SELECT url, {ts} AS timestamp, {w} AS worker_id,
       'crawl_output/raw_' || CAST({w} AS VARCHAR) || '_' || {ts} || '_' || CAST(page_id AS VARCHAR) || '.json'
         AS file_path,
       false AS processed, CAST(200 AS INTEGER) AS status_code, '{CONTENT_TYPE}' AS content_type,
       CAST(strlen(html) AS INTEGER) AS content_length, md5(html) AS content_md5, true AS success,
       {w} AS result_worker_id, CAST({word_count} AS INTEGER) AS word_count, 'pending' AS content_hash
FROM pages"""
