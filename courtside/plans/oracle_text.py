"""DuckDB SQL for the text queries, generated from the same rule constants.

The Spark side uses ``courtside.functions.text`` / ``urls``; the SQL below
rebuilds each chain from the same patterns (RE2 accepts all of them, they
avoid look-around).
"""

from __future__ import annotations

from courtside.functions import text as T
from courtside.functions import urls as U
from courtside.operators.index import DEFAULT_BLOCK
from courtside.plans.text import PAGE_TERMS, PREFIX, SEARCH_K, TOP_K_TERMS
from courtside.sources.params import stop_words


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rx(expr: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(repl)}, 'g')"


def decode_entities(expr: str) -> str:
    """As the Spark rule: cut at ``&``, each piece's reference looked up once."""
    names = ", ".join(f"{q(k)}: {q(v)}" for k, v in T.ENTITY_CHARS.items())
    name = f"regexp_extract(p, {q(T.RE_ENTITY)}, 1)"
    code = (f"(CASE WHEN regexp_matches({name}, '^#[xX]') THEN try_cast('0x' || substr({name}, 3) AS INTEGER) ELSE try_cast(substr({name}, 2) AS INTEGER) END)")
    char = (f"(CASE WHEN {name} LIKE '#%' THEN CASE WHEN {code} BETWEEN 1 AND 1114111 AND NOT {code} BETWEEN 55296 AND 57343 THEN chr({code}) END "
            f"ELSE MAP {{{names}}}[{name}] END)")
    piece = f"CASE WHEN {name} <> '' AND {char} IS NOT NULL THEN {char} || substr(p, length({name}) + 2) ELSE '&' || p END"
    parts = f"string_split({expr}, '&')"
    return f"(({parts})[1] || array_to_string(list_transform(({parts})[2:], lambda p: {piece}), ''))"


def html_to_text(expr: str) -> str:
    e = f"coalesce({expr}, '')"
    e = f"replace({e}, {q(T.NBSP_ENTITY[0])}, {q(T.NBSP_ENTITY[1])})"
    e = rx(e, T.RE_HIDDEN_BLOCKS, T.NODE_MARK)
    e = rx(e, T.RE_COMMENTS_AND_TAGS, T.NODE_MARK)
    e = rx(e, T.RE_NODE_GAP, " ")
    e = rx(e, T.RE_OUTER_SPACE, "")
    return decode_entities(e)


def html_raw_text(expr: str) -> str:
    e = f"coalesce({expr}, '')"
    e = rx(e, T.RE_HIDDEN_BLOCKS, "")
    e = rx(e, T.RE_COMMENTS_AND_TAGS, "")
    return decode_entities(e)


def word_tokens(expr: str) -> str:
    e = f"lower(coalesce({expr}, ''))"
    e = rx(e, T.RE_TOK_CONTRACTIONS, T.TOK_CONTRACTIONS_REPL.replace("$", "\\"))
    e = rx(e, T.RE_TOK_TIS, r"\1 \2")
    e = rx(e, T.RE_TOK_SPACED, " ")
    e = rx(e, T.RE_TOK_COLON_COMMA, r" \1")
    e = rx(e, T.RE_TOK_TRAILING, r"\1")
    e = rx(e, T.RE_TOK_LEADING, r"\1")
    parts = f"regexp_split_to_array(trim({e}), {q(T.RE_TOK_SPLIT)})"
    return f"list_filter({parts}, lambda x: x <> '')"


def whitespace_tokens(expr: str) -> str:
    parts = f"regexp_split_to_array(coalesce({expr}, ''), {q(T.RE_TOK_SPLIT)})"
    return f"list_filter({parts}, lambda x: x <> '')"


def term_filter_v2(col: str) -> str:
    stops = ", ".join(q(w) for w in stop_words("v2"))
    return (f"NOT regexp_matches({col}, {q(T.RE_HAS_DIGIT)}) "
            f"AND regexp_matches({col}, {q(T.RE_ALNUM)}) AND {col} NOT IN ({stops})")


def anchor_hrefs(expr: str) -> str:
    shown = rx(rx(f"coalesce({expr}, '')", T.RE_HIDDEN_BLOCKS, ""), T.RE_COMMENTS, "")
    tags = f"list_filter(regexp_extract_all({shown}, {q(T.RE_TAG)}), lambda t: regexp_matches(t, {q(U.RE_ANCHOR)}))"
    values = f"list_filter(list_transform({tags}, lambda t: regexp_extract(t, {q(U.RE_ANCHOR_HREF)}, 1)), lambda v: v <> '')"
    value = rx("m", U.RE_QUOTES, "")
    return f"list_transform({values}, lambda m: {decode_entities(value)})"


def strip_trailing_slash(expr: str) -> str:
    return rx(expr, U.RE_TRAILING_SLASH, "")


def absolutize(href: str, base: str) -> str:
    scheme = f"regexp_extract({base}, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1)"
    host = f"regexp_extract({base}, {q(U.RE_SCHEME_HOST)}, 1)"
    return (f"CASE WHEN starts_with({href}, '//') THEN {scheme} || ':' || {href} "
            f"WHEN starts_with({href}, '/') THEN {host} || {href} ELSE {href} END")


# --------------------------------------------------------------------------
# Queries
# --------------------------------------------------------------------------

PAGE_TEXT = f"SELECT page_id, {html_to_text('html')} AS text FROM pages"

PAGE_RAW_TEXT = f"SELECT page_id, {html_raw_text('html')} AS raw_text FROM pages"

_HREFS = f"SELECT page_id, url, unnest({anchor_hrefs('html')}) AS href FROM pages"

PAGE_LINKS = f"SELECT DISTINCT page_id, href FROM ({_HREFS})"

_ABS = (f"SELECT DISTINCT page_id, {strip_trailing_slash(absolutize('href', 'url'))} AS link "
        f"FROM ({_HREFS})")

PAGE_LINKS_ABSOLUTE = _ABS

LINK_LAST_SEGMENT = (f"SELECT page_id, link, "
                     f"list_extract(string_split({strip_trailing_slash('link')}, '/'), -1) AS node "
                     f"FROM ({_ABS})")

_POSTINGS = f"""
WITH d AS (SELECT doc_id, {word_tokens('text')} AS toks FROM documents),
t AS (SELECT doc_id, unnest(toks) AS term,
             CAST(generate_subscripts(toks, 1) - 1 AS INTEGER) AS pos FROM d),
post AS (SELECT term, doc_id, count(*) AS tf, min(pos) AS first_pos
         FROM t WHERE {term_filter_v2('term')} GROUP BY term, doc_id)
"""

TOKENS_CLEAN = _POSTINGS + "SELECT term, doc_id, tf, first_pos FROM post"

TOKENS_CLEAN_V1 = TOKENS_CLEAN.replace(term_filter_v2("term"), (
    f"regexp_matches(term, {q(T.RE_ALNUM)}) AND term NOT IN ({', '.join(q(w) for w in stop_words('v1'))})"))

PAGE_URL_FORMS = rf"""
SELECT page_id, url AS seed_url,
       regexp_extract(regexp_replace(url, '/[a-z]{{2}}/(\d+)', '/player/\1/', 'g'), 'player/(\d+)/', 1) AS player_id,
       CASE WHEN page_id % 3 = 0 THEN url
            WHEN regexp_extract(url, '^[a-z]+://[^/]+(/.*)$', 1) <> '' THEN '{PREFIX}' || regexp_extract(url, '^[a-z]+://[^/]+(/.*)$', 1)
            ELSE '' END AS prefixed
FROM pages
"""

_POSTINGS_EN = _POSTINGS.replace("FROM documents)", "FROM documents WHERE lang = 'en')")

def _top(src: str) -> str:
    return f""",
freq AS (SELECT term, CAST(sum(tf) AS BIGINT) AS n, count(*) AS n_docs,
                min(doc_id) AS first_doc, arg_min(first_pos, doc_id) AS first_pos
         FROM {src} GROUP BY term),
top AS (SELECT CAST(row_number() OVER (ORDER BY n DESC, first_doc, first_pos) AS INTEGER) AS rank,
               term, n, n_docs
        FROM freq ORDER BY n DESC, first_doc, first_pos LIMIT {TOP_K_TERMS})
"""


def _index(src: str) -> str:
    return f"""
SELECT t.rank, t.term AS word, CAST(floor(p.doc_id / {DEFAULT_BLOCK}) AS BIGINT) AS block,
       string_agg(CAST(p.doc_id AS VARCHAR), ', ' ORDER BY p.doc_id) AS document_ids,
       count(*) AS n_docs, CAST(sum(p.tf) AS BIGINT) AS occurrences,
       min(p.doc_id) AS first_doc, arg_min(p.first_pos, p.doc_id) AS first_pos
FROM {src} p JOIN top t ON p.term = t.term
GROUP BY t.rank, t.term, CAST(floor(p.doc_id / {DEFAULT_BLOCK}) AS BIGINT)
"""


def _stem_ctes() -> str:
    """The stemmer's steps unrolled over the distinct vocabulary of ``post``."""
    from courtside.functions import porter as P
    new_w, new_s = P.apply_sql()
    ctes = ["vocab AS (SELECT DISTINCT term FROM post)",
            f"st0 AS (SELECT term, term AS {P.W}, {P.signature_sql('term', 'duckdb')} AS {P.S} FROM vocab)"]
    steps = P.step_sql("duckdb")
    for i, step in enumerate(steps, 1):
        ctes.append(f"st{i}e AS (SELECT term, {P.W}, {P.S}, {step} AS {P.EDIT} FROM st{i - 1})")
        ctes.append(f"st{i} AS (SELECT term, {new_w} AS {P.W}, {new_s} AS {P.S} FROM st{i}e)")
    ctes.append(f"stems AS (SELECT term, {P.final_sql('term', 'duckdb')} AS stem FROM st{len(steps)})")
    ctes.append("spost AS (SELECT s.stem AS term, p.doc_id, CAST(sum(p.tf) AS BIGINT) AS tf, "
                "min(p.first_pos) AS first_pos FROM post p JOIN stems s ON p.term = s.term "
                "GROUP BY s.stem, p.doc_id)")
    return ",\n" + ",\n".join(ctes)


_TOP = _POSTINGS + _top("post")

TOP15_TERMS = _TOP + "SELECT rank, term, n, n_docs FROM top"

TOP15_TERMS_EN = _POSTINGS_EN + _top("post") + "SELECT rank, term, n, n_docs FROM top"

INVERTED_INDEX_TOP15 = _TOP + _index("post")

INVERTED_INDEX_STEMMED = _POSTINGS + _stem_ctes() + _top("spost") + _index("spost")

INVERTED_INDEX_STEMMED_EN = _POSTINGS_EN + _stem_ctes() + _top("spost") + _index("spost")

PRECISION_RECALL = _TOP + """,
judged AS (SELECT doc_id, quality = 1 AS relevant FROM labels),
hits AS (SELECT p.term AS query, count(*) AS n_retrieved,
                count(*) FILTER (WHERE j.relevant) AS n_relevant_retrieved
         FROM post p JOIN top t ON p.term = t.term JOIN judged j ON p.doc_id = j.doc_id
         GROUP BY p.term),
nrel AS (SELECT count(*) AS n_relevant FROM judged WHERE relevant)
SELECT t.term AS query, coalesce(h.n_retrieved, 0) AS n_retrieved,
       coalesce(h.n_relevant_retrieved, 0) AS n_relevant_retrieved,
       nrel.n_relevant,
       round(CASE WHEN coalesce(h.n_retrieved, 0) > 0
                  THEN h.n_relevant_retrieved / h.n_retrieved END, 6) AS precision,
       round(CASE WHEN nrel.n_relevant > 0
                  THEN coalesce(h.n_relevant_retrieved, 0) / nrel.n_relevant END, 6) AS recall
FROM top t LEFT JOIN hits h ON t.term = h.query, nrel
"""

_WIDE_COLS = ", ".join(
    f"CAST(len(list_filter(toks, lambda x: x = {q(t.lower())})) AS INTEGER) AS \"{t}\""
    for t in PAGE_TERMS)

TERM_COUNTS_WIDE = f"""
SELECT page_id, url, {_WIDE_COLS}
FROM (SELECT page_id, url, {whitespace_tokens(f"lower({html_raw_text('html')})")} AS toks FROM pages)
"""

_LONG = f"""
WITH wide AS ({TERM_COUNTS_WIDE}),
long AS (UNPIVOT (SELECT page_id, {", ".join(f'"{t}"' for t in PAGE_TERMS)} FROM wide)
         ON {", ".join(f'"{t}"' for t in PAGE_TERMS)} INTO NAME term VALUE n),
dfreq AS (SELECT term, count(*) FILTER (WHERE n > 0) AS df FROM long GROUP BY term),
nd AS (SELECT count(*) AS d FROM pages),
idf AS (SELECT term, df, CASE WHEN df > 0 THEN log10(nd.d / df) END AS idf FROM dfreq, nd),
w AS (SELECT l.page_id, l.term, l.n,
             CASE WHEN l.n > 0 THEN 1 + log10(l.n) ELSE 0.0 END AS tf, i.idf,
             (CASE WHEN l.n > 0 THEN 1 + log10(l.n) ELSE 0.0 END) * i.idf AS tfidf
      FROM long l JOIN idf i ON l.term = i.term)
"""

DOCUMENT_FREQUENCY = _LONG + "SELECT term, df FROM dfreq"

IDF = _LONG + "SELECT term, df, round(idf, 6) AS idf FROM idf"

TF_SUBLINEAR = _LONG + "SELECT page_id, term, n, round(tf, 6) AS tf FROM w"

TFIDF = _LONG + ("SELECT page_id, term, n, round(tf, 6) AS tf, round(idf, 6) AS idf, "
                 "round(tfidf, 6) AS tfidf FROM w")

TFIDF_MATRIX = _LONG + "SELECT page_id, " + ", ".join(
    f"max(CASE WHEN term = {q(t)} THEN round(tfidf, 6) END) AS \"{t}\"" for t in PAGE_TERMS
) + " FROM w GROUP BY page_id"

SEARCH_TOPK = _LONG + f"""
, s AS (SELECT page_id, sum(tfidf) AS score FROM w WHERE idf IS NOT NULL GROUP BY page_id)
SELECT CAST(row_number() OVER (ORDER BY score DESC, page_id) AS INTEGER) AS rank,
       page_id, round(score, 6) AS score
FROM s ORDER BY score DESC, page_id LIMIT {SEARCH_K}
"""

SQL = {
    "page_text": PAGE_TEXT,
    "page_raw_text": PAGE_RAW_TEXT,
    "page_links": PAGE_LINKS,
    "page_links_absolute": PAGE_LINKS_ABSOLUTE,
    "link_last_segment": LINK_LAST_SEGMENT,
    "tokens_clean": TOKENS_CLEAN,
    "tokens_clean_v1": TOKENS_CLEAN_V1,
    "page_url_forms": PAGE_URL_FORMS,
    "top15_terms": TOP15_TERMS,
    "top15_terms_en": TOP15_TERMS_EN,
    "inverted_index_top15": INVERTED_INDEX_TOP15,
    "inverted_index_stemmed": INVERTED_INDEX_STEMMED,
    "inverted_index_stemmed_en": INVERTED_INDEX_STEMMED_EN,
    "term_counts_wide": TERM_COUNTS_WIDE,
    "document_frequency": DOCUMENT_FREQUENCY,
    "idf": IDF,
    "tf_sublinear": TF_SUBLINEAR,
    "tfidf": TFIDF,
    "tfidf_matrix": TFIDF_MATRIX,
    "search_topk": SEARCH_TOPK,
    "precision_recall": PRECISION_RECALL,
}
