"""Derived inputs built from the given tables.

The reference consumes a URL list, fetched pages, model responses and its own
earlier output; the given tables hold pages and documents.  Each derived input
below is a list of SQL expressions over one given table, valid unchanged in
Spark SQL and in DuckDB, so both engines see identical inputs.  Variants are
chosen by ``id % k`` inside CASE expressions; every row of the given table
takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.sources.tables import load

# The run timestamp and content type stamped on derived records.
RUN_TS = "2026-01-01T00:00:00+00:00"
CONTENT_TYPE = "text/html; charset=utf-8"
DOC_URL_PREFIX = "https://news.example.org/a/"

# ---------------------------------------------------------------- url lines
# Two lines per page: a variant of its URL, then an extra line that is a
# comment, blank, an exact repeat, whitespace, or an empty-query variant.
URL_LINE_SETS = [
    ["page_id * 2 AS ord",
     """CASE page_id % 6
          WHEN 0 THEN '  ' || url || '  '
          WHEN 1 THEN url || '#x'
          WHEN 2 THEN url || '/'
          WHEN 3 THEN upper(substr(url, 1, 4)) || substr(url, 5)
          WHEN 4 THEN chr(9) || url
          ELSE url END AS line"""],
    ["page_id * 2 + 1 AS ord",
     """CASE page_id % 5
          WHEN 0 THEN '# comment ' || CAST(page_id AS STRING)
          WHEN 1 THEN ''
          WHEN 2 THEN url
          WHEN 3 THEN '   '
          ELSE url || '?' END AS line"""],
]

# ------------------------------------------------------------ page snapshots
# What a fetch of each page URL returned; injected empty bodies, fetch
# errors, a 401 status and redirects.  Keyed later by the URL key.
SNAPSHOT_EXPRS = [
    "page_id",
    "url AS page_url",
    """CASE WHEN page_id % 20 = 17 THEN 'https://archive.example.net/p/' || CAST(page_id AS STRING)
            ELSE url END AS final_url""",
    """CASE WHEN page_id % 20 = 11 THEN CAST(NULL AS INT)
            WHEN page_id % 20 = 3 THEN 204
            WHEN page_id % 20 = 13 THEN 401
            ELSE 200 END AS http_status""",
    f"""CASE WHEN page_id % 20 = 11 THEN CAST(NULL AS STRING)
            ELSE '{CONTENT_TYPE}' END AS content_type""",
    """CASE WHEN page_id % 20 IN (3, 11) THEN CAST(NULL AS STRING)
            WHEN page_id % 20 = 7 THEN ''
            ELSE html END AS html""",
    """CASE WHEN page_id % 20 = 11 THEN 'ConnectTimeout: timed out'
            ELSE CAST(NULL AS STRING) END AS fetch_error""",
]

# -------------------------------------------------------- prior raw output
# What an earlier scrape run wrote: pages with page_id % 4 = 0, some stored
# with a trailing slash, a third of them failed.
RAW_PRIOR_WHERE = "page_id % 4 = 0"
RAW_PRIOR_EXPRS = [
    "page_id AS ord",
    "CASE WHEN page_id % 8 = 4 THEN url || '/' ELSE url END AS url",
    "CASE WHEN page_id % 3 = 0 THEN 'failed' ELSE 'ok' END AS status",
    "'Earlier title ' || CAST(page_id AS STRING) AS title",
    """CASE WHEN page_id % 3 = 0 THEN CAST(NULL AS STRING)
            WHEN page_id % 8 = 4 THEN '   '
            ELSE 'Earlier scraped article number ' || CAST(page_id AS STRING) ||
                 '. It reports on regional markets and weather. Markets rallied while weather stayed calm.'
       END AS text""",
]

# Keys an earlier ingest already analysed, and ids already indexed, for
# end-to-end ingest over the page URLs.
INGEST_AI_PRIOR_WHERE = "page_id % 12 = 0"
INGEST_VECTOR_PRIOR_WHERE = "page_id % 16 = 3"

# --------------------------------------------------- raw articles from docs
# Documents as raw scrape output: short ones failed the length gate; a few
# titles are missing or blank; every tenth URL repeats the previous one with
# a trailing slash (same key, so a later duplicate).
RAW_DOC_EXPRS = [
    "doc_id AS ord",
    """'https://news.example.org/a/' ||
       CAST(CASE WHEN doc_id % 10 = 9 THEN doc_id - 1 ELSE doc_id END AS STRING) ||
       CASE WHEN doc_id % 10 = 9 THEN '/' ELSE '' END AS url""",
    "source",
    """CASE WHEN doc_id % 13 = 5 THEN CAST(NULL AS STRING)
            WHEN doc_id % 13 = 6 THEN '   '
            ELSE split_part(text, chr(10), 1) END AS title""",
    "CASE WHEN n_chars >= 300 THEN text ELSE CAST(NULL AS STRING) END AS text",
    f"'{RUN_TS}' AS fetched_at",
    "CASE WHEN n_chars >= 300 THEN 'ok' ELSE 'failed' END AS status",
    """CASE WHEN n_chars >= 300 THEN CAST(NULL AS STRING)
            ELSE 'Extraction too short (<300 chars)' END AS error""",
    "200 AS http_status",
    f"'{CONTENT_TYPE}' AS content_type",
    "CAST(n_chars AS INT) AS chars",
]

# Earlier enriched output: keys already analysed (ok and failed alike).
ENRICHED_PRIOR_WHERE = "doc_id % 7 = 3"
ENRICHED_PRIOR_EXPRS = [
    "doc_id AS ord",
    "'https://news.example.org/a/' || CAST(doc_id AS STRING) AS url",
    "CASE WHEN doc_id % 14 = 10 THEN 'failed' ELSE 'ok' END AS status",
]

# Ids already present in the vector collection.
VECTOR_PRIOR_WHERE = "doc_id % 5 = 1"
VECTOR_PRIOR_EXPRS = ["'https://news.example.org/a/' || CAST(doc_id AS STRING) AS id"]

# ------------------------------------------------------ model responses
# Three attempts per document; the kind of each response is chosen by
# (doc_id * 3 + attempt) % 12.  Values use only doc_id, lang and source, so
# no JSON escaping is needed.
_GOOD = ("""'{"summary": "Article ' || CAST(doc_id AS STRING) || ' in ' || lang || '.", "topics": ["' || lang || '", "' || source || '", "doc' || CAST(doc_id AS STRING) || '"]}'""")
RESPONSE_KIND = "(doc_id * 3 + attempt) % 12"
RESPONSE_EXPRS = [
    "doc_id",
    "attempt",
    f"""CASE {RESPONSE_KIND}
          WHEN 0 THEN {_GOOD}
          WHEN 1 THEN '{{"summary": "cut off", "topics": ['
          WHEN 2 THEN {_GOOD} || ' Hope this helps!'
          WHEN 3 THEN '{{"summary": "   ", "topics": ["a", "b", "c"]}}'
          WHEN 4 THEN '{{"summary": ' || CAST(doc_id AS STRING) || ', "topics": ["a", "b", "c"]}}'
          WHEN 5 THEN '{{"summary": "Two topics.", "topics": ["' || lang || '", "' || source || '"]}}'
          WHEN 6 THEN '{{"summary": "Eight topics.", "topics": ["t1", "t2", "t3", "t4", "t5", "t6", "t7", "t8"]}}'
          WHEN 7 THEN '{{"summary": "  Mixed ' || CAST(doc_id AS STRING) || '  ", "topics": ["' || upper(lang) || '", " ' || lang || ' ", "' || source || '", "SRC", "", "News"]}}'
          WHEN 8 THEN '{{"summary": "Null topic.", "topics": ["a", null, "c", "d"]}}'
          WHEN 9 THEN '```json' || chr(10) || {_GOOD} || chr(10) || '```'
          WHEN 10 THEN '[' || {_GOOD} || ']'
          ELSE '{{"summary": "Doc ' || CAST(doc_id AS STRING) || '", "topics": ["x", "y", "z", "x"], "extra": 1}}'
        END AS raw_text""",
]
ATTEMPTS = (1, 2, 3)

# ------------------------------------------------------------- versions
# Three records per page, for latest-by-key lookups.
VERSION_SETS = [
    ["page_id * 3 AS ord", "url", "'ok' AS status", "'first ' || CAST(page_id AS STRING) AS text"],
    ["page_id * 3 + 1 AS ord", "url || '/' AS url",
     "CASE WHEN page_id % 3 = 0 THEN 'failed' ELSE 'ok' END AS status",
     "CASE WHEN page_id % 4 = 1 THEN '   ' ELSE 'second ' || CAST(page_id AS STRING) END AS text"],
    ["page_id * 3 + 2 AS ord", "url",
     "CASE WHEN page_id % 5 = 2 THEN 'ok' ELSE 'failed' END AS status",
     "CASE WHEN page_id % 5 = 2 THEN 'third' ELSE CAST(NULL AS STRING) END AS text"],
]


# ============================================================ Spark side

def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def url_lines(spark: SparkSession, d: str) -> DataFrame:
    pages = load(spark, d, "pages").select("page_id", "url")
    return _union([pages.selectExpr(*exprs) for exprs in URL_LINE_SETS])


def snapshot_rows(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "pages").selectExpr(*SNAPSHOT_EXPRS)


def raw_prior(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "pages").where(RAW_PRIOR_WHERE).selectExpr(*RAW_PRIOR_EXPRS)


def ingest_ai_prior(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "pages").where(INGEST_AI_PRIOR_WHERE).selectExpr("page_id AS ord", "url")


def ingest_vector_prior(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "pages").where(INGEST_VECTOR_PRIOR_WHERE).selectExpr("url")


def raw_docs(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").selectExpr(*RAW_DOC_EXPRS)


def enriched_prior(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").where(ENRICHED_PRIOR_WHERE).selectExpr(*ENRICHED_PRIOR_EXPRS)


def vector_prior(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "documents").where(VECTOR_PRIOR_WHERE).selectExpr(*VECTOR_PRIOR_EXPRS)


def responses(spark: SparkSession, d: str) -> DataFrame:
    docs = load(spark, d, "documents").select("doc_id", "lang", "source")
    parts = [docs.selectExpr("*", f"{a} AS attempt").selectExpr(*RESPONSE_EXPRS) for a in ATTEMPTS]
    return _union(parts)


def versions(spark: SparkSession, d: str) -> DataFrame:
    pages = load(spark, d, "pages").select("page_id", "url")
    return _union([pages.selectExpr(*exprs) for exprs in VERSION_SETS])


# ============================================================ SQL side

def sql_select(table: str, exprs: list[str], where: str | None = None) -> str:
    w = f" WHERE {where}" if where else ""
    return f"SELECT {', '.join(exprs)} FROM {table}{w}"


def sql_url_lines() -> str:
    return " UNION ALL ".join(f"({sql_select('pages', e)})" for e in URL_LINE_SETS)


def sql_snapshot_rows() -> str:
    return sql_select("pages", SNAPSHOT_EXPRS)


def sql_raw_prior() -> str:
    return sql_select("pages", RAW_PRIOR_EXPRS, RAW_PRIOR_WHERE)


def sql_ingest_ai_prior() -> str:
    return sql_select("pages", ["page_id AS ord", "url"], INGEST_AI_PRIOR_WHERE)


def sql_ingest_vector_prior() -> str:
    return sql_select("pages", ["url"], INGEST_VECTOR_PRIOR_WHERE)


def sql_raw_docs() -> str:
    return sql_select("documents", RAW_DOC_EXPRS)


def sql_enriched_prior() -> str:
    return sql_select("documents", ENRICHED_PRIOR_EXPRS, ENRICHED_PRIOR_WHERE)


def sql_vector_prior() -> str:
    return sql_select("documents", VECTOR_PRIOR_EXPRS, VECTOR_PRIOR_WHERE)


def sql_responses() -> str:
    parts = [f"(SELECT {', '.join(RESPONSE_EXPRS)} FROM (SELECT doc_id, lang, source, {a} AS attempt FROM documents))"
             for a in ATTEMPTS]
    return " UNION ALL ".join(parts)


def sql_versions() -> str:
    return " UNION ALL ".join(f"({sql_select('pages', e)})" for e in VERSION_SETS)
