"""DuckDB oracle SQL, one independent statement per registered query.

Shared fragments are built by small Python helpers so that every statement is
plain SQL over the pre-registered views.  Fixed values (regex patterns,
entity table, prompt text) are imported from the library where they are
stated once.
"""

from __future__ import annotations

from quarry.functions import html as H
from quarry.functions import urls as U
from quarry.functions.analysis import MAX_TOPICS, MIN_TOPICS, PROMPT_HEAD, PROMPT_TEXT_LABEL
from quarry.functions.text import sql_whitespace_literal

WS = sql_whitespace_literal()


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def rx(x: str, pattern: str, repl: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(repl)}, 'g')"


def rx1(x: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(repl)})"


def url_key(x: str) -> str:
    s = strip(x)
    s = rx(s, U.LEADING_C0_RE)
    s = rx(s, U.UNSAFE_RE)
    s = rx(s, U.FRAGMENT_RE)
    s = rx1(s, U.EMPTY_QUERY_RE, r"\1")
    scheme = f"regexp_extract({s}, {q(U.SCHEME_RE)}, 1)"
    s2 = f"(CASE WHEN {scheme} = '' THEN {s} ELSE lower({scheme}) || substr({s}, length({scheme}) + 1) END)"
    path = f"regexp_extract({s2}, {q(U.PATH_RE)}, 1)"
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN suffix({s2}, '/') AND {path} NOT IN ('', '/') "
            f"THEN substr({s2}, 1, length({s2}) - 1) ELSE {s2} END)")


def source_domain(x: str) -> str:
    return f"nullif(regexp_extract(coalesce({x}, ''), {q(U.AUTHORITY_RE)}, 1), '')"


def url_valid(x: str) -> str:
    return f"coalesce(regexp_matches({x}, {q(U.VALID_URL_RE)}) AND length({x}) <= {U.MAX_URL_LENGTH}, false)"


def decode_entities(x: str) -> str:
    names = "MAP {" + ", ".join(f"'{k}': chr({n})" for k, n in H.NAMED.items()) + "}"
    def char(n):
        return f"CASE WHEN {n} = 0 OR {n} > 1114111 OR {n} BETWEEN 55296 AND 57343 THEN chr(65533) ELSE chr({n}::INT) END"
    dec = char("try_cast(regexp_extract(p, '^#0*([0-9]{1,7});', 1) AS BIGINT)")
    hexa = char("try_cast('0x' || regexp_extract(p, '^#[xX]0*([0-9a-fA-F]{1,6});', 1) AS BIGINT)")
    rest = "substr(p, instr(p, ';') + 1)"
    name = "regexp_extract(p, '^([A-Za-z][A-Za-z0-9]{1,30});', 1)"
    piece = (f"CASE WHEN i = 1 THEN p WHEN regexp_matches(p, '^#0*[0-9]{{1,7}};') THEN {dec} || {rest} "
             f"WHEN regexp_matches(p, '^#[xX]0*[0-9a-fA-F]{{1,6}};') THEN {hexa} || {rest} "
             f"WHEN {names}[{name}] IS NOT NULL THEN {names}[{name}] || {rest} ELSE '&' || p END")
    return f"array_to_string(list_transform(string_split({x}, '&'), lambda p, i: {piece}), '')"


def extract_text(html: str) -> str:
    h = rx(html, H.COMMENT_RE)
    h = rx(h, H.BOILERPLATE_RE)
    cands = [f"nullif(regexp_extract({h}, {q(H.container_re(t))}, 1), '')" for t in H.CONTAINER_TAGS]
    cands.append(f"nullif(regexp_extract({h}, {q(H.BODY_RE)}, 1), '')")
    cands.append(h)
    t = f"coalesce({', '.join(cands)})"
    t = rx(t, H.BREAK_RE, "\n")
    t = rx(t, H.BLOCK_RE, "\n")
    t = rx(t, H.TAG_RE)
    t = rx(t, H.NEWLINE_SQUEEZE_RE, "\n")
    t = decode_entities(t)
    return f"nullif({strip(t)}, '')"


def _inline(x: str) -> str:
    return f"nullif({strip(decode_entities(rx(x, H.TAG_RE)))}, '')"


def extract_title(html: str) -> str:
    og = "coalesce(" + ", ".join(_inline(f"regexp_extract({html}, {q(r)}, 1)") for r in H.OG_TITLE_RES) + ")"
    ti = _inline(f"regexp_extract({html}, {q(H.TITLE_RE)}, 1)")
    h1 = _inline(f"regexp_extract({html}, {q(H.H1_RE)}, 1)")
    return f"coalesce({og}, {ti}, {h1})"


def sq_l2(a: str, b: str) -> str:
    return (f"list_sum(list_transform(range(1, len({a}) + 1), "
            f"lambda i: ({a}[i]::DOUBLE - {b}[i]::DOUBLE) * ({a}[i]::DOUBLE - {b}[i]::DOUBLE)))")


def build_prompt(title: str, text: str) -> str:
    return strip(f"{q(PROMPT_HEAD)} || coalesce({title}, 'None') || {q(PROMPT_TEXT_LABEL)} || coalesce({text}, 'None')")


TOPIC_BOUNDS = (MIN_TOPICS, MAX_TOPICS)


# ============================================================ shared CTEs
from quarry.operators import scrape as S  # noqa: E402
from quarry.sources import derived as D  # noqa: E402

RUN_TS = D.RUN_TS


def cte_urls() -> str:
    """lines -> urls (list semantics) -> keyed."""
    return f"""lines AS ({D.sql_url_lines()}),
urls AS (
  SELECT min(ord) AS ord, url FROM (SELECT ord, {strip('line')} AS url FROM lines)
  WHERE url <> '' AND NOT starts_with(url, '#') GROUP BY url),
keyed AS (SELECT ord, url, {url_key('url')} AS url_key FROM urls)"""


def cte_snap() -> str:
    return f"""snap_rows AS ({D.sql_snapshot_rows()}),
snap AS (
  SELECT url, page_id, final_url, http_status, content_type, html, fetch_error FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS rn FROM (
      SELECT {url_key('page_url')} AS url, page_id, final_url, http_status, content_type, html, fetch_error
      FROM snap_rows)) WHERE rn = 1)"""


def seen_sql(table: str) -> str:
    """Keys of stored URLs: each URL as stored and normalised."""
    return (f"SELECT DISTINCT url_key FROM (SELECT url AS url_key FROM {table} WHERE url IS NOT NULL AND url <> '' "
            f"UNION ALL SELECT {url_key('url')} FROM {table} WHERE url IS NOT NULL AND url <> '')")


def cte_prior_keys() -> str:
    return f"""raw_prior AS ({D.sql_raw_prior()}),
prior_keys AS ({seen_sql('raw_prior')})"""


def cte_records(todo: str, name: str, min_chars: int, extra: str = "") -> str:
    """Scrape records of the URLs in CTE ``todo`` (columns ord, url_key)."""
    err = (f"CASE WHEN NOT valid THEN {q(S.INVALID_URL)} "
           f"WHEN NOT found THEN {q('http error: ' + S.NO_SNAPSHOT)} "
           f"WHEN fetch_error IS NOT NULL THEN 'http error: ' || fetch_error "
           f"WHEN NOT has_html THEN {q(S.EMPTY_HTML)} "
           f"WHEN nch < {min_chars} THEN {q(S.TOO_SHORT.format(n=min_chars))} END")
    return f"""{name}_f AS (
  SELECT t.*, s.final_url, s.http_status AS hs, s.content_type AS ct, s.html, s.fetch_error,
         (s.url IS NOT NULL) AS found, {url_valid('t.url_key')} AS valid
  FROM {todo} t LEFT JOIN snap s ON s.url = t.url_key),
{name}_g AS (
  SELECT *, valid AND found AND fetch_error IS NULL AS fetch_ok FROM {name}_f),
{name}_h AS (
  SELECT *, fetch_ok AND coalesce(html, '') <> '' AS has_html FROM {name}_g),
{name}_x AS (
  SELECT *, CASE WHEN has_html THEN {extract_text('html')} END AS xt,
         CASE WHEN has_html THEN {source_domain('final_url')} END AS source,
         CASE WHEN has_html THEN {extract_title('html')} END AS title FROM {name}_h),
{name}_y AS (SELECT *, coalesce(length(xt), 0) AS nch FROM {name}_x),
{name} AS (
  SELECT ord, {extra} url_key AS url, source, title,
         CASE WHEN has_html AND nch >= {min_chars} THEN xt END AS text,
         {q(RUN_TS)} AS fetched_at,
         CASE WHEN ({err}) IS NULL THEN 'ok' ELSE 'failed' END AS status,
         {err} AS error,
         CAST(CASE WHEN fetch_ok THEN hs END AS INTEGER) AS http_status,
         CASE WHEN fetch_ok THEN ct END AS content_type,
         CAST(CASE WHEN has_html THEN nch ELSE 0 END AS INTEGER) AS chars
  FROM {name}_y)"""


RAW_COLS = "ord, url, source, title, text, fetched_at, status, error, http_status, content_type, chars"

SQL: dict[str, str] = {}

SQL["url_list_scan"] = f"WITH {cte_urls()} SELECT ord, url FROM urls"
SQL["normalize_url"] = f"WITH lines AS ({D.sql_url_lines()}) SELECT ord, line, {url_key('line')} AS url_key FROM lines"
SQL["source_domain"] = f"SELECT page_id, url, {source_domain('url')} AS source FROM pages"
SQL["url_validity"] = (f"WITH lines AS ({D.sql_url_lines()}), k AS (SELECT ord, {url_key('line')} AS url_key FROM lines) "
                       f"SELECT ord, url_key, {url_valid('url_key')} AS valid FROM k")
SQL["seen_keys"] = f"WITH {cte_prior_keys()} SELECT url_key FROM prior_keys"
SQL["dedup_first"] = f"""WITH {cte_urls()}
SELECT url_key, ord, url FROM (
  SELECT *, row_number() OVER (PARTITION BY url_key ORDER BY ord) AS rn FROM keyed) WHERE rn = 1"""
SQL["contains_url"] = f"""WITH {cte_urls()}, {cte_prior_keys()}
SELECT k.ord, k.url_key, (p.url_key IS NOT NULL) AS present
FROM keyed k LEFT JOIN prior_keys p ON p.url_key = k.url_key"""
SQL["scrape_limit"] = f"WITH {cte_urls()} SELECT ord, url, url_key FROM keyed ORDER BY ord LIMIT 100"
SQL["scrape_incremental"] = f"""WITH {cte_urls()}, {cte_prior_keys()},
first AS (SELECT url_key, min(ord) AS ord FROM keyed GROUP BY url_key)
SELECT url_key, ord FROM first ANTI JOIN prior_keys USING (url_key)"""
SQL["page_scan"] = f"WITH {cte_snap()} SELECT url, page_id, final_url, http_status, content_type, html, fetch_error FROM snap"
SQL["extract_title"] = f"SELECT page_id, {extract_title('html')} AS title FROM pages"
SQL["extract_text"] = f"SELECT page_id, {extract_text('html')} AS text FROM pages"
SQL["text_length"] = f"SELECT page_id, CAST(coalesce(length({extract_text('html')}), 0) AS INTEGER) AS chars FROM pages"
SQL["min_chars_gate"] = f"""WITH x AS (SELECT page_id, {extract_text('html')} AS t FROM pages),
y AS (SELECT page_id, t, CAST(coalesce(length(t), 0) AS INTEGER) AS chars FROM x),
g AS (SELECT * FROM y CROSS JOIN (SELECT unnest([300, 500]) AS min_chars))
SELECT page_id, min_chars, CASE WHEN chars >= min_chars THEN t END AS text, chars FROM g"""
SQL["scrape_records"] = f"""WITH {cte_urls()}, {cte_snap()},
todo AS (SELECT url_key, min(ord) AS ord FROM keyed GROUP BY url_key),
{cte_records('todo', 'rec', 500)}
SELECT {RAW_COLS} FROM rec"""
_SCRAPE_RUN = f"""WITH {cte_urls()}, {cte_snap()}, {cte_prior_keys()},
first AS (SELECT url_key, min(ord) AS ord FROM keyed GROUP BY url_key),
todo AS (SELECT * FROM first ANTI JOIN prior_keys USING (url_key)),
{cte_records('todo', 'rec', 500)}"""
SQL["scrape_run"] = f"{_SCRAPE_RUN} SELECT {RAW_COLS} FROM rec"
SQL["scrape_summary"] = f"""{_SCRAPE_RUN}
SELECT count(*) AS total_input, count(r.status) AS added,
       count(*) FILTER (WHERE r.status = 'ok') AS ok,
       count(*) FILTER (WHERE r.status = 'failed') AS failed,
       count(*) FILTER (WHERE r.status IS NULL) AS skipped_existing
FROM keyed k LEFT JOIN rec r ON r.ord = k.ord"""
SQL["scrape_single"] = f"""WITH {cte_urls()}, {cte_snap()}, {cte_prior_keys()},
todo AS (SELECT k.ord, k.url_key, (p.url_key IS NOT NULL) AS in_prior
         FROM keyed k LEFT JOIN prior_keys p ON p.url_key = k.url_key),
{cte_records('todo', 'rec', 300, 'in_prior,')}
SELECT ord, url, 1 AS total,
       CASE WHEN NOT in_prior AND status = 'ok' THEN 1 ELSE 0 END AS ok,
       CASE WHEN NOT in_prior AND status <> 'ok' THEN 1 ELSE 0 END AS failed,
       CASE WHEN in_prior THEN 1 ELSE 0 END AS skipped_existing,
       CASE WHEN NOT in_prior THEN status END AS status
FROM rec"""

SQL["knn_batch"] = f"""
WITH pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS id, {sq_l2('q.embedding', 'c.embedding')} AS score
  FROM embeddings q CROSS JOIN embeddings c)
SELECT query_id, CAST(rank AS INTEGER) AS rank, score, id FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, id) AS rank FROM pairs)
WHERE rank <= 5"""

SQL["knn_single"] = f"""
WITH e AS (SELECT vec_id, embedding FROM embeddings),
probe AS (
  SELECT list(x ORDER BY pos) AS v FROM (
    SELECT pos, max(x) AS x FROM (
      SELECT unnest(embedding) AS x, unnest(range(len(embedding))) AS pos FROM e) GROUP BY pos)),
scored AS (SELECT e.vec_id, {sq_l2('probe.v', 'e.embedding')} AS score FROM e CROSS JOIN probe)
SELECT CAST(row_number() OVER (ORDER BY score, vec_id) AS INTEGER) AS rank, score, vec_id
FROM scored ORDER BY score, vec_id LIMIT 5"""


# ============================================================ annotation
from quarry.operators import annotate as A  # noqa: E402


def cte_validated(src: str = "responses") -> str:
    """Validation of raw model text, column for column with the Spark side."""
    lo, hi = TOPIC_BOUNDS
    return f"""responses AS ({D.sql_responses()}),
rv AS (SELECT doc_id, attempt, raw_text, CASE WHEN json_valid(raw_text) THEN raw_text::JSON END AS j FROM {src}),
rw AS (SELECT *, json_type(j) AS top, json_type(j, '$.summary') AS st,
              {strip("json_extract_string(j, '$.summary')")} AS s1, json_type(j, '$.topics') AS tt FROM rv),
rx AS (SELECT *,
         CASE WHEN tt = 'ARRAY' THEN coalesce(list_bool_and(list_transform(json_extract(j, '$.topics[*]'),
              lambda e: json_type(e) = 'VARCHAR')), true) END AS all_str,
         CASE WHEN tt = 'ARRAY' THEN list_filter(list_transform(json_extract_string(j, '$.topics[*]'),
              lambda e: lower({strip('e')})), lambda e: e <> '') END AS c0 FROM rw),
ry AS (SELECT *, list_filter(c0, lambda e, i: NOT list_contains(c0[1:i-1], e)) AS cl FROM rx),
rz AS (SELECT *, CASE
         WHEN raw_text IS NULL THEN 'RuntimeError: no model output'
         WHEN j IS NULL THEN 'ValueError: Invalid JSON from LLM'
         WHEN top <> 'OBJECT' THEN 'ValidationError: output is not an object'
         WHEN st IS NULL THEN 'ValidationError: summary: Field required'
         WHEN st <> 'VARCHAR' THEN 'ValidationError: summary must be a string'
         WHEN s1 = '' THEN 'ValidationError: summary must not be empty'
         WHEN tt IS NULL OR tt <> 'ARRAY' THEN 'ValidationError: topics must be a list'
         WHEN NOT all_str THEN 'ValidationError: topics must be strings'
         WHEN len(cl) < {lo} OR len(cl) > {hi} THEN 'ValidationError: topics must contain between 3 and 7 items'
       END AS error FROM ry),
validated AS (SELECT doc_id, attempt, error IS NULL AS valid, error,
                     CASE WHEN error IS NULL THEN s1 END AS summary,
                     CASE WHEN error IS NULL THEN cl END AS topics FROM rz)"""


def cte_offline_annotation(src: str, key: str, name: str) -> str:
    """The default offline annotator: first three sentences; five most
    frequent 4+ letter words.  Result columns: key, summary, topics, verr."""
    lo, hi = TOPIC_BOUNDS
    return f"""{name}_w AS (
  SELECT {key} AS k, w, count(*) AS n FROM (
    SELECT {key}, unnest(regexp_extract_all(lower(text), {q(A.TOPIC_TOKEN_RE)})) AS w FROM {src})
  GROUP BY ALL),
{name}_t AS (
  SELECT k, list(w ORDER BY r) AS topics FROM (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, w) AS r FROM {name}_w)
  WHERE r <= {A.TOPIC_COUNT} GROUP BY k),
{name}_s AS (
  SELECT s.{key} AS k, {strip(f"regexp_extract(s.text, {q(A.SUMMARY_RE)}, 0)")} AS summary,
         coalesce(t.topics, []) AS topics
  FROM {src} s LEFT JOIN {name}_t t ON t.k = s.{key}),
{name} AS (
  SELECT k, summary, topics, CASE
    WHEN summary = '' THEN 'ValidationError: summary must not be empty'
    WHEN len(topics) < {lo} OR len(topics) > {hi} THEN 'ValidationError: topics must contain between 3 and 7 items'
  END AS verr FROM {name}_s)"""


def cte_candidates(with_prior: bool) -> str:
    prior = ""
    src = "firsts"
    if with_prior:
        prior = f""",
enriched_prior AS ({D.sql_enriched_prior()}),
ai_keys AS ({seen_sql('enriched_prior')}),
cands AS (SELECT * FROM firsts ANTI JOIN ai_keys USING (url_key))"""
        src = "cands"
    return f"""raw AS ({D.sql_raw_docs()}),
elig AS (SELECT *, {url_key('url')} AS url_key FROM raw WHERE status = 'ok' AND {strip("coalesce(text, '')")} <> ''),
firsts AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY url_key ORDER BY ord) AS rn FROM elig) WHERE rn = 1){prior},
cand AS (SELECT * FROM {src})"""


ENRICHED_OUT = f"""ord, url, source, title, text, fetched_at,
  CASE WHEN verr IS NULL THEN 'ok' ELSE 'failed' END AS status,
  CASE WHEN verr IS NULL THEN error ELSE 'llm error: ' || verr END AS error,
  http_status, content_type, chars,
  CASE WHEN verr IS NULL THEN summary END AS summary,
  CASE WHEN verr IS NULL THEN array_to_string(topics, ', ') ELSE '' END AS topics,
  {q(A.DEFAULT_MODEL)} AS llm_model"""


def cte_enriched(with_prior: bool) -> str:
    return f"""{cte_candidates(with_prior)},
{cte_offline_annotation('cand', 'url_key', 'ann')},
enriched AS (SELECT c.*, a.summary, a.topics, a.verr FROM cand c LEFT JOIN ann a ON a.k = c.url_key)"""


SQL["build_prompt"] = f"WITH raw AS ({D.sql_raw_docs()}) SELECT ord, {build_prompt('title', 'text')} AS prompt FROM raw"
SQL["parse_response"] = f"WITH responses AS ({D.sql_responses()}) SELECT doc_id, attempt, json_valid(raw_text) AS json_ok FROM responses"
SQL["validate_response"] = f"WITH {cte_validated()} SELECT doc_id, attempt, valid, error, summary FROM validated"
SQL["clean_topics"] = f"""WITH {cte_validated()}
SELECT doc_id, attempt, CAST(len(topics) AS INTEGER) AS n_topics, array_to_string(topics, ', ') AS topics
FROM validated WHERE valid"""
SQL["first_valid_attempt"] = f"""WITH {cte_validated()},
firstok AS (SELECT doc_id, min(attempt) FILTER (WHERE valid) AS ok_attempt, arg_max(error, attempt) AS last_error
            FROM validated GROUP BY doc_id)
SELECT f.doc_id, f.ok_attempt IS NOT NULL AS valid, f.ok_attempt AS attempt,
       CASE WHEN f.ok_attempt IS NULL THEN f.last_error END AS error,
       v.summary, array_to_string(v.topics, ', ') AS topics
FROM firstok f LEFT JOIN validated v ON v.doc_id = f.doc_id AND v.attempt = f.ok_attempt"""
SQL["annotate_batch"] = f"""WITH docs AS (SELECT doc_id, text FROM documents),
{cte_offline_annotation('docs', 'doc_id', 'ann')}
SELECT k AS doc_id, verr IS NULL AS valid, verr AS error,
       CASE WHEN verr IS NULL THEN summary END AS summary,
       CASE WHEN verr IS NULL THEN array_to_string(topics, ', ') END AS topics
FROM ann"""
SQL["eligible_for_analysis"] = f"""WITH raw AS ({D.sql_raw_docs()})
SELECT ord, url FROM raw WHERE status = 'ok' AND {strip("coalesce(text, '')")} <> ''"""
SQL["analyze_incremental"] = f"WITH {cte_candidates(True)} SELECT url_key, ord FROM cand"
SQL["enrich"] = f"WITH {cte_enriched(False)} SELECT {ENRICHED_OUT} FROM enriched"
SQL["enrich_failures"] = f"""WITH {cte_candidates(False)}, {cte_validated()},
firstok AS (SELECT {q(D.DOC_URL_PREFIX)} || CAST(doc_id AS VARCHAR) AS k,
                   min(attempt) FILTER (WHERE valid) AS ok_attempt, arg_max(error, attempt) AS last_error
            FROM validated GROUP BY doc_id)
SELECT c.ord, c.url, 'failed' AS status, 'llm error: ' || coalesce(f.last_error, 'RuntimeError: no model output') AS error,
       CAST(NULL AS VARCHAR) AS summary, '' AS topics, 'replayed' AS llm_model
FROM cand c LEFT JOIN firstok f ON f.k = c.url_key
WHERE f.ok_attempt IS NULL"""
SQL["analyze_run"] = f"WITH {cte_enriched(True)} SELECT {ENRICHED_OUT} FROM enriched"
SQL["analyze_summary"] = f"""WITH {cte_enriched(True)}, e AS (SELECT {ENRICHED_OUT} FROM enriched)
SELECT count(*) FILTER (WHERE e.status = 'ok') AS processed,
       count(*) FILTER (WHERE e.status = 'failed') AS failed,
       count(*) FILTER (WHERE e.status IS NULL) AS skipped_already
FROM elig LEFT JOIN e ON e.ord = elig.ord"""
SQL["analyze_limit"] = f"""WITH {cte_enriched(True)}, e AS (SELECT {ENRICHED_OUT} FROM enriched),
s AS (SELECT *, coalesce(sum(CASE WHEN status = 'ok' THEN 1 ELSE 0 END) OVER (
        ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e)
SELECT * EXCLUDE (before) FROM s WHERE before < 100"""
SQL["success_limit"] = """WITH s AS (
  SELECT doc_id, quality, coalesce(sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) OVER (
    ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM labels)
SELECT doc_id, quality FROM s WHERE before < 100"""


# ============================================================ vectors
from quarry.functions import vectors as V  # noqa: E402
from quarry.operators.embed import EMPTY_TEXT  # noqa: E402
from quarry.plans.search import EMPTY_QUERY  # noqa: E402


def sql_tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), {q(V.TOKEN_SPLIT_RE)}), lambda tk_: tk_ <> '')"


def sql_embed(src: str, text: str, out: str = "vec", extra_cols: str = "") -> str:
    """``SELECT *, <vector> AS out FROM src``, staged so that every list is
    computed once per row (lambda bodies re-evaluate inlined expressions)."""
    d = V.EMBED_DIM
    bs = f"list_transform({sql_tokens(text)}, lambda tb_: ('0x' || substr(md5(tb_), 1, 8))::BIGINT % {d})"
    return f"""SELECT * EXCLUDE (e_b, e_c, e_n),
  CASE WHEN e_n > 0 THEN list_transform(e_c, lambda c_: CAST(CAST(c_ AS DOUBLE) / e_n AS FLOAT)) END AS {out}
FROM (SELECT *, sqrt(CAST(list_sum(list_transform(e_c, lambda c_: CAST(c_ AS BIGINT) * c_)) AS DOUBLE)) AS e_n
  FROM (SELECT *, list_transform(range({d}), lambda bi_: len(list_filter(e_b, lambda by_: by_ = bi_))) AS e_c
    FROM (SELECT *, {bs} AS e_b FROM {src})))"""


def sql_emb_sum(v: str) -> str:
    return f"list_sum(list_transform({v}, lambda x_: CAST(x_ AS DOUBLE)))"


def sql_embedding_text(title: str, summary: str, topics: str) -> str:
    return (f"concat_ws(chr(10) || chr(10), CASE WHEN {title} <> '' THEN {strip(title)} END, "
            f"CASE WHEN {summary} <> '' THEN {strip(summary)} END, "
            f"CASE WHEN coalesce(len({topics}), 0) > 0 THEN {q(V.TOPICS_LABEL)} || array_to_string({topics}, ', ') END)")


def sql_is_blank(x: str) -> str:
    return f"coalesce({strip(x)} = '', true)"


def cte_rec(with_prior: bool) -> str:
    return f"""{cte_enriched(with_prior)},
rec AS (SELECT ord, url, source, title, text, fetched_at,
   CASE WHEN verr IS NULL THEN 'ok' ELSE 'failed' END AS status,
   CASE WHEN verr IS NULL THEN error ELSE 'llm error: ' || verr END AS error,
   http_status, content_type, chars,
   CASE WHEN verr IS NULL THEN summary END AS summary,
   CASE WHEN verr IS NULL THEN topics ELSE CAST([] AS VARCHAR[]) END AS topics,
   {q(A.DEFAULT_MODEL)} AS llm_model FROM enriched)"""


def sql_vdocs(src: str) -> str:
    return f"""SELECT ord, coalesce(url, '') AS id, {sql_embedding_text('title', 'summary', 'topics')} AS text,
  url AS m_url, coalesce(title, '') AS m_title, coalesce(source, '') AS m_source,
  substr(coalesce(summary, ''), 1, {V.SUMMARY_CAP}) AS m_summary,
  coalesce(array_to_string(topics, ', '), '') AS m_topics,
  CAST(coalesce(len(topics), 0) AS INTEGER) AS m_topic_count FROM {src}"""


META_OUT = "m_url AS url, m_title AS title, m_source AS source, m_summary AS summary, m_topics AS topics, m_topic_count AS topic_count"


def cte_index(with_prior: bool) -> str:
    prior = ""
    src = "ix_first"
    if with_prior:
        prior = f""",
vector_prior AS ({D.sql_vector_prior()}),
ix_new AS (SELECT * FROM ix_first ANTI JOIN vector_prior USING (id))"""
        src = "ix_new"
    return f"""{cte_rec(False)},
ix_elig AS (SELECT * FROM rec WHERE status = 'ok' AND coalesce(summary <> '', false)),
ix_docs AS ({sql_vdocs('ix_elig')}),
ix_b AS (SELECT *, {sql_is_blank('text')} AS blank FROM ix_docs),
ix_first AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord) AS rn FROM ix_b WHERE NOT blank) WHERE rn = 1){prior},
ix_emb AS ({sql_embed(src, 'text')}),
ix_rows AS (
  SELECT * EXCLUDE (blank, vec), vec, CASE WHEN vec IS NULL OR len(vec) <> {V.EMBED_DIM}
    THEN 'RuntimeError: Invalid embedding response' END AS error FROM ix_emb
  UNION ALL BY NAME
  SELECT * EXCLUDE (blank), CAST(NULL AS FLOAT[]) AS vec, {q(EMPTY_TEXT)} AS error FROM ix_b WHERE blank),
ix AS (SELECT *, CASE WHEN error IS NULL THEN 'ok' ELSE 'failed' END AS status FROM ix_rows)"""


SQL["embedding_text"] = f"WITH {cte_rec(False)}, vd AS ({sql_vdocs('rec')}) SELECT ord, id, text FROM vd"
SQL["vector_document"] = f"WITH {cte_rec(False)}, vd AS ({sql_vdocs('rec')}) SELECT ord, id, text, {META_OUT} FROM vd"
SQL["flatten_metadata"] = f"""WITH {cte_rec(False)}
SELECT ord, url, title, array_to_string(topics, ', ') AS topics, chars, status FROM rec"""
SQL["result_preview"] = f"""SELECT doc_id,
  CASE WHEN length(text) > {V.PREVIEW_CHARS} THEN substr(text, 1, {V.PREVIEW_CHARS}) || {q(V.PREVIEW_MARK)} ELSE text END AS preview,
  printf('%.4f', CAST(n_chars AS DOUBLE) / 7.0) AS score_text FROM documents"""
SQL["embedding_guard"] = f"""WITH {cte_rec(False)}, vd AS ({sql_vdocs('rec')})
SELECT ord, id, {sql_is_blank('text')} AS blank, CASE WHEN {sql_is_blank('text')} THEN {q(EMPTY_TEXT)} END AS error FROM vd"""
SQL["vector_validity"] = f"SELECT vec_id, coalesce(embedding IS NOT NULL AND len(embedding) = {V.EMBED_DIM}, false) AS ok FROM embeddings"
SQL["embed_batch"] = f"""WITH x0 AS (SELECT doc_id, text, CAST(len({sql_tokens('text')}) AS INTEGER) AS n_tokens FROM documents),
x AS ({sql_embed('x0', 'text', 'v')})
SELECT doc_id, n_tokens, {sql_emb_sum('v')} AS emb_sum,
  CASE WHEN {sql_is_blank('text')} THEN {q(EMPTY_TEXT)}
       WHEN v IS NULL OR len(v) <> {V.EMBED_DIM} THEN 'RuntimeError: Invalid embedding response' END AS embed_error
FROM x"""
SQL["eligible_for_index"] = f"WITH {cte_rec(False)} SELECT ord, url FROM rec WHERE status = 'ok' AND coalesce(summary <> '', false)"
SQL["index_incremental"] = f"WITH {cte_index(True)} SELECT id, ord FROM ix_new"
_IX_OUT = f"ord, id, text, status, error, {META_OUT}, {sql_emb_sum('vec')} AS emb_sum"
SQL["index_run"] = f"WITH {cte_index(True)} SELECT {_IX_OUT} FROM ix"
SQL["index_summary"] = f"""WITH {cte_index(True)}
SELECT count(*) FILTER (WHERE ix.status = 'ok') AS added,
       count(*) FILTER (WHERE r.status = 'ok' AND coalesce(r.summary <> '', false) AND ix.status IS NULL) AS skipped_existing,
       count(*) FILTER (WHERE NOT (r.status = 'ok' AND coalesce(r.summary <> '', false))) AS skipped_ineligible,
       count(*) FILTER (WHERE ix.status = 'failed') AS failed
FROM rec r LEFT JOIN ix ON ix.ord = r.ord"""
SQL["index_limit"] = f"""WITH {cte_index(True)},
s AS (SELECT *, coalesce(sum(CASE WHEN status = 'ok' THEN 1 ELSE 0 END) OVER (
        ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ix)
SELECT {_IX_OUT} FROM s WHERE before < 100"""
SQL["query_guard"] = f"""WITH raw AS ({D.sql_raw_docs()})
SELECT ord AS query_id, {q(EMPTY_QUERY)} AS error FROM raw WHERE {sql_is_blank('title')}"""
SQL["search_run"] = f"""WITH {cte_index(False)},
vec AS (SELECT * FROM ix WHERE status = 'ok'),
qs AS (SELECT ord AS query_id, title AS query FROM raw WHERE NOT {sql_is_blank('title')}),
qv AS ({sql_embed('qs', 'query', 'qvec')}),
qok AS (SELECT * FROM qv WHERE qvec IS NOT NULL AND len(qvec) = {V.EMBED_DIM}),
pairs AS (SELECT qok.query_id, vec.id, {sq_l2('qok.qvec', 'vec.vec')} AS score FROM qok CROSS JOIN vec),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, id) AS rank FROM pairs) WHERE rank <= 5)
SELECT t.query_id, CAST(t.rank AS INTEGER) AS rank, t.score, t.id, printf('%.4f', t.score) AS score_text,
  CASE WHEN length(v.text) > {V.PREVIEW_CHARS} THEN substr(v.text, 1, {V.PREVIEW_CHARS}) || {q(V.PREVIEW_MARK)} ELSE v.text END AS preview,
  v.m_title AS title, v.m_topics AS topics
FROM top t JOIN vec v ON v.id = t.id"""


# ============================================================ ingest, lookups, unions

SQL["latest_ok"] = f"""WITH v AS ({D.sql_versions()}),
k AS (SELECT *, {url_key('url')} AS url_key FROM v WHERE status = 'ok' AND NOT {sql_is_blank('text')})
SELECT url_key, ord, text FROM (
  SELECT *, row_number() OVER (PARTITION BY url_key ORDER BY ord DESC) AS rn FROM k) WHERE rn = 1"""

SQL["classify_outcome"] = f"""{_SCRAPE_RUN}
SELECT k.ord, k.url_key, CASE WHEN r.status = 'ok' THEN 'new_ok' WHEN r.status = 'failed' THEN 'new_failed'
  WHEN p.url_key IS NOT NULL THEN 'skipped_existing' ELSE 'duplicate' END AS outcome
FROM keyed k LEFT JOIN rec r ON r.ord = k.ord LEFT JOIN prior_keys p ON p.url_key = k.url_key"""

SQL["append_union"] = f"""{_SCRAPE_RUN}
SELECT ord, url, status FROM raw_prior
UNION ALL SELECT ord + 1099511627776 AS ord, url, status FROM rec"""


def _ingest_sql() -> str:
    vd_text = sql_embedding_text('title', 'summary', 'topics')
    return f"""WITH {cte_urls()}, {cte_snap()}, {cte_prior_keys()},
keys AS (SELECT url_key, min(ord) AS ord FROM keyed GROUP BY url_key),
ai_prior AS ({D.sql_ingest_ai_prior()}),
vprior AS ({D.sql_ingest_vector_prior()}),
ai_keys AS ({seen_sql('ai_prior')}),
vkeys AS (SELECT DISTINCT {url_key('url')} AS url_key FROM vprior),
kk AS (SELECT keys.url_key, keys.ord, a.url_key IS NOT NULL AS analysed, p.url_key IS NOT NULL AS scraped
       FROM keys LEFT JOIN ai_keys a ON a.url_key = keys.url_key LEFT JOIN prior_keys p ON p.url_key = keys.url_key),
work AS (SELECT * FROM kk WHERE NOT analysed),
todo AS (SELECT ord, url_key FROM work WHERE NOT scraped),
{cte_records('todo', 'newrec', 300)},
allraw AS (SELECT ord, url, status, title, text FROM raw_prior
           UNION ALL SELECT ord + 1099511627776, url, status, title, text FROM newrec),
usable AS (SELECT *, {url_key('url')} AS url_key FROM allraw WHERE status = 'ok' AND NOT {sql_is_blank('text')}),
latest AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY url_key ORDER BY ord DESC) AS rn FROM usable) WHERE rn = 1),
cand AS (SELECT * FROM latest SEMI JOIN work USING (url_key)),
{cte_offline_annotation('cand', 'url_key', 'ann')},
ai AS (SELECT c.url_key, c.title, a.summary, a.topics, a.verr FROM cand c LEFT JOIN ann a ON a.k = c.url_key),
docs AS (SELECT url_key, {vd_text} AS text FROM ai WHERE verr IS NULL AND NOT {sql_is_blank('summary')}),
docs2 AS (SELECT docs.*, v.url_key IS NOT NULL AS stored FROM docs LEFT JOIN vkeys v ON v.url_key = docs.url_key),
emb0 AS (SELECT * FROM docs2 WHERE NOT stored),
emb AS ({sql_embed('emb0', 'text')}),
embr AS (SELECT url_key, CASE WHEN {sql_is_blank('text')} THEN 'x' WHEN vec IS NULL OR len(vec) <> {V.EMBED_DIM} THEN 'x' END AS embed_error FROM emb),
st AS (
  SELECT w.url_key, l.url_key IS NOT NULL AS has_raw,
         CASE WHEN ai.url_key IS NULL THEN NULL WHEN ai.verr IS NULL THEN 'ok' ELSE 'failed' END AS ai_status,
         d.stored, e.embed_error
  FROM work w LEFT JOIN latest l ON l.url_key = w.url_key LEFT JOIN ai ON ai.url_key = w.url_key
       LEFT JOIN docs2 d ON d.url_key = w.url_key LEFT JOIN embr e ON e.url_key = w.url_key),
st2 AS (SELECT *, CASE WHEN NOT has_raw THEN 'scrape' WHEN ai_status <> 'ok' THEN 'analyze'
                       WHEN stored IS NULL THEN 'index' WHEN NOT stored AND embed_error IS NOT NULL THEN 'index' END AS stage
        FROM st)
SELECT url_key, CASE WHEN stage IS NULL THEN 'ok' ELSE 'failed' END AS status, stage, false AS skipped,
       CAST(NULL AS VARCHAR) AS reason,
       CAST(CASE WHEN stage IS NULL AND NOT stored THEN 1 WHEN stage IS NULL THEN 0 END AS INTEGER) AS index_added
FROM st2
UNION ALL
SELECT url_key, 'ok', CAST(NULL AS VARCHAR), true, 'already_analyzed', CAST(NULL AS INTEGER) FROM kk WHERE analysed"""


SQL["ingest_run"] = _ingest_sql()


# ============================================================ sources, sinks, streaming

SQL["jsonl_scan"] = SQL["scrape_run"]
SQL["url_file_scan"] = f"WITH {cte_urls()} SELECT url FROM urls"
_FILE_LINES = f"lines AS (SELECT row_number() OVER (ORDER BY ord) - 1 AS ord, line FROM ({D.sql_url_lines()}))"
SQL["url_file_limit"] = (f"WITH {cte_urls().replace(f'lines AS ({D.sql_url_lines()})', _FILE_LINES)} "
                         "SELECT ord, url, url_key FROM keyed ORDER BY ord LIMIT 100")
SQL["vector_append"] = f"""SELECT 'vec-' || CAST(vec_id AS VARCHAR) AS id, 'label ' || CAST(label AS VARCHAR) AS text,
  {sql_emb_sum('embedding')} AS emb_sum FROM embeddings"""
SQL["stream_ingest"] = f"""SELECT url_key, min(page_id) AS page_id FROM (
  SELECT {url_key('url')} AS url_key, page_id FROM pages) GROUP BY url_key"""
SQL["stream_dedup"] = f"SELECT DISTINCT {url_key('url')} AS url_key FROM pages"
SQL["stream_flow"] = f"""WITH {cte_snap()},
todo AS (SELECT url AS url_key, page_id AS ord FROM snap),
{cte_records('todo', 'rec', 500)}
SELECT url, status, error, title, chars FROM rec"""


def _stored_sql(keys: str) -> str:
    """The rows that an ingest of ``keys`` (url_key, ord) leaves in its tables."""
    nothing = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in ("summary", "topics"))
    return f"""WITH {cte_urls()}, {cte_snap()},
todo AS ({keys}),
{cte_records('todo', 'rec', 300)},
cand AS (SELECT * FROM rec WHERE status = 'ok' AND NOT {sql_is_blank('text')}),
{cte_offline_annotation('cand', 'url', 'ann')},
ai AS (SELECT c.ord, c.url, c.source, c.title, c.status, c.error, c.chars, a.summary, a.topics
       FROM cand c JOIN ann a ON a.k = c.url WHERE a.verr IS NULL),
usable AS (SELECT * FROM ai WHERE NOT {sql_is_blank('summary')}),
vd AS ({sql_vdocs('usable')}),
emb AS ({sql_embed('vd', 'text')})
SELECT 'raw' AS stored, url, status, error, title, chars, {nothing}, CAST(NULL AS DOUBLE) AS emb_sum FROM rec
UNION ALL SELECT 'enriched', url, status, error, title, chars, summary, array_to_string(topics, ', '), NULL FROM ai
UNION ALL SELECT 'vectors', id, NULL, NULL, m_title, NULL, m_summary, m_topics, {sql_emb_sum('vec')} FROM emb WHERE vec IS NOT NULL"""


SQL["ingest_stored"] = _stored_sql("SELECT url_key, min(ord) AS ord FROM keyed GROUP BY url_key")
SQL["stream_pipeline"] = _stored_sql("SELECT url AS url_key, page_id AS ord FROM snap")


# ------------------------------------------------------------ failing models

SQL["annotate_isolated"] = """SELECT doc_id, NOT bad AS valid, CASE WHEN NOT bad THEN 1 END AS attempt,
  CASE WHEN bad THEN 'RuntimeError: refused' END AS error, CASE WHEN NOT bad THEN n || ' characters' END AS summary,
  CASE WHEN NOT bad THEN 'a, b, c' END AS topics
FROM (SELECT doc_id, length(coalesce(text, '')) AS n, length(coalesce(text, '')) % 50 = 7 AS bad FROM documents)"""
SQL["embed_isolated"] = f"""SELECT doc_id, CASE WHEN error IS NULL THEN CAST(64 * (length(text) % 11) AS DOUBLE) END AS emb_sum, error AS embed_error
FROM (SELECT *, CASE WHEN {sql_is_blank('text')} THEN {q(EMPTY_TEXT)} WHEN length(text) % 50 = 7 THEN 'RuntimeError: refused' END AS error
  FROM documents)"""
SQL["index_retry"] = f"""WITH e AS (
  SELECT doc_id AS ord, coalesce(source, '') AS id, {strip('text')} AS t,
    CASE WHEN {sql_is_blank('text')} THEN {q(EMPTY_TEXT)} WHEN length({strip('text')}) % 40 <> 0 THEN 'RuntimeError: refused' END AS error
  FROM documents WHERE coalesce(text, '') <> '')
SELECT ord, id, CASE WHEN error IS NULL THEN 'ok' ELSE 'failed' END AS status, error,
  CASE WHEN error IS NULL THEN CAST(64 * (length(t) % 11) AS DOUBLE) END AS emb_sum
FROM (SELECT *, min(ord) FILTER (error IS NULL) OVER (PARTITION BY id) AS stop FROM e) WHERE stop IS NULL OR ord <= stop"""
