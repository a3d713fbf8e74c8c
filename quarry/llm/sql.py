"""DuckDB statements with the results that the queries must have."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"


def _stop_list() -> str:
    from quarry.llm.textstats import STOP_WORDS
    return ", ".join(f"'{v}'" for w in STOP_WORDS for v in (w, w.capitalize(), w.upper()))


def quality(source: str = "documents") -> str:
    """Statistics, base test and verdict of every row of ``source``."""
    return rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls
  FROM {source}),
win AS (
  SELECT doc_id, i, list_slice(ws, i, i + 7) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win), (SELECT unnest(range(0, 8)) AS k)
  WHERE c > 1 GROUP BY doc_id),
s AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')))::BIGINT AS n_upper,
    len(ls)::BIGINT AS n_lines,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    len(list_filter(ws, lambda x: x IN ({_stop_list()})))::BIGINT AS n_stop,
    len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1]))::BIGINT AS n_adjacent,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 2 AND 12 AND n_symbols / n_words <= 0.1
    AND n_stop / n_words >= 0.03 AND n_upper / word_chars <= 0.5 AND n_adjacent / n_words <= 0.3
    AND (n_lines = 0 OR n_dup_lines / n_lines <= 0.5) AS kept
FROM b"""


def near_duplicates(shingle: int, percent: int, source: str = "documents") -> str:
    """Exact similarity join on shared shingles, then reachability."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{WORD}') AS ws FROM {source}),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < {shingle} THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - {shingle - 2}), lambda i: array_to_string(ws[i:i + {shingle - 1}], ' '))) END AS ss
  FROM w),
x AS (SELECT doc_id, len(ss) AS n, unnest(ss) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p WHERE 100 * c >= {percent} * (na + nb - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM {source} UNION SELECT r.a, k.b FROM r JOIN both_ways k ON r.b = k.a)
SELECT s.doc_id, len(ss)::BIGINT AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept
FROM s JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) m ON m.a = s.doc_id"""


NEAREST = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
r AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM r) WHERE rank <= 5"""


REPEATS = """
WITH b AS (SELECT doc_id, encode(coalesce(text, '')) AS t, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, n, i, md5(t[i:i + 399]) AS h FROM (SELECT doc_id, t, n, unnest(range(1, n - 398)) AS i FROM b)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS c FROM w) WHERE c > 1),
g AS (SELECT doc_id, i, i > 400 + lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) AS fresh FROM d),
k AS (SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
r AS (SELECT doc_id, run, min(i) AS lo, max(i) + 400 AS hi FROM k GROUP BY ALL),
edges AS (
  SELECT doc_id, lo, hi FROM r UNION ALL SELECT doc_id, n + 1, n + 1 FROM b),
gaps AS (SELECT doc_id, lo, lag(hi, 1, 1) OVER (PARTITION BY doc_id ORDER BY lo) AS since FROM edges),
kept AS (
  SELECT gaps.doc_id, string_agg(CASE WHEN lo > since THEN hex(t[since:lo - 1]) ELSE '' END, '' ORDER BY lo) AS x
  FROM gaps JOIN b USING (doc_id) GROUP BY gaps.doc_id),
s AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans FROM r GROUP BY doc_id)
SELECT b.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(x)) AS kept_sha256
FROM b JOIN kept USING (doc_id) LEFT JOIN s USING (doc_id)"""


#: The checksum's table follows from its polynomial, eight halvings a byte.
_HALF = "CASE WHEN {0} % 2 = 1 THEN xor({0} // 2, 3988292384) ELSE {0} // 2 END"
TRIE = f"""
WITH RECURSIVE crc(i, k, v) AS (
  SELECT i, 0, i FROM (SELECT unnest(range(0, 256)) AS i) UNION ALL SELECT i, k + 1, {_HALF.format('v')} FROM crc WHERE k < 8),
t256 AS (SELECT list(v ORDER BY i) AS t FROM crc WHERE k = 8),
turns AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (
  SELECT conv_id, own, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1])), 4294967295) % 6 AS h
  FROM turns, t256),
r AS (
  SELECT a.conv_id, list_concat(coalesce(b.own, [])[1:a.h], a.own[a.h + 1:]) AS seq
  FROM h a LEFT JOIN turns b ON b.conv_id = a.conv_id - a.conv_id % 100),
n AS (SELECT conv_id, seq, len(seq) AS size, d, seq[1:d] AS node FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM r)),
g AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * length(node[d].text) END AS saved
  FROM n GROUP BY node, d),
c AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM g WHERE d > 0 GROUP BY 1),
x AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN c USING (node)),
s AS (
  SELECT up, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT node[1:k] AS up, n_children, saved FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM x)) GROUP BY up)
SELECT x.conv_id, x.d::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n_convs::BIGINT AS n_convs, x.n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, x.ends_sha256
FROM x JOIN s ON s.up = x.node LEFT JOIN g p ON x.d > 0 AND p.node = x.node[1:x.d - 1]"""


SQL = {"op11_prefix_trie": TRIE, "op7_suffixes": REPEATS, "op8_vptree": NEAREST, "op5_minhash": near_duplicates(3, 85), "op1_quality_rules": quality()}
