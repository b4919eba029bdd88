"""DuckDB statements for the queries that SQL can express, written on their own."""

from __future__ import annotations

from curbwise.llm.quality import STOP_WORDS

_LIST = ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws}))

# x: one text per row id r
_MEASURED = r"""
docs AS (SELECT row_number() OVER () AS r, *, coalesce(text, '') AS x FROM {docs}),
tok AS (SELECT r, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS w,
               list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ln FROM docs),
win AS (SELECT r, i, list_slice(w, i, i + 4) AS five
        FROM tok, unnest(range(1, len(w) - 3)) AS u(i)),
dup AS (SELECT r, i, count(*) OVER (PARTITION BY r, five) AS n FROM win),
cov AS (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM dup WHERE n >= 2),
rep AS (SELECT r, sum(least(5, coalesce(nxt - i, 5))) AS n_rep FROM cov GROUP BY r),
m AS (SELECT d.*, len(w) AS n_words, length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ln) - len(list_distinct(ln)) AS n_dup_lines, coalesce(n_rep, 0)::BIGINT AS n_repeat_words,
             len(list_filter(w, lambda v: lower(v) IN (""" + _LIST + r"""))) AS n_stop, len(ln) AS n_lines,
             len(list_filter(ln, lambda l: starts_with(l, '-') OR starts_with(l, '*') OR starts_with(l, '•'))) AS n_bullet,
             len(list_filter(ln, lambda l: suffix(l, '...') OR suffix(l, '…'))) AS n_ell
      FROM docs d JOIN tok USING (r) LEFT JOIN rep USING (r)),
q AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
             (100 * word_chars < 200 * n_words OR 100 * word_chars > 1500 * n_words OR 100 * n_symbols > 25 * n_words
              OR (n_words >= 50 AND 100 * n_stop < 2 * n_words) OR 100 * n_dup_lines > 30 * n_lines
              OR 100 * n_bullet > 90 * n_lines OR 100 * n_ell > 30 * n_lines) AS bad
      FROM m)"""


def measured(docs: str) -> str:
    return _MEASURED.replace("{docs}", docs)


OP8 = f"""WITH {measured('documents')}
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT bad AS kept FROM q"""

OP2 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(/?s>|</?SYS>>|/?INST\]|/?ROLE\]|TEXT\])', '\1\\\2\3', 'g') AS et,
         regexp_replace(role, '([<\[])(\\*)(/?s>|</?SYS>>|/?INST\]|/?ROLE\]|TEXT\])', '\1\\\2\3', 'g') AS er FROM c),
n AS (
  SELECT *, length(et) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 WHEN 'system' THEN 19
                                   ELSE 23 + length(er) END AS fc,
         et <> text OR er <> role OR regexp_matches(text, '[<\[]\\+(/?s>|</?SYS>>|/?INST\]|/?ROLE\]|TEXT\])') AS clash FROM e)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(fc)::BIGINT AS formatted_chars, bool_or(clash) AS escaped, true AS round_trip
FROM n GROUP BY conv_id"""

OP3 = r"""
WITH a AS (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
c AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM b),
d AS (SELECT *, CASE WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                     WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
                     WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/') THEN 'com/'
                     WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
                     WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/' END AS rule FROM c)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM d"""


def mixed(docs: str) -> str:
    """CTEs up to ``mx``: doc_id, size, source_size, target, taken (and r, text) of ``docs``."""
    return r"""
z AS (SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
             md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS o FROM {docs}),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
      FROM z GROUP BY source),
t AS (SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
             sum(3 * source_size) OVER f - 3 * source_size AS capped, sum(weight) OVER () - sum(weight) OVER f + weight AS rw
      FROM s WINDOW f AS (ORDER BY (3 * source_size)::DOUBLE / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
lv AS (SELECT total - capped AS rest, rw FROM t WHERE (total - capped) * weight <= cap * rw
       ORDER BY cap::DOUBLE / weight, source NULLS LAST LIMIT 1),
g AS (SELECT t.source, source_size, CASE WHEN cap * lv.rw < lv.rest * weight THEN cap::DOUBLE
             ELSE lv.rest::DOUBLE * weight / lv.rw END AS target FROM t, lv),
k AS (SELECT z.*, g.source_size, g.target, round(g.target)::BIGINT AS goal,
             sum(size) OVER (PARTITION BY z.source ORDER BY o, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS ahead
      FROM z JOIN g ON z.source IS NOT DISTINCT FROM g.source),
mx AS (SELECT *, (CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END * size
              + greatest(0, least(size, (CASE WHEN source_size > 0 THEN goal % source_size ELSE goal END) - ahead)))::BIGINT AS taken FROM k)
""".replace("{docs}", docs)


OP9 = f"WITH {mixed('documents')} SELECT doc_id, size, source_size, target, taken FROM mx"

ORACLE = {"op2_chat_formatting": OP2, "op3_url_filters": OP3, "op8_quality_rules": OP8, "op9_mixing": OP9}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
