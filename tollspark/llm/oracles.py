"""SQL of the queries that SQL can express, written independently of the operators' methods.

Without SQL: op1, op2, op9 and op10 (trained models), op5 and op8 (XXH64 of strings isn't in DuckDB), op12 (eigenvectors)
and op13 (tokenizers); they are tested against brute force, planted cases and held-out rows in tests/llm.
"""

from __future__ import annotations

from tollspark.llm.common import LOWER, UPPER

_MIX = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
-- Sources reach 3 times their size in the order of size / weight: the first k are at their limit, for the smallest k
-- at which the next one is not above it.
ranked AS (
  SELECT *, row_number() OVER o - 1 AS k,
         coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fixed,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
         sum(source_size) OVER () AS total
  FROM sources WINDOW o AS (ORDER BY source_size::DOUBLE / weight, source IS NULL, encode(source))),
level AS (
  SELECT (total - fixed)::BIGINT AS rest, free FROM ranked
  WHERE weight * (total - fixed)::DOUBLE / free <= 3 * source_size ORDER BY k LIMIT 1),
aimed AS (
  SELECT source, source_size,
         CASE WHEN level.free IS NULL OR (weight * rest)::DOUBLE / free > 3 * source_size
              THEN (3 * source_size)::DOUBLE ELSE (weight * rest)::DOUBLE / free END AS target
  FROM sources LEFT JOIN level ON TRUE),
quota AS (SELECT *, floor(target + 0.5)::BIGINT AS words FROM aimed),
placed AS (
  SELECT doc_id, size, source_size, target, words,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY h, size, doc_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN quota q ON s.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0 ELSE words // source_size * size
             + greatest(0, least(size, words % source_size - before)) END)::BIGINT AS taken
FROM placed
"""

_DECONTAMINATE = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(text, '@U', '@L'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
piece AS (
  SELECT DISTINCT item_id, array_to_string(w[i + 1:i + least(len(w), 10)], ' ') AS piece, least(len(w), 10) AS k
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 9, 1))) AS i FROM item WHERE len(w) > 0)),
doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, '@U', '@L'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
place AS (
  SELECT doc_id, k, i, array_to_string(w[i + 1:i + k], ' ') AS piece
  FROM (SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS i
        FROM doc, (SELECT DISTINCT k FROM piece) WHERE len(w) >= k)),
hit AS (SELECT doc_id, i, k, item_id FROM place JOIN piece USING (k, piece)),
named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM hit GROUP BY doc_id),
marked AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS spot FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN named USING (doc_id) LEFT JOIN marked USING (doc_id)
""".replace("@U", UPPER).replace("@L", LOWER)

_CHAT = r"""
WITH said AS (
  SELECT DISTINCT conv_id, coalesce(floor(turn / 64)::BIGINT, -1) AS part, turn, coalesce(role, 'unknown') AS speaker,
         replace(coalesce(text, ''), '<|im_', '< |im_') AS body FROM conversations),
view AS (
  SELECT s.*, perspective, '<|im_start|>' || CASE WHEN speaker = 'system' THEN 'system'
           WHEN speaker = perspective THEN 'assistant' ELSE 'user name=' || speaker END || chr(10) AS head
  FROM said s JOIN (SELECT DISTINCT conv_id AS conv, speaker AS perspective FROM said WHERE speaker <> 'system') p
    ON s.conv_id IS NOT DISTINCT FROM p.conv),
placed AS (
  SELECT *, head || body || '<|im_end|>' || chr(10) AS piece,
         coalesce(sum(length(head || body) + 11) OVER (PARTITION BY conv_id, perspective, part
           ORDER BY turn, speaker, body ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begun
  FROM view)
SELECT conv_id, perspective, part, count(*)::BIGINT AS n_turns, string_agg(piece, '' ORDER BY turn, speaker, body) AS text,
       coalesce(string_agg((begun + length(head))::VARCHAR || '-' || (begun + length(head || body))::VARCHAR, ','
         ORDER BY turn, speaker, body) FILTER (WHERE speaker = perspective), '') AS loss_spans
FROM placed GROUP BY conv_id, perspective, part
"""

_LINES = r"""
WITH line AS (
  SELECT doc_id, pos, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w, doc_id::HUGEINT * 2147483648 + pos AS place
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents WHERE text IS NOT NULL)),
own AS (SELECT w, len(w) AS n, min(place) AS place FROM line WHERE len(w) > 0 GROUP BY w),
near AS (
  SELECT DISTINCT late.place FROM own late JOIN own early ON late.n = early.n
  WHERE late.n >= 8 AND early.place < late.place AND (late.w[1] = early.w[1] OR late.w[2] = early.w[2])
    AND len(list_filter(range(1, late.n + 1), lambda i: late.w[i] <> early.w[i])) <= 1
  UNION
  SELECT DISTINCT greatest(short.place, long.place) FROM own short JOIN own long ON long.n = short.n + 1
  WHERE short.n >= 8 AND (short.w[1] = long.w[1] OR short.w[-1] = long.w[-1])
    AND len(list_filter(range(0, long.n), lambda i: long.w[1:i] = short.w[1:i] AND long.w[i + 2:] = short.w[i + 1:])) > 0),
kept AS (SELECT place FROM own EXCEPT SELECT place FROM near),
judged AS (
  SELECT doc_id, pos, line, len(w) = 0 OR place IN (SELECT place FROM kept) AS stays FROM line),
built AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE stays) AS n_kept,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE stays), '') AS text FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_kept, 0)::BIGINT AS n_kept, built.text
FROM documents d LEFT JOIN built USING (doc_id)
"""

_URLS = r"""
WITH RECURSIVE rule(action, text) AS (VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'),
                                            ('allow', 'com/fr/'), ('block', 'com/de/')),
page AS (
  SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'UPPER', 'LOWER') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         (SELECT max((length(text), action, text)) FROM rule
          WHERE ('.' || host).ends_with('.' || split_part(text, '/', 1))
            AND starts_with(path, substr(text, instr(text, '/')))) AS fit
  FROM pages),
link AS (
  SELECT DISTINCT rowid, host AS source, translate(unnest(regexp_extract_all(regexp_replace(html,
           '(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)', ' ', 'g'),
           '(?is)<a\s[^<>]*?\bhref\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s<>]*)', 1)), 'UPPER', 'LOWER') AS target
  FROM (SELECT *, row_number() OVER () AS rowid FROM page)),
edge AS (SELECT source, target, count(*) AS weight FROM link
         WHERE source <> '' AND target <> '' AND source <> target GROUP BY ALL),
flow AS (
  SELECT 'trust' AS kind, source AS giver, target AS taker, weight / sum(weight) OVER (PARTITION BY source) AS share FROM edge
  UNION ALL
  SELECT 'distrust', target, source, weight / sum(weight) OVER (PARTITION BY target) FROM edge),
seed AS (
  SELECT 'trust' AS kind, host, floor(count(*) FILTER (WHERE fit[2] = 'allow') * 1000000 / count(*))::BIGINT AS mass
  FROM page WHERE host <> '' GROUP BY host
  UNION ALL
  SELECT 'distrust', host, floor(count(*) FILTER (WHERE fit[2] = 'block') * 1000000 / count(*))::BIGINT
  FROM page WHERE host <> '' GROUP BY host),
sent AS (
  SELECT 0 AS n, kind, host, floor(mass * (1e15 / sum(mass) OVER (PARTITION BY kind)))::BIGINT AS mass
  FROM (FROM seed WHERE mass > 0)
  UNION ALL
  SELECT n + 1, kind, taker, sum(part)::BIGINT
  FROM (SELECT n, flow.kind, taker, floor(mass * share * 0.85::DOUBLE) AS part
        FROM sent JOIN flow ON sent.kind = flow.kind AND host = giver WHERE n < 40)
  GROUP BY ALL HAVING sum(part) > 0),
reached AS (SELECT kind, host, sum(mass)::BIGINT AS mass FROM sent GROUP BY ALL),
part AS (SELECT host, kind, mass / (sum(mass) OVER (PARTITION BY kind))::DOUBLE AS share FROM reached),
score AS (
  SELECT host, trust / (trust + distrust) AS score
  FROM (SELECT host, coalesce(sum(share) FILTER (WHERE kind = 'trust'), 0) AS trust,
               coalesce(sum(share) FILTER (WHERE kind = 'distrust'), 0) AS distrust FROM part GROUP BY host))
SELECT page_id, host, path, fit[3] AS rule,
       coalesce(fit[2], CASE WHEN score >= 0.5 THEN 'allow' WHEN score IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       score
FROM page LEFT JOIN score USING (host)
""".replace("UPPER", UPPER).replace("LOWER", LOWER)


def llm_oracles() -> dict[str, str]:
    return {"op3_mix": _MIX, "op4_decontaminate": _DECONTAMINATE, "op6_chat": _CHAT, "op7_line_dedup": _LINES,
            "op11_url_graph": _URLS}
