"""DuckDB SQL for the queries of this subpackage that SQL can express, written apart from the Spark code."""

from __future__ import annotations

from .quality_rules import COMMON

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_ESCAPE = r"regexp_replace({0}, '([<\[])(\\*/?(s>|(INST|SYS|ROLE)\]))', '\1\\\2', 'g')"

OP5 = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (SELECT *, CASE role WHEN 'user' THEN '[INST] ' WHEN 'system' THEN '[SYS] ' WHEN 'assistant' THEN '<s> ' ELSE '[ROLE] ' || {_ESCAPE.format('role')} || ' [/ROLE][INST] ' END
      || {_ESCAPE.format('text')} || CASE role WHEN 'system' THEN ' [/SYS]' WHEN 'assistant' THEN ' </s>' ELSE ' [/INST]' END AS formatted FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""

OP8 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM bw),
lens AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN lens ON len(w) >= n),
m AS (SELECT dk.doc_id, dk.i, win.n, win.item_id FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k FROM dw) dk JOIN win ON win.n = dk.n AND win.k = dk.k),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id
"""

_S = r"\x20\x09-\x0D"
_KINDS = ("a-z", "A-Z", "0-9", _S, ".,;:''\"()?-", "!", "#*$%&|<>", r"\x{80}-\x{10FFFF}")
_COUNTS = ", ".join(f"length(t) - length(regexp_replace(t, '[{k}]+', '', 'g'))" for k in _KINDS)
_RANKS = {"en": 1, "fr": 2, "de": 3, "es": 4}
_COMMON = ", ".join(f"('{k}', {_RANKS[k]}, {i}, '{w}')" for k, v in COMMON.items() for i, w in enumerate(v))


def _distance(hist: str, reference: str, n: int) -> str:
    """Jensen-Shannon distance of histograms (doc_id, i, c) to references (language, i, c)."""
    return f"""SELECT doc_id, CASE WHEN min(ta) > 0 AND min(tb) > 0 THEN sqrt(greatest(sum((CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2), 0)) END AS x
    FROM (SELECT h.doc_id, h.t AS ta, r.t AS tb, CAST(h.c AS DOUBLE) / nullif(h.t, 0) AS p, CAST(r.c AS DOUBLE) / nullif(r.t, 0) AS q
          FROM (SELECT doc_id, i, c, ref, sum(c) OVER (PARTITION BY doc_id) AS t FROM {hist}) h JOIN (SELECT language, i, c, sum(c) OVER (PARTITION BY language) AS t FROM {reference}) r ON r.language = h.ref AND r.i = h.i) GROUP BY doc_id"""


OP2 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^{_S}]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{_S}]')) AS ls, [{_COUNTS}] AS cs FROM d),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
rep AS (SELECT doc_id, k FROM win GROUP BY doc_id, k HAVING count(*) > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT win.doc_id, unnest(range(win.i, win.i + 5)) AS p FROM win JOIN rep ON rep.doc_id = win.doc_id AND rep.k = win.k) GROUP BY doc_id),
base AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(t) - cs[4] AS BIGINT) AS word_chars, CAST(cs[7] AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
         len(ws) < 10 OR 100 * coalesce(cov.n, 0) > 20 * len(ws) AS base_failed, length(t) AS len_t, cs FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id),
common AS (SELECT * FROM (VALUES {_COMMON}) v(language, rank, i, word)),
tok AS (SELECT doc_id, unnest(ws) AS x FROM w),
cw AS (SELECT doc_id, lower(x) AS word, count(*) AS c FROM tok WHERE lower(x) IN (SELECT word FROM common) AND (x = lower(x) OR x = upper(x) OR x = upper(x[1:1]) || lower(x[2:])) GROUP BY doc_id, lower(x)),
lc AS (SELECT doc_id, language, rank, sum(c) AS n FROM cw JOIN common ON common.word = cw.word GROUP BY doc_id, language, rank),
lang AS (SELECT doc_id, language FROM (SELECT doc_id, language, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, rank) AS rn FROM lc) WHERE rn = 1),
b AS (SELECT base.*, lang.language, coalesce(lang.language, 'any') AS ref FROM base LEFT JOIN lang ON lang.doc_id = base.doc_id),
ch AS (SELECT doc_id, ref, i, CASE WHEN i <= 8 THEN cs[i] ELSE len_t - list_sum(cs) END AS c FROM (SELECT doc_id, ref, cs, len_t, unnest(range(1, 10)) AS i FROM b)),
wh AS (SELECT b.doc_id, b.ref, common.i, coalesce(cw.c, 0) AS c FROM b JOIN common ON common.language = b.language LEFT JOIN cw ON cw.doc_id = b.doc_id AND cw.word = common.word),
fit AS (SELECT doc_id, language FROM b WHERE NOT base_failed AND language IS NOT NULL AND word_chars >= 200 AND 100 * n_symbols <= word_chars),
cf AS (SELECT language, i, c * 1000000 // greatest(sum(c) OVER (PARTITION BY ch.doc_id), 1) AS s FROM ch JOIN fit ON fit.doc_id = ch.doc_id),
wf AS (SELECT language, i, c * 1000000 // greatest(sum(c) OVER (PARTITION BY wh.doc_id), 1) AS s FROM wh JOIN fit ON fit.doc_id = wh.doc_id),
cr AS (SELECT language, i, sum(s) AS c FROM cf GROUP BY language, i UNION ALL SELECT 'any', i, sum(s) FROM cf GROUP BY i),
wr AS (SELECT language, i, sum(s) AS c FROM wf GROUP BY language, i),
cd AS ({_distance('ch', 'cr', 9)}),
wd AS ({_distance('wh', 'wr', 20)}),
wt AS (SELECT doc_id, sum(c) AS n FROM wh GROUP BY doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, b.language, round(cd.x, 6) AS char_distance, round(wd.x, 6) AS word_distance,
       NOT base_failed AND (word_chars < 200 OR coalesce(cd.x <= 0.18, true)) AND (coalesce(wt.n, 0) < 25 OR coalesce(wd.x <= 0.7, true)) AS kept
FROM b LEFT JOIN cd ON cd.doc_id = b.doc_id LEFT JOIN wd ON wd.doc_id = b.doc_id LEFT JOIN wt ON wt.doc_id = b.doc_id
"""

ORACLES = {"op2_quality_rules": OP2, "op5_chat_format": OP5, "op8_decontaminate": OP8}
