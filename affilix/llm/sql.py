"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from affilix.llm.secret_scan import RULES

_ESCAPED = "2 * length({0}) - length(translate({0}, '\\<>', ''))"

CHAT_FORMAT = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(15 + {_ESCAPED.format("role")} + {_ESCAPED.format("text")}) AS BIGINT) AS formatted_chars,
  regexp_full_match(string_agg(role || ',', '' ORDER BY turn, role, text), '(system,)?(user,assistant,)*(user,)?') AS valid
FROM t GROUP BY conv_id
"""


def _found(number: int) -> str:
    rule = RULES[number]
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    return (
        f"SELECT doc_id, '{rule.kind}' AS kind, {number} AS n, {rule.least} AS least, string_split_regex(t, {pattern}) AS g, "
        f"regexp_extract_all(t, {pattern}, 0) AS m, regexp_extract_all(t, {pattern}, {rule.group}) AS v FROM d"
    )


SECRET_SCAN = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(_found(n) for n in range(len(RULES)))}),
i AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM f WHERE len(m) > 0),
s AS (
  SELECT doc_id, kind, n, length(array_to_string(g[1:i], '')) + length(array_to_string(m[1:i - 1], '')) AS a, length(m[i]) AS l
  FROM i WHERE length(v[i]) >= least
),
w AS (
  SELECT doc_id, count(*) FILTER (WHERE n = 0) AS n_assign, count(*) FILTER (WHERE n = 1) AS n_access,
    count(*) FILTER (WHERE n = 2) AS n_hex, string_agg(kind || ':' || a || ':' || (a + l), ',' ORDER BY a, n) AS spans
  FROM s GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN w ON d.doc_id = w.doc_id
"""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(13, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
bk AS (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM b),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS t FROM bk),
dk AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM b) AS sizes),
hit AS (
  SELECT dk.doc_id, dk.k, dk.n, bw.item_id
  FROM dk JOIN bw ON bw.n = dk.n AND bw.t = array_to_string(dk.w[dk.k:dk.k + dk.n - 1], ' ')
),
p AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS place FROM hit) GROUP BY doc_id),
q AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p ON p.doc_id = d.doc_id LEFT JOIN q ON q.doc_id = d.doc_id
"""

_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, ls, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d),
k AS (
  SELECT doc_id, pos, translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
),
c AS (SELECT doc_id, pos, key FROM k WHERE length(key) >= 20),
s AS (SELECT key, count(DISTINCT doc_id) AS n, max(doc_id) AS top FROM c GROUP BY key),
x AS (SELECT c.doc_id, c.pos FROM c JOIN s USING (key) WHERE s.n >= 3 AND c.doc_id IS DISTINCT FROM s.top),
o AS (
  SELECT l.doc_id, count(*) AS n_lines, count(x.pos) AS n_dropped,
    coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE x.pos IS NULL), '') AS kept
  FROM l LEFT JOIN x ON x.doc_id = l.doc_id AND x.pos = l.pos GROUP BY l.doc_id
)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, sha256(kept) AS kept_sha256 FROM o
"""

ORACLES = {"op3_chat_format": CHAT_FORMAT, "op4_secret_scan": SECRET_SCAN, "op8_decontaminate": DECONTAMINATE,
    "op12_line_dedup": LINE_DEDUP,
}
