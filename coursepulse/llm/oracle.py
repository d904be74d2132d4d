"""The registered queries of this subpackage as SQL, where SQL can express them.

Not here: fingerprints by xxHash64, merges of byte pairs, learnt scores, suffix sorting,
sketches and differencing; tests hold those against brute force.
"""

from __future__ import annotations

TOOL_CALLS = """
WITH calls AS (
    SELECT conv_id, turn, text, length(text) AS n,
        CASE length(text) % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'translate' ELSE 'summarize' END AS name,
        turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island
    FROM conversations WHERE role = 'user'
),
levels AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) - 1 AS depth
    FROM calls
),
results AS (
    SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'
),
events AS (
    SELECT c.conv_id, 'call' AS kind, 't' || c.turn AS call_id, c.turn, c.depth * 2 AS level,
        array_to_string(list_filter([
            CASE WHEN c.turn >= 2 AND c.depth = 0 THEN 'parent' END,
            CASE WHEN r.turn IS NULL THEN 'no result' END,
            CASE WHEN c.turn % 4 = 2 THEN 'missing:q' END,
            CASE WHEN name = 'translate' THEN 'type:n' END,
            CASE WHEN name = 'summarize' THEN 'unknown:n' END,
            CASE WHEN name = 'summarize' THEN 'unknown:turn' END
        ], lambda x: x IS NOT NULL), ',') AS problems,
        '{"arguments":{"n":' || n
            || CASE WHEN c.turn % 4 = 2 THEN '' ELSE ',"q":' || CAST(to_json(c.text) AS VARCHAR) END
            || ',"turn":' || c.turn || '},"call_id":"t' || c.turn || '","name":"' || name
            || '","type":"call"}' AS message
    FROM levels c LEFT JOIN results r ON r.conv_id = c.conv_id AND r.turn = c.turn + 1
    UNION ALL
    SELECT r.conv_id, 'result', 't' || (r.turn - 1), r.turn, c.depth * 2 + 1,
        CASE WHEN c.turn IS NULL THEN 'no call' ELSE '' END,
        '{"call_id":"t' || (r.turn - 1) || '","content":' || CAST(to_json(r.text) AS VARCHAR)
            || ',"type":"result"}'
    FROM results r LEFT JOIN levels c ON r.conv_id = c.conv_id AND r.turn = c.turn + 1
)
SELECT conv_id,
    row_number() OVER (
        PARTITION BY conv_id ORDER BY level NULLS LAST, turn, kind, call_id, message
    ) - 1 AS position,
    kind, call_id, CAST(level AS BIGINT) AS level, problems, message
FROM events
"""

# Kind, pattern, group that is measured, least length; as the scan has them, but for look-behind.
_KINDS = (
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]{16,}", 0, 16),
    ("key", "[A-Za-z0-9+/]{32,}", 0, 32),
    ("endpoint", r"""https?://[^\s"''<>]+""", 0, 0),
)
SCOPE = 400


def _matches(order: int, name: str, pattern: str, group: int, least: int) -> str:
    return f"""
    SELECT doc_id, {order} AS kind, '{name}' AS name,
        CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s,
        length(found[i]) AS size
    FROM (
        SELECT doc_id, found, held, gaps, unnest(range(1, len(found) + 1)) AS i
        FROM (
            SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS found,
                regexp_extract_all(text, '{pattern}', {group}) AS held,
                string_split_regex(text, '{pattern}') AS gaps
            FROM texts
        )
    )
    WHERE length(held[i]) >= {least}"""


SECRETS = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
matches AS ({" UNION ALL ".join(_matches(i, *k) for i, k in enumerate(_KINDS))}),
found AS (SELECT *, s + size AS e FROM matches),
base AS (SELECT * FROM found WHERE kind < 3),
weak AS (
    SELECT * FROM found w WHERE kind = 4 OR (kind = 3 AND NOT EXISTS (
        SELECT 1 FROM base b WHERE b.doc_id = w.doc_id AND b.s < w.e AND w.s < b.e))
),
parts AS (SELECT * FROM base UNION ALL SELECT * FROM weak),
spans AS (
    SELECT * FROM base
    UNION ALL
    SELECT * FROM weak w
    WHERE EXISTS (SELECT 1 FROM parts p
            WHERE p.doc_id = w.doc_id AND p.kind = 1 AND abs(p.s - w.s) <= {SCOPE})
        AND (kind = 3 OR EXISTS (SELECT 1 FROM parts p
            WHERE p.doc_id = w.doc_id AND p.kind IN (0, 2, 3) AND abs(p.s - w.s) <= {SCOPE}))
),
joined AS (
    SELECT doc_id,
        count(*) FILTER (kind = 0) AS n_assign,
        count(*) FILTER (kind = 1) AS n_access,
        count(*) FILTER (kind = 2) AS n_hex,
        string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (kind < 3) AS base,
        string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans
    FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
    coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans
FROM documents d LEFT JOIN joined j USING (doc_id)
"""


def all_sql() -> dict[str, str]:
    return {"op1_tool_calls": TOOL_CALLS, "op3_secrets": SECRETS}
