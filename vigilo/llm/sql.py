"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

OP2 = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (
  SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
"""

OP3 = r"""
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

OP10 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, role = 'assistant' AS reply,
    length(regexp_replace(role, '(\\|<s>|</s>|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\])', '\1#', 'g'))
    + length(regexp_replace(text, '(\\|<s>|</s>|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\])', '\1#', 'g'))
    + CASE WHEN role = 'assistant' THEN 14 ELSE 20 END AS n
  FROM c
), w AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS prefix,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS last
  FROM e
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE reply), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE reply), '')) AS loss_sha256,
  CAST(coalesce(sum(prefix) FILTER (WHERE reply OR last), 0) AS BIGINT) AS formatted_chars
FROM w GROUP BY conv_id
"""


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(column: str) -> str:
    return f"unnest(regexp_extract_all(translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}'))"


OP12 = f"""
WITH words AS (SELECT doc_id, {_terms('text')} AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY 1, 2),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY 1),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
asked AS (SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, {_terms('text')} AS term FROM benchmark) GROUP BY 1, 2),
weighted AS (
  SELECT item_id, term, repeats * CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM asked JOIN df USING (term) CROSS JOIN totals
),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM weighted JOIN tf USING (term) JOIN lengths USING (doc_id) CROSS JOIN totals GROUP BY 1, 2
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def statements() -> dict[str, str]:
    return {"op2_exact_dedup": OP2, "op3_tiled_topk": OP3, "op10_prefix_targets": OP10, "op12_ball_tree_search": OP12}
