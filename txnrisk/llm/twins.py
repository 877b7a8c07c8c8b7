"""SQL twins of the training-data queries that SQL can express: brute force over the given tables."""

from __future__ import annotations

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def _escaped_length(text: str) -> str:
    """Characters, one more for each backslash and for each control string."""
    marks = " + ".join(f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in _CONTROL)
    return f"(length({text}) + length({text}) - length(replace({text}, '\\', '')) + {marks})"


DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format('text')} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) t(i) WHERE len(w) > 0),
places AS (
  SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM d, (SELECT DISTINCT k FROM windows), unnest(range(1, len(w) - k + 2)) t(i)),
hits AS (SELECT r, i, k, item_id FROM places JOIN windows USING (k, g)),
hit_words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
hit_items AS (
  SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words h USING (r) LEFT JOIN hit_items i USING (r)"""

CHAT = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -7, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
found AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum(23 + {_escaped_length('role')} + {_escaped_length('text')}) AS BIGINT) AS formatted_chars
  FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM found"""

#: Exact links; the operator's hashing finds all of them but a pair close to the threshold now and then.
EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    AND list_cosine_similarity(a.e, b.e) >= 0.9),
reached AS (
  SELECT vec_id AS node, vec_id AS other FROM embeddings UNION SELECT node, b FROM reached JOIN links ON a = other),
least_id AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least_id ON node = vec_id LEFT JOIN degree ON a = vec_id"""

NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.q) = len(b.q)),
positive AS (
  SELECT ar, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) AS k
  FROM scored WHERE same QUALIFY k <= 5),
negative AS (
  SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY ar, k ORDER BY score DESC, vec_id) AS n, vec_id AS negative_id,
    positive_score, score AS negative_score
  FROM positive JOIN scored USING (ar) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negative WHERE n <= 5"""

TWINS = {"op5_embedding_dedup": EMBEDDINGS, "op7_chat_format": CHAT, "op9_decontamination": DECONTAMINATION, "op11_hard_negatives": NEGATIVES}
