"""SQL for DuckDB with the same results as the queries that SQL can express on whole tables."""

from __future__ import annotations

import string

from perigee.llm.licenses import BETWEEN, CONTAINED, PHRASES, STEP, TEMPLATES, needed, template_words
from perigee.llm.merkle import ARITY, LEAF_COLUMNS
from perigee.llm.substrings import WORDS
from perigee.llm.vectors import LEAST_COSINE

SUBSTRINGS = f"""
WITH words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
  FROM (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
        FROM documents)
),
grams AS (
  SELECT doc_id, pos, word,
         string_agg(word, ' ') OVER ahead AS gram, count(*) OVER ahead AS n
  FROM words
  WINDOW ahead AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {WORDS - 1} FOLLOWING)
),
firsts AS (SELECT gram, min(doc_id) AS first_id FROM grams WHERE n = {WORDS} GROUP BY gram),
falling AS (
  SELECT g.doc_id, pos, word, coalesce(first_id < g.doc_id, false) AS falls
  FROM grams g LEFT JOIN firsts f ON g.n = {WORDS} AND g.gram = f.gram
),
judged AS (
  SELECT doc_id, pos, word,
         bool_or(falls) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {WORDS - 1} PRECEDING AND CURRENT ROW) AS removed
  FROM falling
),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (removed) AS n_removed,
         string_agg(word, ' ' ORDER BY pos) FILTER (NOT removed) AS words
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

VECTORS = f"""
WITH RECURSIVE sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= {LEAST_COSINE}
),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
smallest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN smallest s ON e.vec_id = s.a LEFT JOIN counts c ON e.vec_id = c.a
"""

LOWER_TEXT = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _leaf(text: str) -> str:
    texts = [text if c == "text" else f"CAST({c} AS VARCHAR)" for c in LEAF_COLUMNS]
    return f"""sha256({" || ".join(f"CASE WHEN {t} IS NULL THEN '-' ELSE concat(strlen({t}), ':', {t}) END" for t in texts)})"""


def _climb(name: str, start: str, part: str) -> str:
    """A recursive table of the nodes of trees, and one of the siblings of each node."""
    run = f"PARTITION BY {part}, level, pos // {ARITY} ORDER BY pos"
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT {part}, level + 1, pos // {ARITY}, (any_value(n) + {ARITY - 1}) // {ARITY}, sha256(string_agg(digest, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY {part}, level, pos // {ARITY}
),
{name}_beside AS (
  SELECT {part}, level, pos,
         coalesce(string_agg(digest, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name} WHERE n > 1
)"""


_CHANGED = f"CASE WHEN crc % 3 = 0 THEN {_leaf(LOWER_TEXT)} ELSE {_leaf('text')} END"
MERKLE = f"""
WITH RECURSIVE crc_steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384), i)) AS step
),
sums AS (
  SELECT doc_id, source, lang, n_chars, text, xor(4294967295, list_reduce(
           list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
           lambda crc, b: xor(crc >> 8, step[(xor(crc, b) & 255) + 1]), 4294967295)) AS crc
  FROM documents, crc_steps
),
leaves AS (
  SELECT doc_id, lang, {_leaf("text")} AS leaf, {_CHANGED} AS changed,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM sums
),
{_climb("tree", "SELECT lang, 0 AS level, pos, n, leaf AS digest FROM leaves", "lang")},
subroots AS (
  SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS top_pos, count(*) OVER () AS n, digest AS subroot
  FROM tree WHERE n = 1
),
{_climb("top", "SELECT 0 AS one, 0 AS level, top_pos AS pos, n, subroot AS digest FROM subroots", "one")},
steps AS (
  SELECT doc_id, b.level AS step, l, r FROM leaves v
  JOIN tree_beside b ON v.lang IS NOT DISTINCT FROM b.lang AND b.pos = v.pos >> (3 * b.level)
  UNION ALL
  SELECT doc_id, 1000 + b.level, l, r FROM leaves v JOIN subroots s ON v.lang IS NOT DISTINCT FROM s.lang
  JOIN top_beside b ON b.pos = s.top_pos >> (3 * b.level)
),
proofs AS (
  SELECT doc_id, string_agg(l || r, '' ORDER BY step) AS siblings, list(l || '|' || r ORDER BY step) AS path FROM steps GROUP BY doc_id
),
checked AS (
  SELECT v.doc_id, leaf, subroot, (SELECT digest FROM top WHERE n = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
         list_reduce(coalesce(path, []), lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2)), changed) AS folded_root
  FROM leaves v JOIN subroots s ON v.lang IS NOT DISTINCT FROM s.lang LEFT JOIN proofs p ON v.doc_id = p.doc_id
)
SELECT *, folded_root = root AS verified FROM checked
"""

NEGATIVES = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM sound a JOIN sound b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
ranked AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE same
),
found AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM ranked p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
  WHERE place <= 5 AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 10
"""


def _starts(phrase: str) -> str:
    return " AND ".join(f"coalesce(ws[i + {k}] = '{w}', false)" for k, w in enumerate(phrase.split()))


_PLACES = ", ".join(f"list_filter(range(1, len(ws) + 1), lambda i: {_starts(p)}) AS p{k}" for k, p in enumerate(PHRASES))
_ALL_PLACES = "list_concat(" + ", ".join(f"p{k}" for k in range(len(PHRASES))) + ")"
_BASE_LABELS = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, label in enumerate(PHRASES.values()))
_TEMPLATES = ", ".join(
    f"({k}, '{label}', {words!r}, {needed(len(words), CONTAINED)})" for k, label, words in template_words(TEMPLATES)
)
LICENSES = f"""
WITH templates(template, label, words, need) AS (VALUES {_TEMPLATES}),
texts AS (
  SELECT doc_id, list_filter(string_split_regex({LOWER_TEXT.replace("(text,", "(coalesce(text, ''),")}, '{BETWEEN}'), lambda w: w <> '') AS ws
  FROM documents
),
places AS (SELECT doc_id, ws, {_PLACES} FROM texts),
base AS (
  SELECT doc_id, len(ws) AS n_words, {_ALL_PLACES} AS starts, list_filter([{_BASE_LABELS}], lambda x: x IS NOT NULL) AS named FROM places
),
blocks AS (
  SELECT doc_id, list_distinct(ws[{STEP} * b + 1:{STEP} * b + {2 * STEP}]) AS held
  FROM texts, unnest(range(0, (len(ws) + {STEP - 1}) // {STEP})) AS u(b)
),
pairs AS (SELECT doc_id, label, len(list_intersect(held, words)) AS shared, len(words) AS size, need FROM blocks, templates),
found AS (SELECT doc_id, list(DISTINCT label) AS labels, max(shared / size) AS share FROM pairs WHERE shared >= need GROUP BY doc_id)
SELECT b.doc_id, n_words, len(starts) AS n_base, list_min(starts) - 1 AS first_word, list_max(starts) - 1 AS last_word,
       array_to_string(list_sort(list_distinct(named)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(named, coalesce(labels, [])))), ',') AS labels,
       CASE WHEN len(starts) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM base b LEFT JOIN found f ON b.doc_id = f.doc_id
"""

ORACLES = {
    "op1_substring_dedup": SUBSTRINGS,
    "op3_embedding_near_dedup": VECTORS,
    "op11_merkle_manifest": MERKLE,
    "op12_hard_negatives": NEGATIVES,
    "op13_license_scan": LICENSES,
}
