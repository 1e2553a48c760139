"""SQL for the checking database, for the queries of this package that SQL can express.

The texts follow the contracts step by step, not the way the Spark jobs compute them.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Fixed values, written out here so that they check those of the code: the control strings of
# the chat template, and the lengths of its marks.
_CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[REPLY]", "[ROLE]", "[/ROLE]", "[/END]")


def _escaped_length(text: str) -> str:
    """Each backslash and each control string costs one more character."""
    found = [f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in _CONTROLS]
    slashes = rf"(length({text}) - length(replace({text}, '\', '')))"
    return " + ".join([f"length({text})", slashes, *found])


_CHAT = f"""
WITH every AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
placed AS (
  SELECT *, row_number() OVER k AS n, lag(role) OVER k AS before, lead(role) OVER k AS after
  FROM every WINDOW k AS (PARTITION BY conv_id ORDER BY turn, role, text)),
told AS (
  SELECT conv_id, n, role, text,
    CASE role WHEN 'system' THEN before IS NULL
              WHEN 'user' THEN before IS NULL OR before IN ('system', 'assistant')
              WHEN 'assistant' THEN coalesce(before = 'user', false) ELSE false END
      AND (after IS NOT NULL OR role = 'assistant') AS allowed,
    CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 18 WHEN 'assistant' THEN 14
              ELSE 19 + {_escaped_length("role")} END + {_escaped_length("text")} AS chars
  FROM placed)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars, min(allowed) AS valid
FROM told GROUP BY conv_id"""

# Sets of five-word runs, all pairs that share one, and the closure of the links.
_NGRAM_JOIN = f"""
WITH RECURSIVE
texts AS (SELECT text, min(doc_id) AS rep, count(*) AS n_copies, {_WORDS} AS w FROM documents
          WHERE text IS NOT NULL GROUP BY text),
nodes AS (SELECT row_number() OVER (ORDER BY rep) AS node, text, rep, n_copies, w FROM texts WHERE len(w) > 0),
runs AS (SELECT node, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM nodes),
grams AS (SELECT DISTINCT r.node, array_to_string(n.w[r.i:r.i + 4], ' ') AS g
          FROM runs r JOIN nodes n ON n.node = r.node),
sizes AS (SELECT node, count(*) AS n FROM grams GROUP BY node),
pairs AS (SELECT a.node AS a, b.node AS b, count(*) AS n_both FROM grams a JOIN grams b ON a.g = b.g AND a.node <> b.node
          GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.node = a JOIN sizes y ON y.node = b
          WHERE 5 * n_both >= 4 * (x.n + y.n - n_both)),
reach AS (SELECT node, node AS other FROM nodes UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
classes AS (SELECT r.node, min(n.rep) AS class_id FROM reach r JOIN nodes n ON n.node = r.other GROUP BY 1),
found AS (SELECT n.text, c.class_id, n.n_copies, (SELECT count(*) FROM links l WHERE l.a = n.node) AS n_links
          FROM nodes n JOIN classes c ON c.node = n.node)
SELECT d.doc_id, coalesce(f.class_id, d.doc_id) AS class_id, coalesce(f.n_links, 0) AS n_links,
       coalesce(f.n_copies, 1) AS n_copies
FROM documents d LEFT JOIN found f ON f.text = d.text"""

_HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 3"""

_SUBSTRING_DEDUP = f"""
WITH split AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM split),
windows AS (
  SELECT r, p, string_agg(word, ' ') OVER ahead AS s, count(*) OVER ahead AS n FROM words
  WINDOW ahead AS (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
repeated AS (SELECT r, p FROM windows WHERE n = 35 QUALIFY count(*) OVER (PARTITION BY s) > 1),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS p FROM repeated),
kept AS (SELECT words.r, string_agg(word, ' ' ORDER BY words.p) AS s FROM words
         LEFT JOIN gone ON gone.r = words.r AND gone.p = words.p WHERE gone.r IS NULL GROUP BY 1),
lost AS (SELECT r, count(*) AS n FROM gone GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(lost.n, 0) AS n_removed,
       sha256(coalesce(kept.s, '')) AS kept_sha256
FROM split LEFT JOIN kept ON kept.r = split.r LEFT JOIN lost ON lost.r = split.r"""

ORACLES: dict[str, str] = {
    "op6_chat": _CHAT,
    "op8_ngram_join": _NGRAM_JOIN,
    "op12_hard_negatives": _HARD_NEGATIVES,
    "op13_substring_dedup": _SUBSTRING_DEDUP,
}
