"""DuckDB SQL for the text operators that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
_SPACE_WORDS = r"'[^\x20\x09-\x0D]+'"
_ALNUM_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q))
SELECT query_id, CAST(rk AS INTEGER) AS "rank", vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rk FROM pairs) WHERE rk <= 5"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACE_WORDS}) AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
        FROM d, unnest(range(1, greatest(len(w) - 48, 1))) AS t(i)),
low AS (SELECT h, min(doc_id) AS lo FROM win GROUP BY h),
gone AS (SELECT DISTINCT win.doc_id, i + k AS at FROM win JOIN low USING (h), unnest(range(0, 50)) AS t(k) WHERE lo < win.doc_id),
kept AS (SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.at) AS text, count(*) AS n FROM (
           SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS at FROM d) p
         LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.at = g.at WHERE g.at IS NULL GROUP BY p.doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM_WORDS}) AS w FROM documents),
b AS (SELECT item_id, w, least(10, len(w)) AS m FROM (
        SELECT item_id, regexp_extract_all({_LOWER}, {_ALNUM_WORDS}) AS w FROM benchmark) WHERE len(w) > 0),
pat AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS p FROM b, unnest(range(1, len(w) - m + 2)) AS t(i)),
lens AS (SELECT DISTINCT m FROM pat),
win AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS p
        FROM d CROSS JOIN lens, unnest(range(1, greatest(len(w) - m + 2, 1))) AS t(i)),
hit AS (SELECT win.doc_id, win.i, win.m, pat.item_id FROM win JOIN pat ON win.m = pat.m AND win.p = pat.p),
words AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, unnest(range(0, m)) AS t(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (
            SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""

NEARDUP = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_SPACE_WORDS}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS g
      FROM d, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT p.a, p.b FROM (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2) p
          JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.component_id, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(c.component_id, d.doc_id) AS kept
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN c ON d.doc_id = c.doc_id"""


def _field(column: str) -> str:
    return (f"CASE WHEN {column} IS NULL THEN '-' ELSE CAST(octet_length(encode(CAST({column} AS VARCHAR))) AS VARCHAR) || ':' "
            f"|| CAST({column} AS VARCHAR) END")


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


# crc32 bit by bit: decimal ids are ASCII, so a character is a byte
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END), 4294967295::BIGINT)"""

MANIFEST = f"""
WITH RECURSIVE d AS (
  SELECT *, {_leaf('n_chars')} AS leaf,
         CASE WHEN {_CRC} % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS claim FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS size FROM d),
g AS (SELECT lang, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree, count(*) OVER () AS trees
      FROM (SELECT DISTINCT lang FROM documents)),
up AS (
  SELECT g.tree, 0 AS lvl, p.idx, p.size, p.leaf AS digest FROM p JOIN g ON p.lang IS NOT DISTINCT FROM g.lang
  UNION ALL
  SELECT tree, lvl + 1, idx // 2, (size + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM up WHERE size > 1
  GROUP BY tree, lvl, idx // 2, size),
sub AS (SELECT tree, digest AS subroot FROM up WHERE size = 1),
above AS (
  SELECT 0 AS lvl, tree AS idx, (SELECT max(trees) FROM g) AS size, subroot AS digest FROM sub
  UNION ALL
  SELECT lvl + 1, idx // 2, (size + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM above WHERE size > 1
  GROUP BY lvl, idx // 2, size),
nodes AS (SELECT tree, lvl, idx, size, digest FROM up UNION ALL SELECT -1, lvl, idx, size, digest FROM above),
fold AS (
  SELECT p.doc_id, p.leaf, g.tree AS own, g.tree AS tree, 0 AS lvl, p.idx, p.size, p.claim AS digest, '' AS proof
  FROM p JOIN g ON p.lang IS NOT DISTINCT FROM g.lang
  UNION ALL
  SELECT f.doc_id, f.leaf, f.own, CASE WHEN f.size = 1 THEN -1 ELSE f.tree END, CASE WHEN f.size = 1 THEN 0 ELSE f.lvl + 1 END,
         CASE WHEN f.size = 1 THEN f.own ELSE f.idx // 2 END,
         CASE WHEN f.size = 1 THEN (SELECT max(trees) FROM g) ELSE (f.size + 1) // 2 END,
         CASE WHEN f.size = 1 THEN f.digest WHEN n.digest IS NULL THEN sha256(f.digest)
              WHEN f.idx % 2 = 0 THEN sha256(f.digest || n.digest) ELSE sha256(n.digest || f.digest) END,
         f.proof || CASE WHEN f.size = 1 THEN '' ELSE coalesce(n.digest, '') END
  FROM fold f LEFT JOIN nodes n ON f.tree = n.tree AND f.lvl = n.lvl AND n.idx = xor(f.idx, 1)
  WHERE NOT (f.tree = -1 AND f.size = 1))
SELECT f.doc_id, f.leaf, sub.subroot, r.digest AS root, sha256(f.proof) AS proof_sha256, f.digest AS folded_root,
       f.digest = r.digest AS verified
FROM fold f JOIN sub ON f.own = sub.tree JOIN (SELECT digest FROM above WHERE size = 1) r ON true
WHERE f.tree = -1 AND f.size = 1"""

PHRASES = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM_WORDS}) AS w FROM documents),
ph AS (SELECT string_split(phrase, ' ') AS phrase, label FROM (VALUES ('gnu general public license', 'gpl'), ('apache license', 'apache'),
                            ('cc by', 'cc-by'), ('mit license', 'mit')) AS v(phrase, label)),
hit AS (SELECT doc_id, i - 1 AS place, label FROM d, ph, unnest(range(1, len(w) + 1)) AS t(i) WHERE w[i:i + len(phrase) - 1] = phrase),
found AS (SELECT doc_id, count(*) AS n, min(place) AS lo, max(place) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
          FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word,
       coalesce(labels, '') AS base_labels
FROM d LEFT JOIN found ON d.doc_id = found.doc_id"""

ORACLES = {"op2_topk_search": TOPK.strip(), "op6_substring_dedup": SUBSTRINGS.strip(),
           "op8_decontamination": DECONTAMINATION.strip(), "op9_minhash_neardup": NEARDUP.strip(),
           "op11_merkle_manifest": MANIFEST.strip(),
           "license_phrases": PHRASES.strip()}
