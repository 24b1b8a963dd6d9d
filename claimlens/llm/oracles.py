"""DuckDB SQL of those queries of this subpackage that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    byte = "list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda p, q: xor(p >> 1, (p & 1) * 3988292384), xor(c, b))"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce({codes}, lambda c, b: {byte}, CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"


OP11 = f"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, {WORDS.format("coalesce(text, '')")} AS w,
         {crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
sized AS (SELECT *, CAST(len(w) AS BIGINT) AS n, h // 10 AS g FROM base),
cut AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM sized),
period AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM cut),
planted AS (
  SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w END AS w FROM period),
words AS (SELECT rid, n, unnest(w) AS word, unnest(range(n)) AS i FROM planted),
equal AS (
  SELECT x.rid, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.rid = y.rid AND x.word = y.word
  AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM equal),
found AS (SELECT rid, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY rid, q, island),
runs AS (SELECT rid, start, length, min(q) AS period FROM found WHERE length >= greatest(6, 4 * q) GROUP BY rid, start, length),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (
  PARTITION BY rid ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1),
listed AS (SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
           FROM runs GROUP BY rid),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY i) AS words FROM words WHERE NOT EXISTS (
  SELECT 1 FROM runs r WHERE r.rid = words.rid AND words.i BETWEEN r.start + r.period AND r.start + r.length - 1) GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM planted LEFT JOIN best USING (rid) LEFT JOIN listed USING (rid) LEFT JOIN kept USING (rid)
"""

OP12 = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, {WORDS.format(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM base),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
             for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


OP13 = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, {_leaf("text")} AS leaf,
    CASE WHEN ({crc32("CAST(doc_id AS VARCHAR)")}) % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS other
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS rid,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
low AS (
  SELECT tree, 0 AS level, pos, n, leaf AS node FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM low WHERE n > 1
  GROUP BY tree, level, pos // 3, n),
subroots AS (SELECT tree, node FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, tree AS pos, (SELECT count(*) FROM subroots) AS n, node FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos)) FROM high WHERE n > 1
  GROUP BY level, pos // 3, n),
near AS (
  SELECT rid, tree, 0 AS level, pos, other AS node, n FROM placed
  UNION ALL
  SELECT f.rid, f.tree, f.level + 1, f.pos // 3,
    sha256(string_agg(CASE WHEN u.pos = f.pos THEN f.node ELSE u.node END, '' ORDER BY u.pos)), (f.n + 2) // 3
  FROM near f JOIN low u ON u.tree = f.tree AND u.level = f.level AND u.pos // 3 = f.pos // 3
  WHERE f.n > 1 GROUP BY f.rid, f.tree, f.level, f.pos, f.n),
far AS (
  SELECT rid, 0 AS level, tree AS pos, node, (SELECT count(*) FROM subroots) AS n FROM near WHERE n = 1
  UNION ALL
  SELECT f.rid, f.level + 1, f.pos // 3,
    sha256(string_agg(CASE WHEN u.pos = f.pos THEN f.node ELSE u.node END, '' ORDER BY u.pos)), (f.n + 2) // 3
  FROM far f JOIN high u ON u.level = f.level AND u.pos // 3 = f.pos // 3
  WHERE f.n > 1 GROUP BY f.rid, f.level, f.pos, f.n),
siblings AS (
  SELECT f.rid, 0 AS part, f.level, u.pos, u.node FROM near f JOIN low u
    ON u.tree = f.tree AND u.level = f.level AND u.pos // 3 = f.pos // 3 AND u.pos <> f.pos
  UNION ALL
  SELECT f.rid, 1, f.level, u.pos, u.node FROM far f JOIN high u ON u.level = f.level AND u.pos // 3 = f.pos // 3 AND u.pos <> f.pos),
proofs AS (SELECT rid, string_agg(node, '' ORDER BY part, level, pos) AS proof FROM siblings GROUP BY rid)
SELECT doc_id, leaf, s.node AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, f.node AS folded_root, f.node = root AS verified
FROM placed JOIN subroots s USING (tree) JOIN far f ON f.rid = placed.rid AND f.n = 1
  CROSS JOIN (SELECT node AS root FROM high WHERE n = 1) LEFT JOIN proofs ON proofs.rid = placed.rid
"""

SQL = {"op11_periodic_runs": OP11, "op12_minhash": OP12, "op13_merkle_manifest": OP13}
