"""SQL with the same result as the query, for those that SQL can express."""

from __future__ import annotations

FIELD = "coalesce(octet_length(encode(CAST({0} AS VARCHAR)))::VARCHAR || ':' || CAST({0} AS VARCHAR), '-')"
LEAF = "sha256(" + " || ".join(FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# CRC-32: the characters of the id, each followed by eight shifts (-1)
CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"""

MERKLE = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS tree, {LEAF.format(text="text")} AS leaf,
         CASE WHEN {CRC32} % 3 = 0 THEN {LEAF.format(text=LOWERED)} END AS changed
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot, count(*) OVER (PARTITION BY tree) AS n FROM doc),
nodes AS (
  SELECT tree, 0 AS level, spot, n, leaf AS hash FROM placed
  UNION ALL
  SELECT tree, level + 1, spot // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY spot)) FROM nodes WHERE n > 1 GROUP BY tree, level, spot // 8, n),
subroots AS (
  SELECT tree, hash, row_number() OVER (ORDER BY encode(tree)) - 1 AS spot, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, spot, n, hash FROM subroots
  UNION ALL
  SELECT level + 1, spot // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY spot)) FROM tops WHERE n > 1 GROUP BY level, spot // 8, n),
low AS (
  SELECT p.doc_id, p.tree, p.spot, string_agg(s.hash, '' ORDER BY s.level, s.spot) AS proof
  FROM placed p JOIN nodes s ON s.tree = p.tree AND s.n > 1 AND s.spot // 8 = p.spot // CAST(pow(8, s.level + 1) AS BIGINT)
       AND s.spot <> p.spot // CAST(pow(8, s.level) AS BIGINT)
  GROUP BY ALL),
high AS (
  SELECT r.tree, string_agg(s.hash, '' ORDER BY s.level, s.spot) AS proof
  FROM subroots r JOIN tops s ON s.n > 1 AND s.spot // 8 = r.spot // CAST(pow(8, s.level + 1) AS BIGINT) AND s.spot <> r.spot // CAST(pow(8, s.level) AS BIGINT)
  GROUP BY ALL),
fold_low AS (
  SELECT tree, spot AS leaf_at, 0 AS level, spot, n, coalesce(changed, leaf) AS acc FROM placed
  UNION ALL
  SELECT f.tree, f.leaf_at, f.level + 1, f.spot // 8, (f.n + 7) // 8, sha256(string_agg(CASE WHEN s.spot = f.spot THEN f.acc ELSE s.hash END, '' ORDER BY s.spot))
  FROM fold_low f JOIN nodes s ON s.tree = f.tree AND s.level = f.level AND s.spot // 8 = f.spot // 8
  WHERE f.n > 1 GROUP BY f.tree, f.leaf_at, f.level, f.spot, f.n),
fold_high AS (
  SELECT f.tree, f.leaf_at, 0 AS level, r.spot, r.n, f.acc FROM fold_low f JOIN subroots r ON r.tree = f.tree WHERE f.n = 1
  UNION ALL
  SELECT f.tree, f.leaf_at, f.level + 1, f.spot // 8, (f.n + 7) // 8, sha256(string_agg(CASE WHEN s.spot = f.spot THEN f.acc ELSE s.hash END, '' ORDER BY s.spot))
  FROM fold_high f JOIN tops s ON s.level = f.level AND s.spot // 8 = f.spot // 8
  WHERE f.n > 1 GROUP BY f.tree, f.leaf_at, f.level, f.spot, f.n)
SELECT p.doc_id, p.leaf, r.hash AS subroot, t.hash AS root, sha256(coalesce(l.proof, '') || coalesce(h.proof, '')) AS proof_sha256,
       f.acc AS folded_root, f.acc = t.hash AS verified
FROM placed p JOIN subroots r ON r.tree = p.tree JOIN (SELECT hash FROM tops WHERE n = 1) t ON true
     JOIN fold_high f ON f.tree = p.tree AND f.leaf_at = p.spot AND f.n = 1
     LEFT JOIN low l ON l.tree = p.tree AND l.spot = p.spot LEFT JOIN high h ON h.tree = p.tree
"""

# a page without an id comes last when the response of a group is chosen
WARC = """
WITH page AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
sized AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM page),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS place,
         min(page_id) OVER (PARTITION BY payload_digest) AS least FROM sized)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN least END AS refers_to
FROM ranked
"""
