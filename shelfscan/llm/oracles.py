"""Reference SQL (DuckDB) of the operators that SQL can express."""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of a short ASCII text, bit by bit."""
    bits = (f"flatten(list_transform(string_split({text}, ''), lambda c: "
            "list_transform(range(8), lambda k: (ascii(c) >> k) & 1)))")
    return (f"xor(list_reduce({bits}, lambda crc, bit: xor(crc >> 1, "
            "CASE WHEN xor(crc, bit) & 1 = 1 THEN 3988292384 ELSE 0 END), 4294967295), 4294967295)")


def sized(value: str) -> str:
    return f"coalesce(octet_length(encode({value})) || ':' || {value}, '-')"


def leaf(text: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    return f"sha256({' || '.join(map(sized, fields))})"


MERKLE = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, {leaf("text")} AS leaf, {leaf("given")} AS delivered
  FROM (SELECT *, CASE WHEN {crc32("doc_id::VARCHAR")} % 2 = 0 THEN replace(text, chr(10), '')
                  ELSE text END AS given FROM documents)),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY source) AS n FROM rows),
up AS (
  SELECT source, 0 AS level, i, leaf AS h, n FROM leaves
  UNION ALL
  SELECT source, level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3
  FROM up WHERE n > 1 GROUP BY source, level, i // 3, n),
subroots AS (
  SELECT source, h, level AS levels, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i,
         count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS level, i, h, n FROM subroots
  UNION ALL
  SELECT level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3
  FROM top WHERE n > 1 GROUP BY level, i // 3, n),
root AS (SELECT h, level AS levels FROM top WHERE n = 1),
steps AS (
  SELECT l.source, l.i, u.level AS step, u.i < l.i // (3 ** u.level)::BIGINT AS before, u.h, u.i AS j
  FROM leaves l JOIN up u ON u.source IS NOT DISTINCT FROM l.source
    AND u.i // 3 = l.i // (3 ** (u.level + 1))::BIGINT AND u.i != l.i // (3 ** u.level)::BIGINT
  UNION ALL
  SELECT l.source, l.i, s.levels + t.level, t.i < s.i // (3 ** t.level)::BIGINT, t.h, t.i
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
  JOIN top t ON t.i // 3 = s.i // (3 ** (t.level + 1))::BIGINT
    AND t.i != s.i // (3 ** t.level)::BIGINT),
sides AS (
  SELECT source, i, step, coalesce(string_agg(h, '' ORDER BY j) FILTER (before), '') AS ahead,
         coalesce(string_agg(h, '' ORDER BY j) FILTER (NOT before), '') AS behind
  FROM steps GROUP BY source, i, step),
fold AS (
  SELECT source, i, 0 AS step, delivered AS h FROM leaves
  UNION ALL
  SELECT f.source, f.i, f.step + 1, sha256(coalesce(x.ahead, '') || f.h || coalesce(x.behind, ''))
  FROM fold f JOIN subroots s ON s.source IS NOT DISTINCT FROM f.source
  CROSS JOIN root r
  LEFT JOIN sides x ON x.source IS NOT DISTINCT FROM f.source AND x.i = f.i AND x.step = f.step
  WHERE f.step < s.levels + r.levels),
proof AS (
  SELECT source, i, sha256(string_agg(ahead || behind, '' ORDER BY step)) AS digest
  FROM sides GROUP BY source, i)
SELECT l.doc_id, l.leaf, s.h AS subroot, r.h AS root,
       coalesce(p.digest, sha256('')) AS proof_sha256, f.h AS folded_root,
       f.h = r.h AS verified
FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
CROSS JOIN root r
JOIN fold f ON f.source IS NOT DISTINCT FROM l.source AND f.i = l.i AND f.step = s.levels + r.levels
LEFT JOIN proof p ON p.source IS NOT DISTINCT FROM l.source AND p.i = l.i
"""

TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p FROM conversations),
convs AS (SELECT conv_id, {crc32("conv_id::VARCHAR")} % 9 AS h
          FROM (SELECT DISTINCT conv_id FROM conversations)),
parts AS (
  SELECT c.conv_id, 0 AS own, t.p, t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.p <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.p, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.p > c.h),
rebuilt AS (
  SELECT c.conv_id, coalesce(list({{'role': role, 'text': text}} ORDER BY own, p) FILTER (own IS NOT NULL), [])
    AS turns FROM convs c LEFT JOIN parts x ON x.conv_id = c.conv_id GROUP BY c.conv_id),
prefixes AS (
  SELECT conv_id, unnest(range(len(turns) + 1)) AS depth, turns FROM rebuilt),
nodes AS (
  SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                FILTER (len(turns) = depth), '')) AS ends_sha256,
         (count(*) - 1) * coalesce(octet_length(encode(any_value(turns[depth].text))), 0) AS saved
  FROM prefixes GROUP BY ALL),
families AS (
  SELECT p.path, count(*) AS n_children FROM nodes p
  JOIN nodes c ON c.depth = p.depth + 1 AND c.path[1:p.depth] = p.path GROUP BY p.path),
trees AS (
  SELECT p.path, sum(c.saved) AS saved, count(*) FILTER (f.path IS NULL) AS n_leaves
  FROM nodes p JOIN nodes c ON c.depth >= p.depth AND c.path[1:p.depth] = p.path
  LEFT JOIN families f ON f.path = c.path GROUP BY p.path)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(f.n_children, 0) AS n_children, t.n_leaves, t.saved::BIGINT AS saved_tokens,
       n.ends_sha256
FROM nodes n JOIN trees t ON t.path = n.path LEFT JOIN families f ON f.path = n.path
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
"""
