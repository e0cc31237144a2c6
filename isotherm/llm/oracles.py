"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations


def hilbert_blocks(rounds: int = 4, parts: int = 4, entries: int = 256, scale: int = 1024) -> str:
    """Plain k-means over integer parts: every part against every entry, round by round."""
    ctes = [f"""WITH v AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT rid, p, list_slice(v, p * (len(v) // {parts}) + 1, (p + 1) * (len(v) // {parts})) AS x
  FROM v, range({parts}) t(p)),
b0 AS MATERIALIZED (SELECT p, rid - 1 AS entry, x AS c FROM p WHERE rid <= {entries})"""]
    for k in range(rounds + 1):
        ctes.append(f"""a{k} AS MATERIALIZED (SELECT rid, p, any_value(x) AS x, min(struct_pack(d := d, e := entry)) AS m FROM (
  SELECT rid, p.p, x, entry, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
  FROM p JOIN b{k} b ON p.p = b.p) GROUP BY rid, p)""")
        if k < rounds:
            ctes.append(f"""b{k + 1} AS MATERIALIZED (SELECT b.p, b.entry, coalesce(n.c, b.c) AS c FROM b{k} b LEFT JOIN (
  SELECT p, entry, list((s - ((s % k) + k) % k) // k ORDER BY pos) AS c FROM (
    SELECT p, m.e AS entry, pos, CAST(sum(x[pos]) AS BIGINT) AS s, count(*) AS k
    FROM (SELECT p, m, x, unnest(range(1, len(x) + 1)) AS pos FROM a{k}) GROUP BY ALL) GROUP BY ALL) n
  ON n.p = b.p AND n.entry = b.entry)""")
    return ",\n".join(ctes) + f""",
f AS (SELECT rid, string_agg(printf('%02x', CAST(m.e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, entry)) FROM b{rounds}) AS codebooks_sha256
FROM v JOIN f USING (rid)"""


#: Paths are strings of turn digests, so a prefix of d turns is the first 64 * d characters.
PREFIX_TRIE = r"""WITH RECURSIVE tab AS (
  SELECT b, CAST(b AS BIGINT) AS v, 0 AS k FROM range(256) t(b)
  UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM tab WHERE k < 8),
lut AS (SELECT b, v FROM tab WHERE k = 8),
crc AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS v
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
  UNION ALL SELECT conv_id, s, i + 1, xor(crc.v >> 8, lut.v)
  FROM crc JOIN lut ON lut.b = xor(crc.v, ascii(s[i + 1])) & 255 WHERE i < length(s)),
h AS (SELECT conv_id, xor(v, 4294967295) % 4 AS h FROM crc WHERE i = length(s)),
own AS (SELECT conv_id, tok, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tok) AS pos
  FROM (SELECT conv_id, turn, sha256(CAST(length(r) AS VARCHAR) || ':' || r || x) AS tok,
      len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words
    FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL))),
rebuilt AS (
  SELECT h.conv_id, 0 AS half, pos, tok, words FROM h JOIN own ON own.conv_id = h.conv_id - h.conv_id % 20 AND pos <= h
  UNION ALL SELECT h.conv_id, 1, pos, tok, words FROM h JOIN own USING (conv_id) WHERE pos > h),
seq AS (SELECT h.conv_id, coalesce(path, '') AS path, words, coalesce(n, 0) AS n FROM h LEFT JOIN (
  SELECT conv_id, string_agg(tok, '' ORDER BY half, pos) AS path, list(words ORDER BY half, pos) AS words, count(*) AS n
  FROM rebuilt GROUP BY conv_id) USING (conv_id)),
mem AS (SELECT conv_id, n, d, left(path, 64 * d) AS k, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS w
  FROM (SELECT *, unnest(range(n + 1)) AS d FROM seq)),
node AS (SELECT k, d, min(conv_id) AS c, count(*) AS m, any_value(w) AS w,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = n), '')) AS ends
  FROM mem GROUP BY k, d),
kids AS (SELECT left(k, 64 * (d - 1)) AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
val AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (k)),
sub AS (SELECT left(k, 64 * a) AS k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves, sum((m - 1) * w) AS saved
  FROM (SELECT *, unnest(range(d + 1)) AS a FROM val) GROUP BY 1)
SELECT val.c AS conv_id, val.d AS depth, CASE WHEN val.d > 0 THEN up.c END AS parent_conv_id, val.m AS n_convs,
  CAST(val.n_children AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, val.ends AS ends_sha256
FROM val JOIN sub USING (k) LEFT JOIN node up ON val.d > 0 AND up.k = left(val.k, 64 * (val.d - 1))"""
