"""What SQL can state of the corpus queries, for a second engine."""

from __future__ import annotations

_WORDS = r"""regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w"""
DECONTAMINATION = f"""WITH d AS (SELECT doc_id, {_WORDS} FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, p, p + 9), ' ') AS g
  FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS p FROM i WHERE len(w) > 0)),
grams AS (
  SELECT doc_id, n, p, array_to_string(list_slice(w, p, p + n - 1), ' ') AS g
  FROM (SELECT d.doc_id, d.w, l.n, unnest(generate_series(1, len(d.w) - l.n + 1)) AS p
        FROM d, (SELECT DISTINCT n FROM windows) l)),
hits AS (SELECT doc_id, item, p, n FROM grams JOIN windows USING (n, g)),
hit_words AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LINES = f"""WITH l AS (
  SELECT doc_id, unnest(w) AS line, generate_subscripts(w, 1) AS p
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
                          '{_UPPER}', '{_UPPER.lower()}') AS key FROM l),
common AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN common c ON k.key = c.key GROUP BY doc_id"""

# CRC-32 of decimal digits, bit by bit.
_CRC = """xor(list_reduce(
    list_concat([4294967295], list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(substr(s, i, 1)) AS BIGINT))),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
TRIE = f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'k': md5(length(role) || ':' || role || ':' || text), 'n': length(text)}}
                       ORDER BY turn NULLS FIRST, role, text) AS t
  FROM turns GROUP BY conv_id),
crc AS (SELECT conv_id, {_CRC} % 6 AS h FROM (SELECT conv_id, CAST(conv_id AS VARCHAR) AS s FROM own)),
r AS (
  SELECT o.conv_id, list_concat(list_slice(coalesce(b.t, []), 1, h), list_slice(o.t, h + 1, len(o.t))) AS t
  FROM own o JOIN crc USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
prefixes AS (
  SELECT conv_id, d, len(t) = d AS ends, coalesce(t[d].n, 0) AS chars,
    array_to_string(list_transform(list_slice(t, 1, d), lambda x: x.k), '') AS key
  FROM (SELECT *, unnest(range(0, len(t) + 1)) AS d FROM r)),
nodes AS (
  SELECT key, d, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * any_value(chars) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends
  FROM prefixes GROUP BY key, d),
children AS (SELECT key[:32 * (d - 1)] AS key, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
subtrees AS (
  SELECT top, sum(leaf) AS leaves, sum(saved) AS saved
  FROM (SELECT key[:32 * unnest(range(0, d + 1))] AS top, saved, CAST(c.n IS NULL AS INTEGER) AS leaf
        FROM nodes LEFT JOIN children c USING (key))
  GROUP BY top)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, CASE WHEN x.d > 0 THEN y.conv_id END AS parent_conv_id,
  x.n AS n_convs, coalesce(c.n, 0) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, x.ends AS ends_sha256
FROM nodes x LEFT JOIN nodes y ON x.d > 0 AND y.key = x.key[:32 * (x.d - 1)]
LEFT JOIN children c ON c.key = x.key JOIN subtrees s ON s.top = x.key"""


def _clusters(rounds: int = 10, k: int = 8) -> str:
    """The rounds one after the other; a vector's best is the minimum of distance * k + cluster."""

    def assigned(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (
  SELECT vec_id, any_value(v) AS v, min(b) % {k} AS c, min(b) // {k} AS distance
  FROM (SELECT vec_id, v, c + {k} * CAST(list_sum(list_transform(list_zip(v, m),
          lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS b FROM vectors, c{i})
  GROUP BY vec_id)"""

    def moved(i: int) -> str:
        return f"""c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(n.m, o.m) AS m FROM c{i} o LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS m
    FROM (SELECT c, p, sum(x) AS s, count(*) AS n
          FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM a{i}) GROUP BY c, p)
    GROUP BY c) n USING (c))"""

    steps = [step(i) for i in range(rounds) for step in (assigned, moved)]
    return f"""WITH vectors AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, v AS m
  FROM (SELECT v, sha256('3:' || vec_id) AS h FROM vectors ORDER BY h LIMIT {k})),
{", ".join(steps)},
{assigned(rounds)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (c)"""


ORACLE: dict[str, str] = {
    "op3_benchmark_decontamination": DECONTAMINATION,
    "op11_prefix_trie": TRIE,
    "op12_centroid_clustering": _clusters(),
    "op13_line_dedup": LINES,
}
