"""DuckDB SQL for the corpus operators that SQL can express, over the same tables."""

from __future__ import annotations

from .shards import ROUNDS

#: Every 50-byte string of every text, as hex digits, with the smallest document that has it.
SUFFIXES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
q AS (SELECT doc_id, k, substr(h, 2048 * k + 1, 2146) AS h FROM (SELECT doc_id, h, unnest(range((length(h) // 2 - 50) // 1024 + 1)) AS k FROM d WHERE length(h) >= 100)),
w AS (SELECT doc_id, 1024 * k + j AS i, substr(h, 2 * j + 1, 100) AS s FROM (SELECT doc_id, k, h, unnest(range(least(1024, length(h) // 2 - 49))) AS j FROM q)),
m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
r AS (SELECT doc_id, i FROM w JOIN m USING (s) WHERE least < doc_id),
g AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM r),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM g),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM n GROUP BY 1, 2),
gaps AS (SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM runs WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT doc_id, max(b), NULL FROM runs GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, length(h) // 2) - a)), '' ORDER BY a) AS k FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
t AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def sharding(shards: int = 24) -> str:
    """Checksums by their table, row numbers, the Feistel rounds, and a recursive walk of numbers out of range."""
    step = "SELECT id, n, h, m, p >> h AS l, p & m AS r FROM s WHERE walk = 0 OR p >= n"
    for mul, add in ROUNDS:
        x = f"(r * {mul} + {add})"
        step = f"SELECT id, n, h, m, r AS l, xor(l, (xor({x}, {x} >> h) >> 3) & m) AS r FROM ({step})"
    return f"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i))),
b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
c AS (SELECT doc_id, length(x) // 2 + 8 AS size, xor(4294967295, list_reduce(
  [4294967295::BIGINT] || list_transform(range(1, length(x), 2), lambda j: ('0x' || substr(x, j, 2))::BIGINT), lambda a, v: xor(t[xor(a & 255, v) + 1], a >> 8))) AS text_crc32 FROM b, crc),
s0 AS (SELECT doc_id, size, text_crc32, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS id FROM c),
z AS (SELECT count(*) AS n, greatest(1, ceil(log2(greatest(count(*), 2)) / 2))::INT AS h FROM s0),
s AS (
  SELECT id, n, h, (1::BIGINT << h) - 1 AS m, id AS p, 0 AS walk FROM s0, z
  UNION ALL
  SELECT id, n, h, m, (l << h) | r, 1 FROM ({step}))
SELECT doc_id, size, text_crc32, id AS row_no, 'rows' AS law, (p % {shards})::INT AS shard, p // {shards} AS slot, CAST(NULL AS INT) AS grown_shard
FROM s0 JOIN (SELECT id, p FROM s WHERE walk = 1 AND p < n) USING (id)
"""


#: Every run of one to three words of a piece, by their texts; scores in 128 bits.
COLLOCATIONS = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, (SELECT unnest([1, 2, 3]) AS k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS cut FROM c),
s AS (SELECT c.lang, c.k, c.phrase, c.a, cut, x.f AS l, y.f AS r, (1000000 * a::HUGEINT * a) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:c.k], ' ')),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
held AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE k = 3) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INT AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM best LEFT JOIN held USING (lang, phrase) JOIN total USING (lang)
WHERE longer IS NULL OR k = 3 OR 100 * longer < 50 * a
QUALIFY rank <= 2000
"""


#: All inner products of the anchors, in 128 bits.
NEGATIVES = """
WITH u AS (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, a.label AS own, b.id, b.label, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1]::HUGEINT * z[2]))::BIGINT AS score
  FROM u a JOIN u b ON a.id <> b.id WHERE a.id % 100 = 0),
p AS (SELECT anchor_id, own, id AS positive_id, score AS positive_score FROM s WHERE own = label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id, own) WHERE s.label <> own AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""


ORACLES = {"op4_suffix_array": SUFFIXES, "op7_sharding": sharding(24), "op11_collocations": COLLOCATIONS, "op12_hard_negatives": NEGATIVES}
