"""SQL for those corpus queries that SQL can express."""

from __future__ import annotations

from staylens.llm import decontamination

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all(translate({}, '" + _UPPER + "', '" + _LOWER + r"'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents
), i AS (
  SELECT DISTINCT item_id, {_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL
), win AS (
  SELECT DISTINCT item_id, least(len(w), {decontamination.WINDOW}) AS n,
         array_to_string(w[p:p + least(len(w), {decontamination.WINDOW}) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {decontamination.WINDOW} + 1, 1) + 1)) AS p FROM i WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win), dw AS (
  SELECT k, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)
), hit AS (SELECT k, p, n, item_id FROM dw JOIN win USING (n, win)),
words AS (SELECT k, count(DISTINCT q) AS n_hit FROM (SELECT k, unnest(range(p, p + n)) AS q FROM hit) GROUP BY k),
items AS (
  SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT k, item_id::VARCHAR AS item FROM hit) GROUP BY k
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (k) LEFT JOIN items USING (k)
"""

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
), k AS (
  SELECT html, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY html
)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k ON p.html = k.html
"""

# crc32 byte by byte: a table of 256 remainders, then one step per byte
SHARDING = """
WITH step AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, repeat([0::BIGINT], 8)),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
), d AS (
  SELECT doc_id, source, strlen(coalesce(text, '')) + 16 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents
), b AS (
  SELECT doc_id, source, size, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS bytes FROM d
), c AS (
  SELECT doc_id, source, size, xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
    lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]))) AS text_crc32 FROM b, step
), s AS (
  SELECT *, coalesce('=' || source, '') AS stratum, md5('1|' || coalesce(doc_id::VARCHAR, '')) AS draw FROM c
), r AS (
  SELECT *, row_number() OVER w - 1 AS rank, count(*) OVER (PARTITION BY stratum) AS total,
    ('0x' || substr(md5(stratum), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS phase
  FROM s WINDOW w AS (PARTITION BY stratum ORDER BY draw, doc_id NULLS FIRST, text_crc32, size)
), p AS (
  SELECT *, row_number() OVER (ORDER BY (rank + phase) / total, stratum, draw, doc_id NULLS FIRST, text_crc32, size) - 1 AS position,
    count(*) OVER () AS n
  FROM r
), q AS (SELECT *, position * 40 // n AS shard FROM p)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INTEGER AS shard, (position - (shard * n + 39) // 40)::BIGINT AS slot,
  NULL::INTEGER AS grown_shard, source
FROM q
"""

# all pairs that share a shingle, then all documents that links reach
PARITY_JOIN = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS k, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), s AS (
  SELECT DISTINCT k, array_to_string(w[p:p + least(len(w), 5) - 1], ' ') AS s
  FROM (SELECT k, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM w WHERE len(w) > 0)
), n AS (SELECT k, count(*) AS n FROM s GROUP BY k
), i AS (SELECT a.k AS x, b.k AS y, count(*) AS i FROM s a JOIN s b ON a.s = b.s GROUP BY a.k, b.k
), l AS (
  SELECT x, y FROM i JOIN n a ON a.k = x JOIN n b ON b.k = y WHERE 100 * i >= 80 * (a.n + b.n - i)
), r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.component_id, w.doc_id)::BIGINT AS component_id
FROM w LEFT JOIN n USING (k)
LEFT JOIN (SELECT x AS k, min(doc_id) AS component_id FROM r JOIN w ON w.k = r.y GROUP BY x) m USING (k)
"""

# every anchor's score with every row
HARD_NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS rn, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.rn AS a, a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         list_sum(list_transform(range(1, greatest(len(a.q), len(r.q)) + 1),
           lambda i: coalesce(a.q[i], 0) * coalesce(r.q[i], 0)))::BIGINT AS score
  FROM v a JOIN v r ON a.rn <> r.rn WHERE a.vec_id % 100 = 0
), p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS k FROM s WHERE same) WHERE k <= 5
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.a, p.k ORDER BY s.score DESC, s.vec_id) AS rank,
         s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score, p.k AS positive_rank
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score, positive_rank::INTEGER AS positive_rank
FROM n WHERE rank <= 10
"""

ORACLES: dict[str, str] = {
    "op6_decontamination": DECONTAMINATION,
    "op7_sharding": SHARDING,
    "op9_warc": WARC,
    "op12_parity_join": PARITY_JOIN,
    "op13_hard_negatives": HARD_NEGATIVES,
}
