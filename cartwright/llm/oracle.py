"""DuckDB SQL for the operators that SQL can express on whole tables.

The others (merge replay, prefix programs, expectation-maximisation, exact
neighbours, MinHash links, tiling, licence expressions) are tested against
brute force in tests/llm.
"""

from __future__ import annotations

UNIT_DEDUP = r"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(text, '[^.!?\n]+[.!?\n]*|[.!?\n]+') AS parts
  FROM documents),
placed AS (
  SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) - 1 AS unit FROM cut),
spans AS (
  SELECT doc_id, unit, part,
         sum(length(part)) OVER (PARTITION BY doc_id ORDER BY unit) AS upto
  FROM placed),
plain AS (
  SELECT doc_id, unit, upto, length(part) AS size,
         trim(regexp_replace(lower(part), '[^\p{L}\p{N}]+', ' ', 'g')) AS words
  FROM spans),
hashed AS (
  SELECT doc_id, unit, upto, size, upper(md5(words)) AS digest,
         length(words) - length(replace(words, ' ', '')) + 1 AS n_words
  FROM plain),
ranked AS (
  SELECT *, first_value(doc_id) OVER w AS first_doc_id, first_value(unit) OVER w AS first_unit,
         row_number() OVER w AS place
  FROM hashed WHERE n_words >= 8
  WINDOW w AS (PARTITION BY digest ORDER BY doc_id, unit))
SELECT doc_id, CAST(unit AS BIGINT) AS unit, CAST(upto - size AS BIGINT) AS "start",
       CAST(upto AS BIGINT) AS "end", CAST(n_words AS BIGINT) AS n_words, digest, first_doc_id,
       CAST(first_unit AS BIGINT) AS first_unit
FROM ranked WHERE place > 1
"""

# fixed values: the reversed CRC-32 polynomial's table for four bits
_CRC = [0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158,
        0x5005713C, 0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4,
        0xA00AE278, 0xBDBDF21C]
_ONES = f"CAST({0xFFFFFFFF} AS BIGINT)"

JUMP_SHARDS = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
halves AS (
  SELECT doc_id, length(h) // 2 AS n_bytes,
         list_transform(string_split(h, ''), lambda c:
           CAST(instr('0123456789ABCDEF', c) - 1 AS BIGINT)) AS d
  FROM texts),
turned AS (
  -- of each byte the lower half first
  SELECT doc_id, n_bytes, list_prepend({_ONES}, list_transform(range(1, 2 * n_bytes + 1),
           lambda i: d[i + 1 - 2 * ((i + 1) % 2)])) AS b
  FROM halves),
sums AS (
  SELECT doc_id, n_bytes + 8 AS size,
         xor(list_reduce(b, lambda s, x: xor(s >> 4, CAST({_CRC}[(xor(s, x) & 15) + 1] AS BIGINT))),
             {_ONES}) AS text_crc32
  FROM turned),
walk AS (
  SELECT DISTINCT doc_id,
         CAST(CASE WHEN doc_id < 0 THEN doc_id + 18446744073709551616 ELSE doc_id END
              AS HUGEINT) AS seed,
         CAST(-1 AS BIGINT) AS bucket, CAST(0 AS BIGINT) AS jump
  FROM documents
  UNION ALL
  SELECT doc_id, next_seed, jump,
         CAST(floor((jump + 1) * (CAST(2147483648 AS DOUBLE)
                                  / CAST(next_seed // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
  FROM (SELECT doc_id, jump,
               (seed * 2862933555777941757 + 1) % 18446744073709551616 AS next_seed
        FROM walk WHERE jump <= 24)),
shards AS (
  SELECT doc_id, max(bucket) FILTER (WHERE bucket < 24) AS shard, max(bucket) AS grown
  FROM walk GROUP BY doc_id)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, CAST(s.text_crc32 AS BIGINT) AS text_crc32,
       'key' AS law, CAST(h.shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY h.shard ORDER BY s.doc_id, s.text_crc32) - 1 AS slot,
       CAST(h.grown AS INTEGER) AS grown_shard
FROM sums s JOIN shards h ON s.doc_id = h.doc_id
"""

#: squared distances in the plain domain, one assignment and one mean a round
_ROUND = """
far{i} AS MATERIALIZED (
  SELECT c.row_id, c.part, b.entry, sum((c.x - b.c) * (c.x - b.c)) AS far
  FROM components c JOIN book{i} b ON c.part = b.part AND c.place = b.place
  GROUP BY ALL),
picked{i} AS MATERIALIZED (
  SELECT row_id, part, arg_min(entry, (far, entry)) AS entry, min(far) AS far
  FROM far{i} GROUP BY ALL)"""
_MEAN = """
sum{i} AS MATERIALIZED (
  SELECT part, entry, place, sum(x) AS s, count(*) AS n
  FROM components JOIN picked{i} USING (row_id, part) GROUP BY ALL),
book{j} AS MATERIALIZED (
  SELECT part, entry, place,
         CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c
  FROM book{i} LEFT JOIN sum{i} USING (part, entry, place))"""

VECTOR_CODES = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row_id, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
components AS MATERIALIZED (
  SELECT row_id, (pos - 1) // (len(v) // 8) AS part, (pos - 1) % (len(v) // 8) AS place, v[pos] AS x
  FROM (SELECT row_id, v, unnest(range(1, len(v) + 1)) AS pos FROM kept)),
book0 AS MATERIALIZED (
  SELECT part, row_id - 1 AS entry, place, x AS c FROM components WHERE row_id <= 16),
""" + ",".join(_ROUND.format(i=i) + "," + _MEAN.format(i=i, j=i + 1) for i in range(6)) \
    + "," + _ROUND.format(i=6) + """,
coded AS (
  SELECT k.vec_id, k.label, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part)
           AS code,
         sum(far) AS error
  FROM picked6 JOIN kept k USING (row_id) GROUP BY row_id, k.vec_id, k.label)
SELECT vec_id, code, CAST(error AS BIGINT) AS error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, place))
        FROM book6) AS codebooks_sha256
FROM coded
"""

DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce(text, '') AS text
  FROM documents),
words AS MATERIALIZED (
  SELECT id, lang, source,
         translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM docs),
kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
groups AS MATERIALIZED (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
filled AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
totals AS (SELECT lang, source, sum(n) AS total FROM filled GROUP BY ALL),
shares AS MATERIALIZED (
  SELECT f.lang, f.source, f.term, f.n,
         1 + (1000000000::HUGEINT * (f.n + 2)) // (t.total + 2 * l.v) AS p,
         1 + (1000000000::HUGEINT * (f.lang_n + 2)) // (l.total + 2 * l.v) AS q
  FROM filled f JOIN totals t USING (lang, source) JOIN langs l USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
listed AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q)
  FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM listed)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_unit_dedup": UNIT_DEDUP, "op10_jump_hash_shards": JUMP_SHARDS,
            "op12_walsh_vector_codes": VECTOR_CODES, "op13_source_divergence": DIVERGENCE}
