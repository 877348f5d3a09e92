"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

from wardstar.llm import sharding

SQL: dict[str, str] = {}

# base32 of the SHA-1: eight groups of five hex digits give four letters each.
SQL["op5_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT page_id, strlen(html) AS payload_bytes, hex,
         array_to_string([
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + CAST((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER),
                  1) for i in range(32)], '') AS payload_digest
  FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first_page FROM d
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_page THEN NULL ELSE first_page END AS refers_to,
       CAST(NULL AS VARCHAR) AS problem
FROM f
"""

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL["op7_decontamination"] = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, '{UP}', '{LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
), starts AS (
  SELECT item, w, least(len(w), 10) AS size, unnest(range(greatest(len(w) - 9, 1))) AS i FROM item WHERE len(w) > 0
), wanted AS (
  SELECT DISTINCT item, size, w[i + 1 : i + size] AS g FROM starts
), loose AS (
  SELECT DISTINCT item, size + 4 AS span, list_distinct(w[i + 1 : i + size]) AS terms FROM starts
), placed AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM words
), runs AS (
  SELECT doc_id, pos, word, list(word) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 13 FOLLOWING) AS g
  FROM placed
), sizes AS (
  SELECT DISTINCT size FROM wanted
), keyed AS (
  SELECT doc_id, pos, size, array_to_string(g[1:size], ' ') AS k FROM runs, sizes WHERE len(g) >= size
), found AS (
  SELECT doc_id, pos, k.size, item FROM keyed k JOIN wanted t ON k.size = t.size AND k.k = array_to_string(t.g, ' ')
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS p FROM found) GROUP BY 1
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1
), near AS (
  SELECT doc_id, count(DISTINCT item) AS n_near_items
  FROM runs r JOIN (SELECT item, span, terms, unnest(terms) AS word FROM loose) l ON r.word = l.word
  WHERE list_has_all(r.g[1:l.span], l.terms) GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated, coalesce(n_near_items, 0) AS n_near_items
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN near USING (doc_id)
"""
SQL["op9_jaccard_join"] = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), placed AS (
  SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS pos FROM words
), runs AS (
  SELECT doc_id, n, list(word) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS g FROM placed
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(g, ' ') AS g FROM runs WHERE len(g) = least(n, 4)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY 1
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * common >= 85 * (x.n + y.n - common)
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least_of AS (
  SELECT a, min(b) AS m FROM reach GROUP BY 1
)
SELECT words.doc_id, coalesce(sizes.n, 0) AS n_shingles, least(words.doc_id, coalesce(m, words.doc_id)) AS component_id
FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of ON words.doc_id = a
"""


def _feistel(source: str) -> str:
    """One pass of the permutation over columns row, n, b, x of ``source``."""
    first, second = sharding.MULTIPLIERS
    low = sharding.LOW32
    now = f"SELECT row, n, b, x // b AS l, x % b AS r FROM {source}"
    for number in range(sharding.ROUNDS):
        key = sharding.round_key(0, number)
        now = f"SELECT row, n, b, l, r, (xor(r, {key}::UBIGINT) * {first}::UBIGINT) & {low}::UBIGINT AS y FROM ({now})"
        now = f"SELECT row, n, b, l, r, (xor(y, y >> 15) * {second}::UBIGINT) & {low}::UBIGINT AS y FROM ({now})"
        now = f"SELECT row, n, b, r AS l, (l + xor(y, y >> 13)) % b AS r FROM ({now})"
    return f"SELECT row, n, b, l * b + r AS x FROM ({now})"


# CRC-32 of the UTF-8 bytes: the table of its polynomial, then one step per byte.
SQL["op13_feistel_shards"] = f"""
WITH RECURSIVE crc AS (
  SELECT [list_reduce(range(9), lambda c, k: CASE WHEN k = 0 THEN c WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                      CAST(i AS BIGINT)) for i in range(256)] AS tab
), measured AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size,
         xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)),
                         lambda c, b: xor(c >> 8, crc.tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32
  FROM documents, crc
), numbered AS (
  SELECT *, CAST(row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS UBIGINT) AS row FROM measured
), start AS (
  SELECT row, CAST(count(*) OVER () AS UBIGINT) AS n, CAST(ceil(sqrt(count(*) OVER ())) AS UBIGINT) AS b, row AS x FROM numbered
), walk AS (
  {_feistel("start")}
  UNION ALL
  {_feistel("(SELECT * FROM walk WHERE x >= n)")}
)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(x % {sharding.SHARDS} AS INTEGER) AS shard,
       CAST(x // {sharding.SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN walk USING (row) WHERE x < n
"""
