"""DuckDB SQL of the operators that SQL can express, over whole tables. Nothing here shares
the Spark plans' methods: windows, shingles and scores are all written out."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _folded(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}')"


def _base32(digest: str) -> str:
    """A hexadecimal SHA-1 in base 32: five bytes are eight characters."""
    groups = (f"cast('0x' || substr({digest}, {at}, 10) AS BIGINT)" for at in (1, 11, 21, 31))
    return " || ".join(f"substr('{_BASE32}', cast(({g} >> {bits}) & 31 AS INTEGER) + 1, 1)" for g in groups for bits in range(35, -1, -5))


_SHINGLES = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all({_folded('text')}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, ws[i] || ' ' || ws[i + 1] AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM worded WHERE len(ws) > 1) x
  UNION ALL SELECT doc_id, ws[1] FROM worded WHERE len(ws) = 1),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
sized AS (SELECT s.doc_id, s.s, z.n FROM shingles s JOIN sizes z ON s.doc_id = z.doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sized a JOIN sized b ON a.s = b.s AND a.doc_id < b.doc_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(z.n, 0) AS n_shingles, least(w.doc_id, coalesce(l.b, w.doc_id)) AS component_id,
       w.doc_id = least(w.doc_id, coalesce(l.b, w.doc_id)) AS kept
FROM worded w LEFT JOIN sizes z ON w.doc_id = z.doc_id LEFT JOIN least_of l ON w.doc_id = l.a
"""

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WINDOWS = rf"""
WITH worded AS (SELECT doc_id, regexp_extract_all({_folded('text')}, '{_WORDS}') AS ws FROM documents),
items AS (SELECT item_id, regexp_extract_all({_folded('text')}, '{_WORDS}') AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, 10 AS size, array_to_string(ws[i:i + 9], ' ') AS t
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - 8)) AS i FROM items WHERE len(ws) >= 10) x
  UNION ALL SELECT DISTINCT item_id, len(ws), array_to_string(ws, ' ') FROM items WHERE len(ws) BETWEEN 1 AND 9),
sizes AS (SELECT DISTINCT size FROM windows),
placed AS (
  SELECT doc_id, size, i, array_to_string(ws[i:i + size - 1], ' ') AS t
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM worded, sizes WHERE len(ws) >= size) x),
hits AS (SELECT p.doc_id, p.i, p.size, w.item_id FROM placed p JOIN windows w ON p.size = w.size AND p.t = w.t),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) x GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(name, ',' ORDER BY name)) AS sha
  FROM (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS name FROM hits) x GROUP BY doc_id)
SELECT w.doc_id, len(w.ws) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
       coalesce(n.sha, sha256('')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM worded w LEFT JOIN covered c ON w.doc_id = c.doc_id LEFT JOIN named n ON w.doc_id = n.doc_id
"""

_ARCHIVED = f"""
SELECT page_id, strlen(payload) AS payload_bytes, {_base32('digest')} AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM (SELECT page_id, payload, sha1(payload) AS digest, max(page_id) OVER (PARTITION BY payload) AS last
      FROM (SELECT page_id, coalesce(html, '') AS payload FROM pages) p) q
"""

_COPIES = r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(content) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents) t
WINDOW same AS (PARTITION BY content)
"""

_NEGATIVES = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * cast(x AS DOUBLE))) AS c
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS alike, b.vec_id, cast(list_inner_product(a.c, b.c) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth FROM scored WHERE alike) x
  WHERE nth <= 5),
negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS nth
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id
  WHERE NOT s.alike AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, cast(nth AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE nth <= 3
"""

SQL = {
    "op1_near_duplicates": _SHINGLES,
    "op4_decontamination": _WINDOWS,
    "op8_warc": _ARCHIVED,
    "op11_exact_copies": _COPIES,
    "op13_hard_negatives": _NEGATIVES,
}
