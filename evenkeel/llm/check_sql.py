"""SQL of another engine for the queries that SQL can express."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"
_FOLDED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all({_FOLDED.format("coalesce(text, '')")}, '{_WORD}') AS w
  FROM documents
), shingled AS (
  SELECT doc_id, CASE
      WHEN len(w) = 0 THEN []
      WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - 1),
        lambda i: concat_ws(' ', w[i], w[i + 1], w[i + 2])))
    END AS s
  FROM worded
), sized AS (
  SELECT doc_id, len(s)::BIGINT AS n FROM shingled
), single AS (
  SELECT doc_id, unnest(s) AS g FROM shingled
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM single a JOIN single b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY ALL
), linked AS (
  SELECT a, b FROM common JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
  WHERE 100 * c >= 90 * (x.n + y.n - c)
), both_ways AS (
  SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
), reached AS (
  SELECT a AS node, b AS other FROM both_ways
  UNION
  SELECT r.node, l.b FROM reached r JOIN both_ways l ON l.a = r.other
), lowest AS (
  SELECT node, min(other) AS other FROM reached GROUP BY node
)
SELECT s.doc_id, s.n AS n_shingles, least(s.doc_id, coalesce(l.other, s.doc_id)) AS component_id
FROM sized s LEFT JOIN lowest l ON l.node = s.doc_id
"""

_OP4 = rf"""
WITH plain AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g') AS bare,
    length(coalesce(text, '')) AS points
  FROM documents
)
SELECT doc_id,
  first(doc_id) OVER (PARTITION BY bare ORDER BY points DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY bare) AS group_size,
  doc_id = first(doc_id) OVER (PARTITION BY bare ORDER BY points DESC, doc_id) AS kept,
  sha256(bare) AS text_sha256
FROM plain
"""

_SHARES = rf"""
sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM totals
), weighted AS (
  SELECT *, 1 + (rank - 1) % 3 AS weight FROM ranked
), stepped AS (
  SELECT *,
    (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (
      ORDER BY source_size * 3 / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    )::BIGINT / (sum(weight) OVER (
      ORDER BY source_size * 3 / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    )::BIGINT AS unit
  FROM weighted
), shares AS (
  SELECT source, source_size,
    least((3 * source_size)::DOUBLE, max(unit) OVER () * weight) AS target
  FROM stepped
)
"""

_OP7 = rf"""
WITH {_SHARES}, running AS (
  SELECT s.*, h.source_size, h.target, floor(h.target)::BIGINT AS asked,
    sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size
      ROWS UNBOUNDED PRECEDING)::BIGINT - size AS before
  FROM sized s JOIN shares h ON s.source IS NOT DISTINCT FROM h.source
)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size = 0 THEN 0 ELSE size * (asked // source_size)
    + greatest(0, least(size, asked % source_size - before)) END)::BIGINT AS taken
FROM running
"""

_OP8 = rf"""
WITH cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS place FROM cut
), keyed AS (
  SELECT *, {_FOLDED.format("trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13))")} AS key
  FROM lines
), marked AS (
  SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_OP10 = """
WITH digested AS (
  SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, '')))::BIGINT AS size
  FROM pages
), named AS (
  SELECT page_id, size, sha1(body) AS digest,
    CASE WHEN size >= 1000 THEN max(page_id) OVER (PARTITION BY body) ELSE page_id END AS last
  FROM digested
)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM named
"""

# The polynomial is that of CRC-32, reflected.
_OP11 = """
WITH own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce("text", '')} ORDER BY turn NULLS FIRST) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), summed AS (
  SELECT conv_id, l, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 9 AS h
  FROM own
), rebuilt AS (
  SELECT o.conv_id, list_concat(list_slice(coalesce(b.l, []), 1, o.h), list_slice(o.l, o.h + 1, len(o.l))) AS path
  FROM summed o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5
), members AS (
  SELECT conv_id, len(path) AS total, unnest(range(0, len(path) + 1)) AS depth, path FROM rebuilt
), nodes AS (
  SELECT depth, list_slice(path, 1, depth) AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = total), '') AS ends
  FROM members GROUP BY ALL
), sized AS (
  SELECT n.*, (SELECT count(*) FROM nodes c
      WHERE c.depth = n.depth + 1 AND list_slice(c.prefix, 1, n.depth) = n.prefix) AS n_children,
    CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(prefix[depth].t) END AS saved
  FROM nodes n
), below AS (
  SELECT unnest(range(0, depth + 1)) AS above, prefix, n_children, saved FROM sized
), subtrees AS (
  SELECT above, list_slice(prefix, 1, above) AS prefix, sum((n_children = 0)::INT)::BIGINT AS n_leaves,
    sum(saved)::BIGINT AS saved_tokens
  FROM below GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens,
  sha256(n.ends) AS ends_sha256
FROM sized n JOIN subtrees s ON s.above = n.depth AND s.prefix = n.prefix
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = list_slice(n.prefix, 1, n.depth - 1)
"""

SQL: dict[str, str] = {
    "op1_ngram_join": _OP1,
    "op4_exact_dedup": _OP4,
    "op7_mixing": _OP7,
    "op8_line_dedup": _OP8,
    "op10_warc": _OP10,
    "op11_prefix_trie": _OP11,
}
