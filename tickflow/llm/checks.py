"""SQL of the operators that SQL can express, over the given tables."""

from __future__ import annotations

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NONE = "lambda w: w <> ''"


def _words(text: str, separators: str, lower: bool) -> str:
    source = _LOWER.format(text) if lower else f"coalesce({text}, '')"
    return f"list_filter(regexp_split_to_array({source}, '{separators}'), {_NONE})"


_SPACE = r"[ \t\n\x0B\f\r]+"
_NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words("text", _NOT_ALNUM, True)} AS w FROM benchmark),
sized AS (SELECT item, w, least(10, len(w)) AS n FROM item WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, n, w[i:i + n - 1] AS gram FROM sized, unnest(range(1, len(w) - n + 2)) AS t(i)),
doc AS (SELECT doc_id, {_words("text", _NOT_ALNUM, True)} AS w FROM documents),
place AS (SELECT doc_id, n, i, w[i:i + n - 1] AS gram FROM doc, (SELECT DISTINCT n FROM windows), unnest(range(1, len(w) - n + 2)) AS t(i)),
hit AS (SELECT doc_id, i, place.n, item FROM place JOIN windows ON place.gram = windows.gram AND place.n = windows.n),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""

ARCHIVES = """
WITH page AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
best AS (SELECT digest, max(page_id) AS kept FROM page WHERE n >= 1000 GROUP BY digest)
SELECT page_id, n AS payload_bytes, page.digest AS payload_digest,
  CASE WHEN page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM page LEFT JOIN best ON page.digest = best.digest AND n >= 1000"""

SUBSTRINGS = f"""
WITH doc AS (SELECT doc_id, {_words("text", _SPACE, False)} AS w FROM documents),
place AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS gram FROM doc, unnest(range(1, len(w) - 48)) AS t(i)),
first AS (SELECT gram, min(doc_id) AS first FROM place GROUP BY gram),
gone AS (SELECT DISTINCT place.doc_id, p FROM place JOIN first USING (gram), unnest(range(i, i + 50)) AS t(p) WHERE place.doc_id > first),
lists AS (SELECT doc_id, count(*) AS n, list(p) AS p FROM gone GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(w[i], ' ' ORDER BY i) AS text FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc) AS t
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = t.doc_id AND gone.p = t.i) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM doc LEFT JOIN lists USING (doc_id) LEFT JOIN kept USING (doc_id)"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE doc AS (SELECT doc_id, {_words("text", _SPACE, True)} AS w FROM documents),
shingle AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 3], ' ')) AS s FROM doc, unnest(range(1, greatest(len(w) - 2, 2))) AS t(i) WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
both_sides AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM both_sides JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
way AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(x, y) AS (SELECT doc_id, doc_id FROM doc UNION SELECT reach.x, way.y FROM reach JOIN way ON reach.y = way.x),
root AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM root LEFT JOIN size USING (doc_id)"""


CONVERSATIONS = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))
  )) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS d, role, text FROM (
    SELECT c.conv_id, 0 AS own, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
    UNION ALL
    SELECT c.conv_id, 1, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h
  )
), paths AS (
  SELECT conv_id, d, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
         list(md5(length(role)::VARCHAR || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY d) AS path
  FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, 0, [] FROM convs
), sizes AS (
  SELECT conv_id, max(d) AS size FROM paths GROUP BY conv_id
), nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = d) AS ends
  FROM paths JOIN sizes USING (conv_id) GROUP BY path, d
), children AS (
  SELECT path[1:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), below AS (
  SELECT v.path[1:k] AS path, sum((v.n_convs - 1) * v.words) AS saved,
         count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM children c WHERE c.path = v.path)) AS leaves
  FROM nodes v, unnest(range(v.d + 1)) AS x(k) GROUP BY 1
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN below b ON b.path = n.path LEFT JOIN children c ON c.path = n.path
LEFT JOIN nodes p ON n.d > 0 AND p.path = n.path[1:n.d - 1]
"""
