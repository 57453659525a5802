"""DuckDB SQL for the operators whose results relational SQL can tell, over whole tables and whole texts."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

#: Every pair of documents that shares a shingle, counted; components by reachability.
NEAR_DEDUP = f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce({_BLANK_WORDS.format(text=_LOWER)}, []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 4], ' ') END AS s
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT l.b, reach.r FROM reach JOIN links l ON l.a = reach.d),
least AS (SELECT d, min(r) AS r FROM reach GROUP BY d)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least.r AS component_id, doc_id = least.r AS kept
FROM documents JOIN least ON least.d = doc_id LEFT JOIN n USING (doc_id)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha1 FROM pages),
bits AS (SELECT page_id, html, array_to_string(list_transform(string_split(sha1, ''), lambda c:
           ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][strpos('0123456789abcdef', c)]), '') AS bits FROM p),
named AS (SELECT page_id, html, array_to_string(list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST(list_sum(list_transform(generate_series(1, 5), lambda j: CAST(substr(bits, 5 * i + j, 1) AS INTEGER) * (16 >> CAST(j - 1 AS INTEGER)))) AS BIGINT), 1)), '') AS digest FROM bits),
first AS (SELECT html, min(page_id) AS page_id FROM p GROUP BY html)
SELECT n.page_id, CAST(strlen(n.html) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n.page_id = f.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN n.page_id <> f.page_id THEN f.page_id END AS refers_to
FROM named n JOIN first f ON f.html = n.html
"""

SUBSTRING_DEDUP = f"""
WITH w AS (SELECT doc_id, coalesce({_BLANK_WORDS.format(text="text")}, []) AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS s
            FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM w WHERE len(w) >= 50)),
first AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s HAVING min(doc_id) <> max(doc_id)),
gone AS (SELECT DISTINCT doc_id, i + k.k AS p FROM windows JOIN first USING (s), (SELECT unnest(generate_series(0, 49)) AS k) k WHERE doc_id > least),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM w)
         ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

_PLAIN_WORDS = r"coalesce(regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])".format(text=_LOWER)

DECONTAMINATION = f"""
WITH w AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
items AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_PLAIN_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS i FROM items)),
places AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
           FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM w, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS (SELECT doc_id, item_id, i, p.n FROM places p JOIN windows x ON x.s = p.s AND x.n = p.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(named.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

#: Unsigned crc32 of the UTF-8 bytes of ``{text}``: a table of 256 values, then a step per byte.
_CRC_TABLE = """(SELECT list(list_reduce(list_concat([n], generate_series(1, 8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY n)
  FROM (SELECT unnest(generate_series(0, 255)) AS n))"""


def _crc(text: str, table: str) -> str:
    code = f"strpos('0123456789ABCDEF', substr(hex(encode({text})), {{at}}, 1)) - 1"
    bytes_ = f"list_transform(generate_series(1, octet_length(encode({text}))), lambda b: 16 * ({code.format(at='2 * b - 1')}) + {code.format(at='2 * b')})"
    return f"xor(list_reduce(list_concat([4294967295], {bytes_}), lambda c, b: xor(c >> 8, {table}[1 + (xor(c, b) & 255)])), 4294967295)"


_FIELDS = " || ".join(f"coalesce(octet_length(encode(CAST({{{n}}} AS VARCHAR))) || ':' || CAST({{{n}}} AS VARCHAR), '-')" for n in ("doc_id", "source", "lang", "n_chars", "text"))
_NAMES = {n: n for n in ("doc_id", "source", "lang", "n_chars", "text")}

#: Trees level by level; each leaf's siblings by its number at every level.
MERKLE = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS t),
leaves AS (SELECT doc_id, coalesce('s' || source, '') AS tree, sha256({_FIELDS.format(**_NAMES)}) AS leaf,
             CASE WHEN {_crc("CAST(doc_id AS VARCHAR)", "crc.t")} % 5 = 0 THEN sha256({_FIELDS.format(**_NAMES | {"text": _LOWER})}) END AS changed,
             row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS size FROM documents, crc),
nodes AS (SELECT tree, 0 AS level, i, leaf AS h, size FROM leaves
          UNION ALL SELECT tree, level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (any_value(size) + 15) // 16 FROM nodes WHERE size > 1 GROUP BY tree, level, i // 16),
subroots AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS size FROM nodes WHERE size = 1),
top AS (SELECT 0 AS level, i, h, size FROM subroots UNION ALL SELECT level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (any_value(size) + 15) // 16 FROM top WHERE size > 1 GROUP BY level, i // 16),
runs AS (SELECT 0 AS part, tree, level, i, h, size FROM nodes UNION ALL SELECT 1, '', level, i, h, size FROM top),
steps AS (SELECT part, tree, level, i, coalesce(string_agg(h, '') OVER (PARTITION BY part, tree, level, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') || '|'
                 || coalesce(string_agg(h, '') OVER (PARTITION BY part, tree, level, i // 16 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS step FROM runs WHERE size > 1),
own AS (SELECT l.doc_id, l.tree, l.i, s.part, s.level, s.step FROM leaves l JOIN steps s ON s.part = 0 AND s.tree = l.tree AND s.i = l.i // CAST(pow(16, s.level) AS BIGINT)
        UNION ALL SELECT l.doc_id, l.tree, l.i, s.part, s.level, s.step FROM leaves l JOIN subroots r USING (tree) JOIN steps s ON s.part = 1 AND s.i = r.i // CAST(pow(16, s.level) AS BIGINT)),
paths AS (SELECT tree, i, list(step ORDER BY part, level) AS steps FROM own GROUP BY tree, i),
proved AS (SELECT l.*, r.h AS subroot, (SELECT h FROM top WHERE size = 1) AS root, coalesce(p.steps, []) AS steps,
             list_reduce(list_concat([coalesce(changed, leaf)], coalesce(p.steps, [])), lambda a, s: sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2))) AS folded_root
           FROM leaves l JOIN subroots r USING (tree) LEFT JOIN paths p ON p.tree = l.tree AND p.i = l.i)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM proved
"""

#: Buckets of all words and pairs of neighbours, totals, gains, and the draw.
RESAMPLING = f"""
WITH crc AS (SELECT {_CRC_TABLE} AS t),
d AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents), b AS (SELECT {_PLAIN_WORDS} AS w FROM benchmark),
df AS (SELECT doc_id, unnest(list_concat(w, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d),
bf AS (SELECT unnest(list_concat(w, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM b),
bucket AS (SELECT f, {_crc("f", "crc.t")} % 10000 AS k FROM (SELECT DISTINCT f FROM (SELECT f FROM df UNION ALL SELECT f FROM bf)), crc),
s AS (SELECT k, count(*) AS n FROM df JOIN bucket USING (f) GROUP BY k), t AS (SELECT k, count(*) AS n FROM bf JOIN bucket USING (f) GROUP BY k),
gain AS (SELECT k, CAST(floor(1000 * ln((CAST(coalesce(t.n, 0) AS DOUBLE) + 1) * ((SELECT CAST(coalesce(sum(n), 0) AS DOUBLE) FROM s) + 10000)
           / ((CAST(s.n AS DOUBLE) + 1) * ((SELECT CAST(coalesce(sum(n), 0) AS DOUBLE) FROM t) + 10000)))) AS BIGINT) AS g FROM s LEFT JOIN t USING (k)),
weights AS (SELECT doc_id, count(*) AS n, CAST(floor(CAST(sum(g) AS DOUBLE) / count(*)) AS BIGINT) AS w FROM df JOIN bucket USING (f) JOIN gain USING (k) GROUP BY doc_id),
scored AS (SELECT doc_id, len(d.w) AS words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, coalesce(weights.w, 0) AS weight,
             CAST(coalesce(weights.w, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
           FROM d LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 25 * n // 100 THEN r END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""

ORACLE = {"op13_resampling": RESAMPLING, "op11_merkle": MERKLE, "op1_near_dedup": NEAR_DEDUP, "op5_warc": WARC, "op6_substring_dedup": SUBSTRING_DEDUP, "op10_decontaminate": DECONTAMINATION}
