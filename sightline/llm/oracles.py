"""SQL counterparts, for operators that SQL can express. Written for DuckDB."""

from __future__ import annotations

import string

from sightline.llm.quality import COMMON_WORDS, Quality

_LISTED = ", ".join(
    f"('{lang}', {place}, '{word}')" for lang, listed in COMMON_WORDS.items() for place, word in enumerate(listed.split())
)
_P = Quality()


def _distance(counts: str, reference: str) -> str:
    """Jensen-Shannon distance of two lists of counts."""
    x, y = f"({counts}[i] / list_sum({counts}))", f"({reference}[i] / list_sum({reference}))"
    part = lambda v: f"(CASE WHEN {v} > 0 THEN {v} * log2(2 * {v} / ({x} + {y})) ELSE 0 END)"
    terms = f"list_sum(list_transform(range(1, len({counts}) + 1), lambda i: ({part(x)} + {part(y)}) / 2))"
    return f"round(sqrt(greatest({terms}, 0)), 6)"


QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, COALESCE(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
p AS (SELECT rid, lang, unnest(ws) AS w0, generate_subscripts(ws, 1) AS i FROM w),
l AS (SELECT *, lead(w0, 1) OVER o AS w1, lead(w0, 2) OVER o AS w2, lead(w0, 3) OVER o AS w3, lead(w0, 4) OVER o AS w4
  FROM p WINDOW o AS (PARTITION BY rid ORDER BY i)),
twice AS (SELECT rid, i FROM l WHERE w4 IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, w0, w1, w2, w3, w4) > 1),
repeated AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(5) AS r(k) GROUP BY rid),
known(lang, place, word) AS (VALUES {_LISTED}),
hits AS (SELECT rid, place, count(*) AS n FROM p JOIN known k ON k.lang = p.lang AND k.word = p.w0 GROUP BY ALL),
listed AS (SELECT w.rid, k.place, COALESCE(h.n, 0) AS n FROM w JOIN known k ON k.lang = w.lang
  LEFT JOIN hits h ON h.rid = w.rid AND h.place = k.place),
common AS (SELECT rid, list(n ORDER BY place) AS own FROM listed GROUP BY rid),
h AS (SELECT w.*, list_append(own, len(ws) - list_sum(own)) AS common,
    [length(regexp_replace(t, '[^a-z]', '', 'g')), length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')),
     length(regexp_replace(t, '[^A-Z]', '', 'g')), length(regexp_replace(t, '[^0-9]', '', 'g')),
     length(regexp_replace(t, '[^.,;:!?''"()-]', '', 'g')), length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))] AS six,
    length(regexp_replace(t, '[^\x00-\x7F]', '', 'g')) AS ascii
  FROM w LEFT JOIN common c ON c.rid = w.rid),
c AS (SELECT *, six || [ascii - list_sum(six), length(t) - ascii] AS classes FROM h),
sums AS (SELECT lang, place, sum(c.classes[place]) AS n FROM c, range(1, 9) AS r(place) WHERE common IS NOT NULL GROUP BY ALL),
word_sums AS (SELECT lang, place, sum(c.common[place]) AS n FROM c, range(1, 26) AS r(place) WHERE common IS NOT NULL
  GROUP BY ALL),
refs AS (SELECT lang, list(n ORDER BY place) AS classes_ref FROM sums GROUP BY lang),
word_refs AS (SELECT lang, list(n ORDER BY place) AS common_ref FROM word_sums GROUP BY lang),
counted AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(t) - six[2] AS BIGINT) AS word_chars,
    CAST(six[6] AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(COALESCE(r.n, 0) AS BIGINT) AS n_repeat_words,
    CASE WHEN length(t) >= {_P.guard_chars} AND common IS NOT NULL THEN {_distance("classes", "classes_ref")} END AS char_distance,
    CASE WHEN len(ws) >= {_P.guard_words} AND common IS NOT NULL THEN {_distance("common", "common_ref")} END AS word_distance
  FROM c LEFT JOIN repeated r ON r.rid = c.rid LEFT JOIN refs ON refs.lang = c.lang
  LEFT JOIN word_refs ON word_refs.lang = c.lang),
judged AS (SELECT *, n_words < {_P.least_words} OR 100 * n_repeat_words > {_P.most_repeated} * n_words AS base_failed
  FROM counted)
SELECT *, NOT base_failed AND COALESCE(char_distance <= {_P.far_chars}, TRUE) AND COALESCE(word_distance <= {_P.far_words}, TRUE)
  AS kept FROM judged
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(
    translate(COALESCE(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, ws[i : i + 4] AS shingle FROM (
    SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS node, doc_id AS root FROM documents
  UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.node),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT w.doc_id, CAST(COALESCE(n.n, 0) AS BIGINT) AS n_shingles, root AS component_id, root = w.doc_id AS kept
FROM w JOIN roots ON node = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
"""

DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
    translate(COALESCE(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS t FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, CAST(sum(n) AS BIGINT) AS total FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
every AS (SELECT g.lang, g.source, k.term, k.n AS lang_n, COALESCE(c.n, 0) AS n FROM g JOIN kept k ON k.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT lang, source, term, n, 1 + 1000000000 * (n + 5) // (CAST(sum(n) OVER (PARTITION BY lang, source) AS BIGINT) + 5 * v) AS p,
    1 + 1000000000 * (lang_n + 5) // (total + 5 * v) AS q FROM every JOIN v USING (lang)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a
  JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(COALESCE(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
over_used AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (FROM pairs UNION ALL FROM over_used))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

#: the CRC-32 of a number's decimal digits: each byte is mixed in and then shifted out bit by bit
_CRC32 = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
  lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"""

PREFIX_TRIE = rf"""
WITH t AS (SELECT conv_id, {{'role': COALESCE(role, ''), 'text': COALESCE(text, '')}} AS said,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, COALESCE(role, ''), COALESCE(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(said ORDER BY place) AS own FROM t GROUP BY conv_id),
h AS (SELECT *, {_CRC32} % 9 AS h FROM c),
r AS (SELECT h.conv_id, list_concat(COALESCE(b.own, [])[1 : h.h], h.own[h.h + 1 :]) AS path
  FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 5),
p AS (SELECT conv_id, depth, path[1 : depth] AS name, len(path) = depth AS ends
  FROM r, unnest(range(0, len(path) + 1)) AS u(depth)),
n AS (SELECT depth, name, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(COALESCE(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY ALL),
up AS (SELECT a.depth, a.name, b.conv_id AS parent_conv_id FROM n a JOIN n b ON b.depth = a.depth - 1 AND b.name = a.name[1 : a.depth - 1]),
kids AS (SELECT depth - 1 AS depth, name[1 : depth - 1] AS name, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
own AS (SELECT n.*, COALESCE(n_children, 0) AS n_children,
    CASE WHEN n.depth > 0 THEN (n_convs - 1) * octet_length(encode(n.name[-1].text)) ELSE 0 END AS saved
  FROM n LEFT JOIN kids ON kids.depth = n.depth AND kids.name = n.name),
below AS (SELECT d.depth, o.name[1 : d.depth] AS name, sum(CAST(o.n_children = 0 AS INTEGER)) AS n_leaves, sum(o.saved) AS saved
  FROM own o, unnest(range(0, o.depth + 1)) AS d(depth) GROUP BY ALL)
SELECT o.conv_id, o.depth, up.parent_conv_id, o.n_convs, CAST(o.n_children AS BIGINT) AS n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, o.ends_sha256
FROM own o JOIN below ON below.depth = o.depth AND below.name = o.name LEFT JOIN up ON up.depth = o.depth AND up.name = o.name
"""
