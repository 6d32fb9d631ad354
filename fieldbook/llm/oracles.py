"""SQL that gives the rows of those text queries that SQL can express."""

from __future__ import annotations

from fieldbook.llm.secret_scan import KINDS, LEAST_ASSIGNED

_FOUND = " UNION ALL ".join(
    f"SELECT r, o, p, t, {n} AS kind, regexp_extract_all(t, '{pattern}') AS w, string_split_regex(t, '{pattern}') AS g,"
    f" regexp_extract_all(t, '{pattern}', {group}) AS v FROM d"
    for n, (_, pattern, group) in enumerate(KINDS)
)
_NAMES = ", ".join(f"'{kind}'" for kind, _, _ in KINDS)
_TEXT = "string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, rank)"

SECRETS = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS o, concat_ws('/', source, lang) AS p FROM documents),
 k AS ({_FOUND}),
 m AS (SELECT r, o, p, t, kind, w, g, v, unnest(generate_series(1, len(w))) AS i FROM k),
 p AS (SELECT r, o, p, t, kind, length(w[i]) AS size, length(v[i]) AS vsize, v[i] AS val, sum(length(g[i]) + length(w[i])) OVER (PARTITION BY r, kind ORDER BY i) AS e FROM m),
 c AS (SELECT *, e - size AS s FROM p WHERE kind <> 0 OR vsize >= {LEAST_ASSIGNED}),
 homes AS (SELECT val, t, min({{'o': o, 'p': p}}) AS home FROM c GROUP BY 1, 2),
 own AS (SELECT val, count(DISTINCT home.o) AS n_owners, count(DISTINCT home) AS n_repositories FROM homes GROUP BY 1),
 j AS (SELECT c.*, n_owners, n_repositories, CASE WHEN n_owners >= 2 OR n_repositories >= 3 THEN 'example' WHEN len(list_distinct(string_split(val, ''))) >= 8 THEN 'live' ELSE 'plain' END AS judged FROM c JOIN own USING (val)),
 x AS (SELECT r, s, kind AS rank, e, [{_NAMES}][kind + 1] AS name, judged, n_owners, n_repositories FROM j
   UNION SELECT r, e - vsize, {len(KINDS)}, e, 'live', 'live', n_owners, n_repositories FROM j WHERE judged = 'live')
SELECT doc_id, count(*) FILTER (name = 'assign') AS n_assign, count(*) FILTER (name = 'access') AS n_access, count(*) FILTER (name = 'hex') AS n_hex,
  sha256(coalesce({_TEXT} FILTER (rank < {len(KINDS)}), '')) AS base_sha256, coalesce({_TEXT}, '') AS spans,
  count(*) FILTER (name = 'live') AS n_live, count(*) FILTER (judged = 'example') AS n_examples,
  CAST(coalesce(max(n_owners), 0) AS BIGINT) AS most_owners, CAST(coalesce(max(n_repositories), 0) AS BIGINT) AS most_repositories
FROM d LEFT JOIN x USING (r) GROUP BY r, doc_id"""

SIMILAR = r"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
 s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) < 5 THEN CASE WHEN len(w) = 0 THEN [] ELSE [array_to_string(w, ' ')] END
   ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
 e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
 l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
 t(doc_id, near) AS (SELECT doc_id, doc_id FROM s UNION SELECT t.doc_id, l.b FROM t JOIN l ON t.near = l.a)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id FROM s JOIN (SELECT doc_id, min(near) AS component_id FROM t GROUP BY 1) USING (doc_id)"""

#: CRC-32 of ASCII text from its polynomial, which DuckDB has no function for.
_CRC_TABLE = """crc_table AS (SELECT list(v ORDER BY n) AS crc_t FROM (SELECT n, list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
  lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(n)))"""


def _crc32(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT))"
    step = "lambda c, b: xor(c >> 8, crc_t[CAST(xor(c, b) & 255 AS INTEGER) + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), {step}), 4294967295)"


TRIE = rf"""WITH {_CRC_TABLE},
 t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
 k AS (SELECT c, turn, role, strlen(role) || ':' || role || text AS key, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM t),
 own AS (SELECT c, list({{'key': key, 'words': words}} ORDER BY turn NULLS FIRST, role, substr(sha256(key), 1, 32)) AS turns FROM k GROUP BY c),
 h AS (SELECT c, turns, {_crc32('CAST(c AS VARCHAR)')} % 4 AS h FROM own, crc_table),
 r AS (SELECT h.c, list_concat(coalesce(base.turns[1:h], []), h.turns[h + 1:]) AS turns FROM h LEFT JOIN own AS base ON base.c = h.c - h.c % 20),
 p AS (SELECT c, turns, unnest(generate_series(0, len(turns))) AS d FROM r),
 m AS (SELECT turns[1:d] AS node, d, min(c) AS conv_id, count(*) AS n_convs FROM p GROUP BY 1, 2),
 kids AS (SELECT node[1:d - 1] AS node, count(*) AS n FROM m WHERE d > 0 GROUP BY 1),
 v AS (SELECT m.*, coalesce(kids.n, 0) AS n_children, CASE WHEN d > 0 THEN (n_convs - 1) * node[d].words ELSE 0 END AS own FROM m LEFT JOIN kids USING (node)),
 up AS (SELECT node, own, n_children, unnest(generate_series(0, d)) AS level FROM v),
 sums AS (SELECT node[1:level] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(own) AS saved FROM up GROUP BY 1),
 ends AS (SELECT turns AS node, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS hashed FROM r GROUP BY 1)
SELECT v.conv_id, d AS depth, above.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  coalesce(hashed, sha256('')) AS ends_sha256
FROM v JOIN sums USING (node) LEFT JOIN ends USING (node) LEFT JOIN (SELECT node, conv_id FROM m) AS above ON v.d > 0 AND above.node = v.node[1:d - 1]"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


MANIFEST = f"""WITH RECURSIVE {_CRC_TABLE},
 f AS (SELECT row_number() OVER () AS r, doc_id, lang, {_leaf('n_chars')} AS leaf,
   CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS claimed FROM documents, crc_table),
 p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM f),
 n(lang, lvl, i, d, width) AS (SELECT lang, 0, place, leaf, count(*) OVER (PARTITION BY lang) FROM p
   UNION ALL SELECT lang, lvl + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (width + 1) // 2 FROM n WHERE width > 1 GROUP BY lang, lvl, i // 2, width),
 s AS (SELECT lang, d AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM n WHERE width = 1),
 u(lvl, i, d, width) AS (SELECT 0, place, subroot, count(*) OVER () FROM s
   UNION ALL SELECT lvl + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (width + 1) // 2 FROM u WHERE width > 1 GROUP BY lvl, i // 2, width),
 a AS (SELECT p.r, n.lvl AS step, n.i % 2 AS odd, m.d AS sibling FROM p JOIN n ON n.lang IS NOT DISTINCT FROM p.lang AND n.i = p.place >> n.lvl AND n.width > 1
   LEFT JOIN n AS m ON m.lang IS NOT DISTINCT FROM n.lang AND m.lvl = n.lvl AND m.i = xor(n.i, 1)
   UNION ALL SELECT p.r, 1000 + u.lvl, u.i % 2, m.d FROM p JOIN s ON s.lang IS NOT DISTINCT FROM p.lang JOIN u ON u.i = s.place >> u.lvl AND u.width > 1
   LEFT JOIN u AS m ON m.lvl = u.lvl AND m.i = xor(u.i, 1)),
 w AS (SELECT r, string_agg(sibling, '' ORDER BY step) AS proof,
   list(CASE WHEN sibling IS NULL THEN '-' WHEN odd = 1 THEN 'L' || sibling ELSE 'R' || sibling END ORDER BY step) AS way FROM a GROUP BY r),
 o AS (SELECT p.doc_id, p.leaf, s.subroot, (SELECT d FROM u WHERE width = 1) AS root, sha256(coalesce(w.proof, '')) AS proof_sha256,
   list_reduce(list_prepend(p.claimed, coalesce(w.way, [])), lambda d, x: sha256(CASE x[1] WHEN 'L' THEN x[2:] || d WHEN 'R' THEN d || x[2:] ELSE d END)) AS folded_root
   FROM p JOIN s ON s.lang IS NOT DISTINCT FROM p.lang LEFT JOIN w USING (r))
SELECT *, folded_root = root AS verified FROM o"""
