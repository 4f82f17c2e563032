"""DuckDB SQL that gives the rows of those queries that SQL can express."""

from __future__ import annotations

from tidemark.llm import pii, secrets

# --- Decontamination: all windows of the lengths that the test items have, joined as lists of words.

OP5 = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
lengths AS (SELECT DISTINCT least(13, len(w)) AS k FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT item, w, least(13, len(w)) AS k,
    unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
places AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
    FROM d, lengths WHERE len(w) >= k)),
found AS (SELECT p.doc_id, p.i, p.k, v.item FROM places p JOIN windows v ON p.k = v.k AND p.s = v.s),
hits AS (SELECT doc_id, count(DISTINCT word_at) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS word_at FROM (SELECT DISTINCT doc_id, i, k FROM found)) GROUP BY doc_id),
items AS (SELECT doc_id, list(DISTINCT item) AS l FROM found GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(len(x.l), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(list_sort(x.l), ','), '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hits h ON d.doc_id = h.doc_id LEFT JOIN items x ON d.doc_id = x.doc_id
"""


def _spans(kind: str, pattern: str, secret: str, keep: str, source: str = "documents", extra: str = "") -> str:
    """Matches of a pattern with their places: lengths of gaps and matches, added up in turn.

    `secret` and `keep` are SQL over the match `v`.
    """
    p = pattern.replace("'", "''")
    return f"""
(SELECT doc_id, '{kind}' AS kind, pos - length(v) AS a, pos AS b, {secret} AS secret FROM (
  SELECT doc_id, v, sum(length(g) + length(v)) OVER (PARTITION BY doc_id ORDER BY i) AS pos FROM (
    SELECT doc_id, unnest(m) AS v, unnest(g[:len(m)]) AS g, unnest(range(len(m))) AS i FROM (
      SELECT doc_id, regexp_extract_all(text, '{p}') AS m, string_split_regex(text, '{p}') AS g FROM {source} WHERE regexp_matches(text, '{p}')))) WHERE {keep})"""


_NAMES = "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
_BEFORE = _NAMES + "[\"']?\\x20*[:=]\\x20*[\"']?"
_VALUE = f"regexp_extract(v, '^{_BEFORE.replace(chr(39), chr(39) * 2)}([A-Za-z0-9+/_.=-]+)$', 1)"
_KINDS = {"assign": 0, "access": 1, "hex": 2, "owned": 3}

OP1 = f"""
WITH base AS ({_spans('assign', _BEFORE + '[A-Za-z0-9+/_.=-]+', _VALUE, f'length({_VALUE}) >= 8')}
  UNION ALL {_spans('access', 'AKIA[A-Z0-9]+', 'v', 'length(v) >= 16')}
  UNION ALL {_spans('hex', '[0-9a-f]+', 'v', 'length(v) >= 32')}),
tokens AS {_spans('owned', '[A-Za-z0-9+/_=-]{20,}', 'v', f"regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND len(list_distinct(string_split(v, ''))) >= {secrets.LEAST_VARIED}")},
more AS (SELECT * FROM tokens t WHERE NOT EXISTS (SELECT 1 FROM base x WHERE x.doc_id = t.doc_id AND x.a < t.b AND t.a < x.b)),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM more),
counts AS (SELECT secret, count(DISTINCT s.doc_id) AS repositories, count(DISTINCT coalesce(d.source, '')) AS owners
  FROM spans s JOIN documents d ON s.doc_id = d.doc_id GROUP BY secret),
judged AS (SELECT s.*, CASE WHEN owners >= {secrets.COPIED_OWNERS} THEN 'copied' WHEN owners = 1 AND repositories <= {secrets.LIVE_REPOSITORIES} THEN 'live'
  ELSE 'shared' END AS verdict, CASE kind {' '.join(f"WHEN '{k}' THEN {i}" for k, i in _KINDS.items())} END AS place,
  kind || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT) AS t FROM spans s JOIN counts c ON s.secret = c.secret),
sums AS (SELECT doc_id, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secrets.KINDS)},
  string_agg(t, ',' ORDER BY a, place) FILTER (kind <> 'owned') AS base, string_agg(t, ',' ORDER BY a, place) FILTER (kind <> 'owned' OR verdict = 'live') AS spans,
  {', '.join(f"count(*) FILTER (verdict = '{v}') AS n_{v}" for v in secrets.VERDICTS)} FROM judged GROUP BY doc_id)
SELECT d.doc_id, {', '.join(f"coalesce(n_{k}, 0) AS n_{k}" for k in [*secrets.KINDS, *secrets.VERDICTS])},
  sha256(coalesce(s.base, '')) AS base_sha256, coalesce(s.spans, '') AS spans
FROM documents d LEFT JOIN sums s ON d.doc_id = s.doc_id
"""

_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"""(SELECT sum(CASE WHEN i % 2 = 0 THEN d WHEN d > 4 THEN 2 * d - 9 ELSE 2 * d END) FROM (
  SELECT i, CAST(substring(reverse({_DIGITS}), CAST(i AS BIGINT) + 1, 1) AS INT) AS d FROM (SELECT unnest(range(length({_DIGITS}))) AS i))) % 10 = 0"""
_IP_OK = "regexp_full_match(v, '0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})([.]0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}')"
_ALL = [*pii.KINDS, *pii.ADDED]

OP2 = f"""
WITH base AS MATERIALIZED ({_spans('email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+', 'v', 'true')}
  UNION ALL {_spans('ip', '[0-9]+([.][0-9]+)([.][0-9]+)([.][0-9]+)', 'v', _IP_OK)}
  UNION ALL SELECT * FROM {_spans('card', '[0-9]([\\x20-]?[0-9])+', 'v', f"length({_DIGITS}) BETWEEN 14 AND 19")} WHERE {_LUHN.replace('v,', 'secret,')}
  UNION ALL {_spans('phone', '[+][0-9][\\x20().0-9-]+[0-9]', 'v', f"length({_DIGITS}) BETWEEN 10 AND 15")}),
held AS (SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM base)),
words AS (SELECT doc_id, a, b, lower(secret) AS term FROM {_spans('term', '\\p{L}+', 'v', f'length(v) >= {pii.LEAST_TERM}', 'held')}),
free AS (SELECT * FROM words t WHERE NOT EXISTS (SELECT 1 FROM base x WHERE x.doc_id = t.doc_id AND x.a < t.b AND t.a < x.b)),
near AS MATERIALIZED (SELECT s.doc_id, s.kind || ':' || s.secret AS entity, t.term, t.a, t.b FROM base s JOIN free t ON s.doc_id = t.doc_id
  AND ((t.a >= s.a - {pii.NEAR} AND t.b <= s.a) OR (t.a >= s.b AND t.b <= s.b + {pii.NEAR}))),
tc AS (SELECT entity, term, count(DISTINCT doc_id) AS df_tc FROM near GROUP BY ALL HAVING count(DISTINCT doc_id) >= {pii.LEAST_SUPPORT}),
c AS (SELECT kind || ':' || secret AS entity, log2((SELECT count(*) FROM documents)::DOUBLE / count(DISTINCT doc_id)) AS ic FROM base GROUP BY 1),
t AS (SELECT term, count(*) AS df_t FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '\\p{{L}}+'))) AS term FROM documents)
  WHERE term IN (SELECT term FROM tc) GROUP BY term),
told AS (SELECT entity, term, CASE WHEN ic > 0 THEN (ic + log2(df_tc::DOUBLE / greatest(df_t, df_tc))) / ic END AS share FROM tc JOIN c USING (entity) JOIN t USING (term)),
added AS (SELECT doc_id, CASE WHEN max(share) >= {pii.REMOVE} THEN 'remove' ELSE 'generalise' END AS kind, a, b FROM near JOIN told USING (entity, term)
  WHERE share >= {pii.GENERALISE} GROUP BY doc_id, a, b),
every AS (SELECT *, CASE kind {' '.join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(_ALL))} END AS place,
  kind || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT) AS t FROM (SELECT doc_id, kind, a, b FROM base UNION ALL SELECT doc_id, kind, a, b FROM added)),
sums AS (SELECT doc_id, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in pii.KINDS)},
  string_agg(t, ',' ORDER BY a, place) FILTER (place < {len(pii.KINDS)}) AS base, string_agg(t, ',' ORDER BY a, place) AS spans FROM every GROUP BY doc_id)
SELECT d.doc_id, {', '.join(f"coalesce(n_{k}, 0) AS n_{k}" for k in pii.KINDS)}, sha256(coalesce(s.base, '')) AS base_sha256, coalesce(s.spans, '') AS spans
FROM documents d LEFT JOIN sums s ON d.doc_id = s.doc_id
"""

# --- Prefix trie: every prefix as a list, and the ancestors of a node by its smallest member. crc32 byte by byte from its table.

_STEP = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
_ROUNDS = ", ".join(f"r{i + 1} AS (SELECT i, {_STEP.format('c')} AS c FROM r{i})" for i in range(8))

OP12 = f"""
WITH r0 AS (SELECT unnest(range(256)) AS i, unnest(range(256)) AS c), {_ROUNDS},
crcs AS (SELECT list(c ORDER BY i) AS t FROM r8),
own AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT o.*, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(o.conv_id::VARCHAR, ''),
  lambda x: ascii(x)::BIGINT)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]::BIGINT))) % 6 AS h FROM own o, crcs),
whole AS (SELECT a.conv_id, list_concat(coalesce(b.s, [])[:a.h], a.s[a.h + 1:]) AS s FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
prefixes AS (SELECT conv_id, d, s[:d] AS p, len(s) = d AS last, CASE WHEN d > 0 THEN length(s[d].text) ELSE 0 END AS size
  FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM whole)),
nodes AS (SELECT d, p, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256 FROM prefixes GROUP BY d, p),
of AS (SELECT a.conv_id, a.d, n.conv_id AS node FROM prefixes a JOIN nodes n ON a.d = n.d AND a.p = n.p),
kids AS (SELECT o.node, o.d, count(*) AS n_children FROM nodes n JOIN of o ON o.conv_id = n.conv_id AND o.d = n.d - 1 GROUP BY o.node, o.d),
below AS (SELECT o.node, o.d, sum((n.n_convs - 1) * n.size)::BIGINT AS saved_tokens, count(*) FILTER (k.node IS NULL) AS n_leaves
  FROM nodes n LEFT JOIN kids k ON k.node = n.conv_id AND k.d = n.d JOIN of o ON o.conv_id = n.conv_id AND o.d <= n.d GROUP BY o.node, o.d)
SELECT n.conv_id, n.d AS depth, o.node AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN of o ON o.conv_id = n.conv_id AND o.d = n.d - 1 LEFT JOIN kids k ON k.node = n.conv_id AND k.d = n.d
JOIN below b ON b.node = n.conv_id AND b.d = n.d
"""

# --- Ranked search: every document against every item that shares a term with it.

_TERM_LIST = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

OP13 = f"""
WITH k AS (SELECT doc_id, row_number() OVER () AS r, w FROM (SELECT doc_id, {_TERM_LIST} AS w FROM documents) WHERE len(w) > 0),
g AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS length FROM k),
t AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM k) GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM t, g GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest({_TERM_LIST}) AS term FROM benchmark),
scores AS (SELECT item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // length))))::BIGINT AS score
  FROM q JOIN t USING (term) JOIN f USING (term), g GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 10
"""

ORACLE = {
    "op1_secret_ownership": OP1, "op2_pii_sanitisation": OP2, "op5_benchmark_decontamination": OP5, "op12_prefix_trie": OP12,
    "op13_ranked_search": OP13,
}
