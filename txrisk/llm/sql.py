"""DuckDB twins of the queries that SQL can express, over the raw tables."""

from __future__ import annotations

_LOWER = "translate(coalesce({c}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _words(column: str) -> str:
    return f"regexp_extract_all({_LOWER.format(c=column)}, {_WORD})"


REPEATS = """WITH l AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT doc_id, b, unnest(range(octet_length(b) - 49)) AS i FROM l WHERE octet_length(b) >= 50),
s AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY b[i + 1:i + 50]) AS least FROM w),
hit AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new
  FROM s WHERE least < doc_id),
grp AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM hit),
span AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS z FROM grp GROUP BY doc_id, g),
gap AS (SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z0, a FROM span
  UNION ALL SELECT l.doc_id, coalesce(max(z), 0), octet_length(any_value(b)) FROM l LEFT JOIN span USING (doc_id)
  GROUP BY l.doc_id),
kept AS (SELECT doc_id, unhex(string_agg(hex(b[z0 + 1:a]), '' ORDER BY z0, a)) AS k FROM gap JOIN l USING (doc_id)
  GROUP BY doc_id)
SELECT l.doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes,
  CAST(octet_length(b) - octet_length(k) AS BIGINT) AS n_removed,
  (SELECT count(*) FROM span WHERE span.doc_id = l.doc_id) AS n_spans, sha256(k) AS kept_sha256
FROM l JOIN kept USING (doc_id)"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(x, {k + 1}, 5) AS BIGINT) >> {s}) & 31) + 1, 1)"
    for k in range(0, 40, 5) for s in (15, 10, 5, 0))
WARC = f"""WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS x,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < first THEN first END AS refers_to FROM p"""

DECONTAMINATE = f"""WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words('text')} AS w FROM benchmark),
bi AS (SELECT item, w, least(10, len(w)) AS n, unnest(range(greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, list_slice(w, i + 1, i + n) AS g FROM bi),
sizes AS (SELECT DISTINCT n FROM win),
di AS (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT di.doc_id, di.i, di.n, win.item FROM di JOIN win ON di.n = win.n AND list_slice(di.w, di.i + 1, di.i + di.n) = win.g),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

VECTOR_LINKS = """WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ok AS (SELECT * FROM e WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND list_dot_product(v, v) > 0),
lnk AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.9),
r AS (SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT r.a, lnk.b FROM r JOIN lnk ON r.b = lnk.a)
SELECT a AS vec_id, (SELECT count(*) FROM lnk WHERE lnk.a = r.a) AS n_links, min(b) AS component_id, a = min(b) AS kept
FROM r GROUP BY a"""

URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
URL_VERDICTS = f"""WITH r(host, path, verdict) AS (VALUES {', '.join(map(repr, URL_RULES))}),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, {_LOWER.format(c="regexp_extract(rest, '^[^/?#]*')")} AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
best AS (SELECT *, (SELECT {{'rule': r.host || r.path, 'verdict': r.verdict}} FROM r
  WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  ORDER BY length(r.host) + length(r.path) DESC, length(r.host) DESC LIMIT 1) AS b FROM p)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict FROM best"""

# crc32 of the column ``k``, byte by byte with the reversed polynomial 0xEDB88320.
_CRC = """xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(range(octet_length(encode(k))),
    lambda i: CAST('0x' || substr(hex(encode(k)), 2 * i + 1, 2) AS BIGINT)), lambda c, x: list_reduce(
    [xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)),
  4294967295)"""


def _edit(state: str, letter: str, cost: str, line: str = "''") -> str:
    """A best way (cost, audit, lines) after one more edit; 10^9 is unreachable."""
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {state}.o || {line}}}"


_USER, _ASSISTANT = "chr(10) || 'user:' || ", "chr(10) || 'assistant:' || "
_TO_U = f"list_min([b2, {', '.join(_edit(b, 'I', '5', _USER + chr(39) * 2) for b in ('b0', 'b1', 'b3'))}])"
_TO_A = f"list_min([b3, {_edit('c2', 'I', '5', _ASSISTANT + chr(39) * 2)}])"
_KEPT, _EXTRA, _NEVER = "chr(10) || role || ':' || text", "(CASE WHEN cut THEN 5 ELSE 0 END)", "1000000000"


def _row(to: str, initial: str, states: list[str], named: str | None) -> str:
    """Best way into a state by a row: deleted, kept with its initial, or renamed."""
    ways = [_edit(to, "D", "2")]
    for b in states:
        keep = f"(CASE WHEN gone OR r <> '{initial}' THEN {_NEVER} ELSE {_EXTRA} END)"
        ways.append(_edit(b, "K", keep, _KEPT))
        if named:
            ways.append(_edit(b, "R", f"(CASE WHEN gone THEN {_NEVER} ELSE 1 + {_EXTRA} END)", named + "text"))
    return f"list_min([{', '.join(ways)}])"


CONVERSATIONS = rf"""WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
f AS (SELECT *, {_CRC} % 20 AS fate FROM k),
d AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
  CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) FROM f WHERE fate <> 0),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS copy, left(role, 1) AS r,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid FROM t),
w AS (SELECT *, solid = '' AS blank, solid = '' OR copy > 1 AS gone,
  solid <> '' AND copy = 1 AND right(solid, 1) NOT IN ('.', '!', '?') AS cut,
  lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS pair FROM o),
none(x, z) AS (SELECT {{'c': {_NEVER}, 'a': '', 'o': ''}}, {{'c': 0, 'a': '', 'o': ''}}),
c AS (SELECT conv_id, row_number() OVER () AS cid FROM (SELECT DISTINCT conv_id FROM conversations)),
s(cid, i, b0, b1, b2, b3) AS (SELECT cid, CAST(0 AS BIGINT), z, x, x, x FROM c, none
  UNION ALL SELECT cid, i, {_edit('b0', 'D', '2')}, {_row('b1', 's', ['b0'], None)},
    {_row('c2', 'u', ['b0', 'b1', 'c3'], _USER)}, {_row('c3', 'a', ['c2'], _ASSISTANT)}
  FROM (SELECT *, {_TO_A} AS c3 FROM (SELECT s.cid, w.i, b0, b1, b2, b3, role, text, r, gone, cut, {_TO_U} AS c2
    FROM s JOIN c USING (cid) JOIN w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = s.i + 1))),
e AS (SELECT cid, list_min([b0, {_TO_A}]) AS best FROM (SELECT *, {_TO_U} AS c2 FROM s
  QUALIFY row_number() OVER (PARTITION BY cid ORDER BY i DESC) = 1)),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (blank) AS blank, count(*) FILTER (gone AND NOT blank) AS duplicate, count(*) FILTER (cut) AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM w GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(best.c AS BIGINT) AS cost, best.a AS audit, sha256(substr(best.o, 2)) AS repaired_sha256
FROM c JOIN e USING (cid) LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id"""
