"""SQL of the manifest, the ranked search and the search for personal data, for a second engine."""

from __future__ import annotations

import string

from riskspark.llm import pii
from riskspark.llm.lexical import Search
from riskspark.llm.merkle import Manifest

_LOWER = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"


def crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text, bit by bit."""
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda s: CAST(ascii(s) AS BIGINT))), lambda c, b: {bits}), 4294967295)"


def manifest(rule: Manifest = Manifest()) -> str:
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    fan = rule.fan
    return f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS tree, {leaf('text')} AS leaf,
    CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {leaf(f'translate(text, {_LOWER})')} END AS changed FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS LAST, leaf, changed NULLS LAST) - 1 AS place,
    count(*) OVER (PARTITION BY tree) AS total FROM leaves),
nodes AS (
  SELECT tree, 0 AS level, place, total, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, level + 1, place // {fan}, (total + {fan - 1}) // {fan}, sha256(string_agg(digest, '' ORDER BY place))
  FROM nodes WHERE total > 1 GROUP BY tree, level, place // {fan}, total),
tops AS (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS total FROM nodes WHERE total = 1),
roots AS (
  SELECT 0 AS level, place, total, digest FROM tops
  UNION ALL
  SELECT level + 1, place // {fan}, (total + {fan - 1}) // {fan}, sha256(string_agg(digest, '' ORDER BY place))
  FROM roots WHERE total > 1 GROUP BY level, place // {fan}, total),
fold AS (
  SELECT rid, tree, 0 AS level, place, total, coalesce(changed, leaf) AS now, '' AS proof FROM placed
  UNION ALL
  SELECT f.rid, f.tree, f.level + 1, f.place // {fan}, (f.total + {fan - 1}) // {fan},
    sha256(string_agg(CASE WHEN n.place = f.place THEN f.now ELSE n.digest END, '' ORDER BY n.place)),
    f.proof || coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place <> f.place), '')
  FROM fold f JOIN nodes n ON n.tree = f.tree AND n.level = f.level AND n.place // {fan} = f.place // {fan} AND f.total > 1
  GROUP BY f.rid, f.tree, f.level, f.place, f.total, f.now, f.proof),
rise AS (
  SELECT f.rid, t.digest AS subroot, 0 AS level, t.place, t.total, f.now, f.proof FROM fold f JOIN tops t ON t.tree = f.tree AND f.total = 1
  UNION ALL
  SELECT f.rid, f.subroot, f.level + 1, f.place // {fan}, (f.total + {fan - 1}) // {fan},
    sha256(string_agg(CASE WHEN n.place = f.place THEN f.now ELSE n.digest END, '' ORDER BY n.place)),
    f.proof || coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place <> f.place), '')
  FROM rise f JOIN roots n ON n.level = f.level AND n.place // {fan} = f.place // {fan} AND f.total > 1
  GROUP BY f.rid, f.subroot, f.level, f.place, f.total, f.now, f.proof)
SELECT p.doc_id, p.leaf, r.subroot, w.digest AS root, sha256(r.proof) AS proof_sha256, r.now AS folded_root, r.now = w.digest AS verified
FROM placed p JOIN rise r ON r.rid = p.rid AND r.total = 1 JOIN roots w ON w.total = 1"""


def ranked_search(rule: Search = Search()) -> str:
    terms = rf"regexp_extract_all(translate(text, {_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, {terms} AS words FROM documents),
docs AS (SELECT *, CAST(len(words) AS BIGINT) AS n FROM texts WHERE len(words) > 0),
whole AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM docs),
freq AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, n, unnest(words) AS term FROM docs) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * max(documents) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM freq, whole GROUP BY term),
items AS (SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, unnest({terms}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
scored AS (
  SELECT item_id, rid, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * documents) // length)))) AS BIGINT) AS score
  FROM items JOIN weights USING (term) JOIN freq USING (term), whole GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0) WHERE rank <= {rule.best}"""


def personal_data() -> str:
    cues = "|".join(c for cue in pii.CUES for c in (cue, cue.lower(), cue.upper()))
    patterns = {
        "email": rf"[A-Za-z0-9._%+-]+@{pii.DOMAIN}",
        "ip": pii.NUMBERS,
        "card": pii.CARD,
        "phone": pii.PHONE,
        "url": rf"\b(?:[Hh][Tt][Tt][Pp][Ss]?|[Ff][Tt][Pp]){pii.ADDRESS}",
        "account": rf"\b(?:{cues}){pii.ACCOUNT}",
    }
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    cut = " UNION ALL ".join(
        f"SELECT rid, {k} AS k, {quoted(kind)} AS kind, regexp_extract_all(text, {quoted(p)}) AS found, string_split_regex(text, {quoted(p)}) AS gaps FROM texts"
        for k, (kind, p) in enumerate(patterns.items())
    )
    digits = "regexp_replace(s, '[^0-9]', '', 'g')"
    doubled = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST({digits}[-i] AS INT) ELSE (2 * CAST({digits}[-i] AS INT)) // 10 + (2 * CAST({digits}[-i] AS INT)) % 10 END))"
    tail = f"regexp_extract(s, {quoted('(?:' + cues + ')' + pii.ACCOUNT)}, 1)"
    packed = "replace(tail, ' ', '')"
    value = "CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END"
    iban = f"""list_reduce(list_prepend(0, list_transform(string_split({packed}[5:] || {packed}[1:4], ''), lambda c: {value})),
        lambda x, y: (x * CASE WHEN y > 9 THEN 100 ELSE 10 END + y) % 97) = 1"""
    names = lambda kinds: ", ".join(map(quoted, kinds))
    line = "kind || ':' || CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(stop AS BIGINT) AS VARCHAR)"
    return f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
cut AS ({cut}),
each AS (SELECT rid, k, kind, unnest(found) AS s, unnest(gaps[1:len(found)]) AS gap, unnest(gaps[2:]) AS after, unnest(range(1, len(found) + 1)) AS i FROM cut WHERE len(found) > 0),
placed AS (SELECT *, sum(length(gap) + length(s)) OVER (PARTITION BY rid, k ORDER BY i) AS stop, CASE WHEN kind = 'account' THEN {tail} ELSE s END AS tail FROM each),
spans AS (
  SELECT rid, k, kind, stop - length(tail) AS start, stop FROM placed WHERE CASE kind
    WHEN 'ip' THEN len(list_filter(string_split(s, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(TRY_CAST(ltrim(x, '0') AS INT), 0) > 255)) = 0
    WHEN 'card' THEN length({digits}) BETWEEN 16 AND 19 AND {doubled} % 10 = 0
    WHEN 'phone' THEN length({digits}) BETWEEN 8 AND 15
    WHEN 'account' THEN NOT regexp_matches(after, '^[A-Za-z0-9_]') AND (tail[1] BETWEEN '0' AND '9' OR {iban})
    ELSE true END),
lines AS (
  SELECT rid, {', '.join(f"count(*) FILTER (kind = {quoted(b)}) AS n_{b}" for b in pii.BASE)},
    string_agg({line}, ',' ORDER BY k, start) FILTER (kind IN ({names(pii.BASE)})) AS base, string_agg({line}, ',' ORDER BY k, start) AS spans
  FROM spans GROUP BY rid)
SELECT doc_id, {', '.join(f"coalesce(n_{b}, 0) AS n_{b}" for b in pii.BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN lines USING (rid)"""
