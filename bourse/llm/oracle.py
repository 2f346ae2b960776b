"""DuckDB SQL for the registered queries that SQL can express.

Written independently of the Spark code: words, lines and three-word windows
as rows, counted and joined back. Only thresholds, word list and languages
come from the rules' table.
"""

from __future__ import annotations

from bourse.llm.quality import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS, Rule


def _passes(rule: Rule) -> str:
    parts = []
    if rule.least is not None:
        parts.append(f"{rule.over} >= CAST({rule.least} AS DOUBLE) * {rule.under}")
    if rule.most is not None:
        parts.append(f"{rule.over} <= CAST({rule.most} AS DOUBLE) * {rule.under}")
    ok = f"({' AND '.join(parts)})"
    if rule.languages is not None:
        known = ", ".join(f"'{x}'" for x in rule.languages)
        ok = f"({ok} OR coalesce(lang NOT IN ({known}), true))"
    return ok


_STOP = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))

QUALITY_RULES = rf"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT rid, doc_id, lang, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM t),
windows AS (
  SELECT rid, k, ws[k] AS a, ws[k + 1] AS b, ws[k + 2] AS c
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS k FROM w WHERE len(ws) >= 3)),
twice AS (
  SELECT rid, a, b, c FROM windows GROUP BY rid, a, b, c HAVING count(*) > 1),
covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest([k, k + 1, k + 2]) AS p FROM windows JOIN twice USING (rid, a, b, c))
  GROUP BY rid),
m AS (
  SELECT doc_id, lang, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words, len(ls) AS n_lines,
         coalesce(list_sum(list_transform(ls, lambda x: length(x))), 0) AS line_chars,
         coalesce(list_sum(list_transform(ls, lambda x: length(x))), 0)
           - coalesce(list_sum(list_transform(list_distinct(ls), lambda x: length(x))), 0) AS dup_line_chars,
         len(list_filter(ls, lambda x: left(ltrim(x, ' '), 2) IN ('- ', '* ', '• '))) AS n_bullet_lines,
         len(list_filter(ls, lambda x: rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…')) AS n_ellipsis_lines,
         len(list_filter(ws, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words
  FROM w LEFT JOIN covered USING (rid)),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
         {", ".join(f"{_passes(r)} AS {r.name}_ok" for r in RULES)}
  FROM m)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(f"{r.name}_ok" for r in RULES)} AS kept,
       {", ".join(f"{r.name}_ok" for r in RULES)}
FROM judged"""

ORACLE: dict[str, str] = {"op9_quality_rules": QUALITY_RULES}


def _crc32(s: str) -> str:
    """CRC-32 of a string of ASCII characters: for each one an exclusive or
    (entries from 1000 on), then eight shifts (entries -1)."""
    shifts = ", ".join(["-1"] * 8)
    return (f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(range(1, length({s}) + 1), "
            f"lambda i: [CAST(1000 + ascii(substr({s}, CAST(i AS INTEGER), 1)) AS BIGINT), {shifts}]))), "
            "lambda x, y: CASE WHEN y >= 1000 THEN xor(x, y - 1000) "
            "ELSE xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END) END), 4294967295)")


# Conversations as lists of turn digests; a node is a digest of a list's
# first entries, its ancestors those of fewer.
PREFIX_TRIE = rf"""
WITH ids AS (
  SELECT c, {_crc32("CAST(c AS VARCHAR)")} % 4 AS h
  FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL)),
turns AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS place FROM turns),
opening AS (
  SELECT ids.c, own.place, own.role, own.text FROM ids JOIN own ON own.c = ids.c - ids.c % 20 AND own.place <= ids.h),
lead AS (
  SELECT ids.c, ids.h, count(opening.place) AS n FROM ids LEFT JOIN opening ON ids.c = opening.c GROUP BY ids.c, ids.h),
rebuilt AS (
  SELECT c, place, role, text FROM opening
  UNION ALL SELECT own.c, own.place - lead.h + lead.n, role, text FROM own JOIN lead ON own.c = lead.c WHERE own.place > lead.h),
paths AS (
  SELECT ids.c, coalesce(list(md5(role) || md5(text) ORDER BY place) FILTER (WHERE place IS NOT NULL), []) AS p,
         list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY place) FILTER (WHERE place IS NOT NULL) AS words
  FROM ids LEFT JOIN rebuilt ON ids.c = rebuilt.c GROUP BY ids.c),
steps AS (
  SELECT c, p, d, md5(array_to_string(p[1:d], '')) AS node, CASE WHEN d > 0 THEN md5(array_to_string(p[1:d - 1], '')) END AS parent,
         CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words, d = len(p) AS last
  FROM (SELECT c, p, words, unnest(range(0, len(p) + 1)) AS d FROM paths)),
nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, max(words) AS words,
         arg_min(p, c) AS p, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE last) AS ends
  FROM steps GROUP BY node),
children AS (SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
above AS (
  SELECT md5(array_to_string(p[1:j], '')) AS up, n_convs, words, leaf
  FROM (SELECT nodes.*, children.n IS NULL AS leaf, unnest(range(0, depth + 1)) AS j
        FROM nodes LEFT JOIN children ON nodes.node = children.parent)),
totals AS (
  SELECT up, count(*) FILTER (WHERE leaf) AS n_leaves, sum((n_convs - 1) * words) AS saved FROM above GROUP BY up)
SELECT nodes.conv_id, nodes.depth, parents.conv_id AS parent_conv_id, nodes.n_convs, coalesce(children.n, 0) AS n_children,
       totals.n_leaves, CAST(totals.saved AS BIGINT) AS saved_tokens, sha256(coalesce(nodes.ends, '')) AS ends_sha256
FROM nodes LEFT JOIN nodes parents ON nodes.parent = parents.node LEFT JOIN children ON nodes.node = children.parent
JOIN totals ON nodes.node = totals.up"""

ORACLE["op13_prefix_trie"] = PREFIX_TRIE

# Sets of shingles, each different one once; the pairs that share a shingle
# counted; what is linked, followed to its end.
MINHASH_DEDUP = r"""
WITH RECURSIVE t AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS shingles FROM t),
keyed AS (SELECT *, len(shingles) AS n, md5(array_to_string(shingles, chr(10))) AS key FROM s),
nodes AS (SELECT key, any_value(shingles) AS shingles, any_value(n) AS n, min(doc_id) AS low FROM keyed WHERE n > 0 GROUP BY key),
each AS (SELECT key, n, unnest(shingles) AS x FROM nodes),
pairs AS (
  SELECT a.key AS ak, b.key AS bk FROM each a JOIN each b ON a.x = b.x AND a.key < b.key
  GROUP BY a.key, b.key, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
links AS (SELECT ak AS x, bk AS y FROM pairs UNION ALL SELECT bk, ak FROM pairs),
reach AS (
  SELECT key, key AS seen FROM nodes
  UNION SELECT reach.key, links.y FROM reach JOIN links ON reach.seen = links.x),
classes AS (SELECT reach.key, min(nodes.low) AS low FROM reach JOIN nodes ON reach.seen = nodes.key GROUP BY reach.key),
named AS (
  SELECT doc_id, n AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE low END AS component_id
  FROM keyed LEFT JOIN classes ON keyed.key = classes.key AND n > 0)
SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM named"""

ORACLE["op1_minhash_dedup"] = MINHASH_DEDUP
