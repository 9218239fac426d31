"""SQL (DuckDB) for the operators whose results SQL can express, over whole tables.

It states each contract anew and shares no code with the operators but their fixed parameters.
"""

from __future__ import annotations

from kinsift.llm.edit_screen import RATE
from kinsift.llm.hash_tree import LEVELS, HashTree
from kinsift.llm.risk_rules import ALPHA, CUTOFFS, DELTA

_WORD = r"[^\x20\x09-\x0D]+"
_BYTES = "hex(encode(coalesce(text, '')))"

# --- op2: every 50-byte window, its smallest document, and the runs of windows that are not the first ---------

REPEATS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS o, {_BYTES} AS h, strlen({_BYTES}) // 2 AS n FROM documents),
chunk AS (SELECT r, o, c, substr(h, 2 * c + 1, 610) AS piece, least(256, n - 49 - c) AS k FROM (SELECT r, o, h, n, unnest(range(0, n - 49, 256)) AS c FROM d)),
win AS (SELECT r, o, c + i AS p, substr(piece, 2 * i + 1, 100) AS w FROM (SELECT r, o, c, piece, unnest(range(0, k)) AS i FROM chunk)),
first AS (SELECT w, min(o) AS f FROM win GROUP BY w HAVING min(o) < max(o)),
again AS (SELECT r, p, p - lag(p) OVER (PARTITION BY r ORDER BY p) AS gap FROM win JOIN first ON win.w = first.w WHERE o > f),
numbered AS (SELECT r, p, sum(CASE WHEN gap IS NULL OR gap > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS s FROM again),
span AS (SELECT r, min(p) AS a, max(p) + 50 AS b FROM numbered GROUP BY r, s),
cut AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS z FROM span),
kept AS (SELECT cut.r, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS rest FROM cut JOIN d ON d.r = cut.r GROUP BY cut.r)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM d LEFT JOIN kept ON kept.r = d.r
"""

# --- op4: straws by md5, the least at each level; CRC-32 byte by byte; slots in order of md5 and doc_id ---------


def _crc_table() -> list[int]:
    out = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


def _descent(tree: HashTree, name: str) -> str:
    """Tables of the nodes that each document reaches, level by level, and at last of its shard."""
    rows = ", ".join(f"('{p}', '{c}', {w}::DOUBLE)" for p, children in tree.children.items() for c, w in children)
    leaves = ", ".join(f"('{leaf}', {n})" for leaf, n in tree.shards.items())
    out = [f"{name}_tree(parent, child, weight) AS (VALUES {rows})", f"{name}_leaf(node, shard) AS (VALUES {leaves})", f"{name}_0 AS (SELECT r, k, 'root' AS node FROM d)"]
    for level in range(LEVELS):
        straw = "-ln((('0x' || substr(md5(child || ':' || k), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0) / weight"
        out.append(f"{name}_{level + 1} AS (SELECT r, any_value(k) AS k, arg_min(child, {straw}) AS node FROM {name}_{level} JOIN {name}_tree ON parent = node GROUP BY r)")
    return ", ".join(out)


def _shards(n: int) -> str:
    tree = HashTree.build(n)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id::VARCHAR, 'null') AS k, {_BYTES} AS h FROM documents),
{_descent(tree, 'now')}, {_descent(tree.grown(), 'then')},
crc AS (SELECT r, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT)), lambda c, b: xor(c >> 8, {_crc_table()}[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32 FROM d),
t AS (SELECT d.doc_id, d.k, strlen(h) // 2 + 16 AS size, text_crc32, a.shard, b.shard AS grown_shard FROM d JOIN crc ON crc.r = d.r
JOIN now_{LEVELS} ON now_{LEVELS}.r = d.r JOIN now_leaf a ON a.node = now_{LEVELS}.node JOIN then_{LEVELS} ON then_{LEVELS}.r = d.r JOIN then_leaf b ON b.node = then_{LEVELS}.node)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INT AS shard, row_number() OVER (PARTITION BY shard ORDER BY substr(md5(k), 1, 3), doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard::INT AS grown_shard FROM t
"""


SHARDS = _shards(40)

# --- op5: all pairs of documents that share a shingle, and what is reachable ------------------------------------

COMPONENTS = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
s AS (SELECT DISTINCT r, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) AS i FROM d)),
size AS (SELECT r, count(*) AS n FROM s GROUP BY r),
edge AS (SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.r <> y.r GROUP BY x.r, y.r) p JOIN size i ON i.r = a JOIN size j ON j.r = b WHERE 100 * k >= 85 * (i.n + j.n - k)),
reach(a, b) AS (SELECT r, r FROM d UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b),
least AS (SELECT a, min(doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM d JOIN least ON least.a = d.r LEFT JOIN size ON size.r = d.r
"""

# --- op8: counts, exact binomial tails of the cutoffs, and verdicts ---------------------------------------------

_RULES = ", ".join(f"('{rule}', {i}, {c}::DOUBLE)" for rule, cutoffs in CUTOFFS.items() for i, c in enumerate(cutoffs))
_RATE = ALPHA / len(CUTOFFS)

RULES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
words AS (SELECT r, regexp_extract_all(t, '{_WORD}') AS ws FROM d),
tri AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM words)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS k FROM tri) WHERE k > 1),
cov AS (SELECT r, count(DISTINCT i + o) AS n FROM rep, (VALUES (0), (1), (2)) v(o) GROUP BY r),
m AS (SELECT d.r, doc_id, lang, len(ws) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
  list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS ls, coalesce(cov.n, 0) AS n_repeat_words, len(regexp_extract_all(t, '[A-Z]')) AS caps, len(regexp_extract_all(t, '[A-Za-z]')) AS letters
  FROM d JOIN words ON words.r = d.r LEFT JOIN cov ON cov.r = d.r),
c AS (SELECT r, doc_id, lang, n_words, word_chars, n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  n_symbols / greatest(word_chars, 1) AS symbol_ratio, (len(ls) - len(list_distinct(ls))) / greatest(len(ls), 1) AS dup_line_ratio, n_repeat_words / greatest(n_words, 1) AS repeat_ratio, caps / greatest(letters, 1) AS capital_ratio FROM m),
long AS (SELECT r, doc_id, lang, base_failed, unnest(['symbol_ratio', 'dup_line_ratio', 'repeat_ratio', 'capital_ratio']) AS rule, unnest([symbol_ratio, dup_line_ratio, repeat_ratio, capital_ratio]) AS x FROM c),
good AS (SELECT long.* FROM long JOIN (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY 1) l ON l.doc_id = long.doc_id WHERE l.quality = 1 AND NOT base_failed),
rules(rule, i, cutoff) AS (VALUES {_RULES}),
n AS (SELECT lang, good.rule, i, any_value(cutoff) AS cutoff, count(*) AS good, count(*) FILTER (x >= cutoff) AS bad FROM good JOIN rules ON rules.rule = good.rule GROUP BY lang, good.rule, i),
strata AS (SELECT count(*) AS k FROM (SELECT DISTINCT lang FROM n)),
tail AS (SELECT lang, rule, i, any_value(cutoff) AS cutoff, any_value(bad) > {_RATE} * any_value(good) OR sum(exp(lgamma(good + 1) - lgamma(j + 1) - lgamma(good - j + 1) + j * ln({_RATE}) + (good - j) * ln(1 - {_RATE}))) > {DELTA} / ((SELECT k FROM strata) * {len(CUTOFFS)}) AS failed
  FROM (SELECT *, unnest(range(0, bad + 1)) AS j FROM n) GROUP BY lang, rule, i),
walk AS (SELECT *, bool_or(failed) OVER (PARTITION BY lang, rule ORDER BY i) AS stopped FROM tail),
chosen AS (SELECT lang, rule, min(cutoff) AS cutoff FROM walk WHERE NOT stopped GROUP BY lang, rule),
rejected AS (SELECT DISTINCT r FROM long JOIN chosen ON chosen.rule = long.rule AND chosen.lang IS NOT DISTINCT FROM long.lang WHERE x >= cutoff)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND rejected.r IS NULL AS kept
FROM c LEFT JOIN rejected ON rejected.r = c.r
"""

# --- op6: every part of a document as long as an item, give or take its edits; words as letters of the item's own ---

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

#: A document's words that an item hasn't are one letter, and DuckDB's distance counts bytes; so items may have 90 different words.
CONTAMINATED = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, w, list_sort(list_distinct(w)) AS own, len(w) AS m, floor({RATE}::DOUBLE * len(w))::BIGINT AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL) WHERE len(w) > 0),
dw AS (SELECT DISTINCT r, unnest(w) AS x FROM d), iw AS (SELECT item_id, unnest(own) AS x FROM i),
likely AS (SELECT near.r, i.item_id, i.m, i.k, array_to_string(list_transform(i.w, lambda x: chr(33 + list_position(i.own, x)::INT)), '') AS a, array_to_string(list_transform(d.w, lambda x: CASE WHEN list_contains(i.own, x) THEN chr(33 + list_position(i.own, x)::INT) ELSE '!' END), '') AS b
  FROM (SELECT r, iw.item_id, count(*) AS n FROM dw JOIN iw ON iw.x = dw.x GROUP BY 1, 2) near JOIN i ON i.item_id = near.item_id AND n >= len(own) - k JOIN d ON d.r = near.r),
part AS (SELECT r, item_id, k, a, b, pos, unnest(range(greatest(m - k, 1), m + k + 1)) AS n FROM (SELECT *, unnest(range(1, length(b) + 1)) AS pos FROM likely) WHERE substr(b, pos, 1) <> '!'),
hit AS (SELECT DISTINCT r, item_id FROM part WHERE levenshtein(a, substr(b, pos, n)) <= k),
found AS (SELECT r, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS ids FROM hit GROUP BY r)
SELECT doc_id, found.r IS NOT NULL AS contaminated, coalesce(n, 0)::BIGINT AS n_items, coalesce(ids, '') AS item_ids FROM d LEFT JOIN found ON found.r = d.r
"""

ORACLE_SQL = {"op6_edit_screen": CONTAMINATED, "op2_parsed_repeats": REPEATS, "op4_hash_tree": SHARDS, "op5_near_forest": COMPONENTS, "op8_risk_rules": RULES}
