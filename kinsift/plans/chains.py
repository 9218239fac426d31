"""SQL (DuckDB) of the normalization chains, one column a step.

It states the rules anew for texts in Latin letters; only fixed values are shared with the rules.  DuckDB's
regular expressions have no look-around and no back-references, so borders are captured and put back (twice,
as neighbours share a border), and repeated words are found in a list of words and what is between them.
"""

from __future__ import annotations

import unicodedata

from kinsift.functions import rules

W, NOT_W = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"


def nfkd(c: str) -> str:
    """Latin letters with marks, each replaced by its parts."""
    for ch in map(chr, range(0xA0, 0x250)):
        parts = unicodedata.normalize("NFKD", ch)
        if parts != ch:
            c = f"replace({c}, '{ch}', '{parts}')"
    return c


def bordered(c: str, word: str, by: str) -> str:
    """The word, where no word character is beside it, replaced."""
    for _ in range(2):
        c = f"regexp_replace({c}, '(^|{NOT_W}){word}($|{NOT_W})', '\\1{by}\\2', 'gi')"
    return c


def parenthesised(c: str) -> str:
    for word in rules.PAREN_SUFFIXES:
        c = f"regexp_replace({c}, '\\s*\\({word}\\)\\s*', ' {rules.CANONICAL.get(word, word)}', 'gi')"
    return c


def legal_suffix(c: str) -> str:
    forms = sorted(rules.CANONICAL, key=lambda k: (-len(k), k))
    pattern = "(?i)(^|" + NOT_W + ")(" + "|".join(f.replace(".", "\\.") for f in forms) + ")\\s*$"
    cases = " ".join(f"WHEN '{f}' THEN '{rules.CANONICAL.get(f.rstrip('.'), rules.CANONICAL[f])}'" for f in forms)
    return f"CASE WHEN regexp_matches({c}, '{pattern}') THEN regexp_replace({c}, '{pattern}', '\\1') || CASE lower(regexp_extract({c}, '{pattern}', 2)) {cases} END ELSE {c} END"


def urls(c: str) -> str:
    whole = r"(?i)^(?:https?://)?(?:www\.)?([a-z0-9][a-z0-9\-]*)\.(?:com|net|org|co\.in|in|io|biz)\s*$"
    part = r"(?i)\s*\|?\s*(?:https?://\S+|www\.\S+|\S+\.com\b|\S+\.net\b|\S+\.org\b|\S+\.co\.in\b|\S+\.in\b)"
    return f"CASE WHEN regexp_matches(trim({c}), '{whole}') THEN regexp_extract(trim({c}), '{whole}', 1) ELSE trim(regexp_replace({c}, '{part}', '', 'g')) END"


def words_and_gaps(c: str) -> str:
    return f"regexp_extract_all({c}, '{W}+|{NOT_W}+')"


def repeated(tokens: str, i: str, word: str = W + "{3,}") -> str:
    """Whether token i is a word that follows itself."""
    return f"({i} > 2 AND lower({tokens}[{i}]) = lower({tokens}[{i} - 2]) AND regexp_full_match({tokens}[{i}], '{word}') AND regexp_full_match({tokens}[{i} - 1], '\\s+'))"


def duplicate_words(c: str) -> str:
    """Of a run of one word, every eighth stays: three passes halve it three times."""
    gone = lambda i: f"(coalesce(d[{i}], false) AND ({i} - list_max(list_filter(range({i}, 0, -2), lambda j: NOT d[j]))) % 16 <> 0)"
    body = f"array_to_string(list_filter(t, lambda x, i: NOT {gone('i')} AND NOT {gone('(i + 1)')}), '')"
    repeats = f"list_transform(range(1, len(t) + 1), lambda i: coalesce({repeated('t', 'i')}, false))"
    return f"list_transform([{words_and_gaps(c)}], lambda t: list_transform([{repeats}], lambda d: {body})[1])[1]"


def whitespace(c: str) -> str:
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


def po_box(c: str) -> str:
    return f"trim(regexp_replace({c}, '(?i)\\b(?:p\\.?\\s*o\\.?\\s*box|po\\s*box|post\\s*office\\s*box)\\s*[#\\d]*\\b', '', 'g'))"


def abbreviations(c: str) -> str:
    for short, long in rules.ABBREVIATIONS.items():
        c = bordered(c, short, long)
    return c


def leetspeak(c: str) -> str:
    return f"regexp_matches({c}, '(?i)[05][a-z]|[a-z][05]|[1il][a-z]|(^|{NOT_W})[0-9]+[a-z]+[0-9]+($|{NOT_W})')"


PLACES = "|".join(rules.PAREN_PLACES)
#: Name rules in order, each from the text before it.
NAME_STEPS = {
    "nfkd_normalize": nfkd,
    "lowercase": lambda c: f"lower({c})",
    "strip_ms_prefix": lambda c: f"regexp_replace({c}, '(?i)^m/s\\s+', '')",
    "strip_hashtag_prefix": lambda c: f"regexp_replace({c}, '^[#<]+\\s*', '')",
    "strip_angle_brackets": lambda c: f"regexp_replace({c}, '<<|>>', '', 'g')",
    "strip_email": lambda c: f"trim(regexp_replace({c}, '(?i)\\b[a-z0-9._%+\\-]+@[a-z0-9.\\-]+\\.[a-z]{{2,}}\\b', '', 'g'))",
    "strip_pipe_fragments": lambda c: f"regexp_replace({c}, '\\s*\\|.*$', '')",
    "strip_urls": urls,
    "strip_appended_digits": lambda c: f"regexp_replace({c}, '\\s*[-–]\\s*\\d{{6,}}\\s*$|#\\d{{5,}}\\s*$', '')",
    "strip_parenthetical_suffix": parenthesised,
    "strip_geo_parenthetical": lambda c: f"trim(regexp_replace({c}, '(?i)\\s*\\(\\s*(?:{PLACES})\\s*\\)\\s*', ' ', 'g'))",
    "normalize_legal_suffix": legal_suffix,
    "normalize_ampersand": lambda c: f"replace({c}, '&', ' and ')",
    "collapse_duplicate_words": duplicate_words,
}
ADDRESS_STEPS = {
    "nfkd_normalize": nfkd,
    "lowercase": lambda c: f"lower({c})",
    "remove_null_literals": lambda c: bordered(c, "null", ""),
    "strip_po_box": po_box,
    "expand_address_abbrev": abbreviations,
    "collapse_whitespace": whitespace,
}
_DBA = r"(?is)^(.*?)\s+d/?b/?a\s+(.*)$"


def steps(table: str, name: str, source: str, chain: dict, off: tuple[str, ...] = ()) -> tuple[str, str, list[tuple[str, str, str]]]:
    """CTEs that add a column a step; the last table and column are ``name`` and ``{name}_t``; (rule, before, after) of each."""
    on = [(rule, f) for rule, f in chain.items() if rule not in off]
    ctes, at, marks = [f"{name}0 AS (SELECT *, {source} AS {name}_0 FROM {table})"], f"{name}_0", []
    for k, (rule, f) in enumerate(on, 1):
        ctes.append(f"{name}{k} AS (SELECT *, {f(at)} AS {name}_{k} FROM {name}{k - 1})")
        marks.append((rule, at, f"{name}_{k}"))
        at = f"{name}_{k}"
    return ", ".join(ctes), at, marks


def names(off: tuple[str, ...] = (), prefix: str = "n") -> str:
    """CTEs from rec to ``{prefix}_done``: rec's columns and those of normalized names."""
    blank = "CASE WHEN trim(coalesce(business_name, '')) = '' THEN '' ELSE business_name END"
    chain, at, marks = steps("rec", f"{prefix}c", blank, NAME_STEPS, off)
    last = f"{prefix}c{len(marks)}"
    if "split_dba" in off:
        split = f"{prefix}_s AS (SELECT *, {at} AS legal, NULL::VARCHAR AS alias_name FROM {last})"
    else:
        split = f"{prefix}_s AS (SELECT *, CASE WHEN regexp_matches({at}, '{_DBA}') THEN trim(regexp_extract({at}, '{_DBA}', 1)) ELSE {at} END AS legal, CASE WHEN regexp_matches({at}, '{_DBA}') THEN trim(regexp_extract({at}, '{_DBA}', 2)) END AS alias_name FROM {last})"
    marks = [*marks, ("split_dba", "CASE WHEN alias_name IS NULL THEN '' END", "''"), ("collapse_whitespace", "legal", "clean"), ("strip_accent_noise", "bare", "clean")]
    alias, alias_at, _ = steps(f"{prefix}_w", f"{prefix}a", "alias_name", NAME_STEPS, off)
    fired = "concat_ws(',', " + ", ".join(f"CASE WHEN {a} IS DISTINCT FROM {b} THEN '{rule}' END" for rule, a, b in marks) + ")"
    marked, letter = "regexp_matches(clean, '[\\x{0300}-\\x{036F}]')", "regexp_matches(clean, '[^\\x00-\\x7F]') AND regexp_matches(regexp_replace(clean, '[\\x00-\\x7F]', '', 'g'), '\\p{L}')"
    return (
        f"{chain}, {split}, {prefix}_w AS (SELECT *, {whitespace('legal')} AS clean, strip_accents({whitespace('legal')}) AS bare FROM {prefix}_s), {alias}, "
        f"{prefix}_done AS (SELECT * EXCLUDE (alias_name), alias_name, clean AS name_clean, {whitespace('bare')} AS name_no_accent, {whitespace(alias_at)} AS alias_clean, {marked} AS has_non_latin, {leetspeak('clean')} AS has_leetspeak, "
        f"concat_ws(',', CASE WHEN {marked} THEN 'COMBINING' END, CASE WHEN {letter} THEN 'LATIN' END) AS scripts_detected, {fired} AS name_rules_fired FROM {prefix}a{len(NAME_STEPS) - len([r for r in NAME_STEPS if r in off])})"
    )


def addresses(table: str = "rec", prefix: str = "d") -> str:
    """CTEs from a table to ``{prefix}_done`` with the columns of normalized addresses."""
    blank = "CASE WHEN trim(coalesce(business_address, '')) = '' THEN '' ELSE business_address END"
    chain, at, marks = steps(table, f"{prefix}c", blank, ADDRESS_STEPS)
    fired = "concat_ws(',', " + ", ".join(f"CASE WHEN {a} IS DISTINCT FROM {b} THEN '{rule}' END" for rule, a, b in marks) + ")"
    return f"{chain}, {prefix}_done AS (SELECT *, {at} AS addr_clean, {whitespace(f'strip_accents({at})')} AS addr_no_accent, {at} <> '' AS has_addr, {fired} AS addr_rules_fired FROM {prefix}c{len(marks)})"
