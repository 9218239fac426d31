"""Composite normalizers: a fold over toggleable rules that records which of them fired."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinsift import schema
from kinsift.functions import rules, scripts

# Expected share of names that a rule fires on, low and high.
FIRE_RATES = {
    "lowercase": (0.50, 0.95),
    "collapse_whitespace": (0.08, 0.18),
    "strip_accent_noise": (0.08, 0.20),
    "strip_urls": (0.025, 0.05),
    "collapse_duplicate_words": (0.014, 0.028),
    "strip_parenthetical_suffix": (0.009, 0.018),
    "strip_geo_parenthetical": (0.011, 0.021),
    "strip_appended_digits": (0.004, 0.009),
    "strip_hashtag_prefix": (0.002, 0.006),
    "split_dba": (0.000, 0.004),
    "strip_ms_prefix": (0.003, 0.010),
}
NAME_COLUMNS = ("name_clean", "name_no_accent", "alias_name", "alias_clean", "has_non_latin", "has_leetspeak", "scripts_detected", "name_rules_fired")
ADDRESS_COLUMNS = ("addr_clean", "addr_no_accent", "has_addr", "addr_rules_fired")


def enabled(toggles: Mapping[str, bool] | None, rule: str) -> bool:
    """Rules that toggles doesn't name are on."""
    return (toggles or {}).get(rule, True)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body uses it; the optimizer can't copy it in."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


SMALL = 1 << 30  # bytes


def spread(df: DataFrame) -> DataFrame:
    """A small table that would come in fewer partitions than there are cores, dealt to all of them.

    Rules cost far more than moving a row; large tables and streams stay as they are.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < min(SMALL, cores * (128 << 20)) else df


def _with(step: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """Appends the step's result on the last text."""
    return lambda texts: F.concat(texts, F.array(step(F.element_at(texts, -1))))


def fold(df: DataFrame, source: str, steps: Mapping[str, Callable[[Column], Column]], toggles: Mapping[str, bool] | None, prefix: str) -> tuple[DataFrame, str, list[Column]]:
    """Applies the steps that are on; returns the column of the last text and a name per fired rule.

    One column holds the texts after each step.  A step takes the text before it as a bound variable, and the
    column is generated, one row from each: in a chain of projections between functions in Python the
    optimizer would copy a rule's expression to every use of its result.
    """
    on = {rule: step for rule, step in steps.items() if enabled(toggles, rule)}
    if not on:
        return df, source, []
    texts = F.array(F.col(source))
    for step in on.values():
        texts = bound(texts, _with(step))
    after = [F.get(f"{prefix}s", F.lit(i)) for i in range(len(on) + 1)]
    fired = [F.when(~after[i + 1].eqNullSafe(after[i]), F.lit(rule)) for i, rule in enumerate(on)]
    return df.select("*", F.explode(F.array(texts)).alias(f"{prefix}s")).withColumn(f"{prefix}t", after[-1]), f"{prefix}t", fired


def _unicode_steps(df: DataFrame, source: str, toggles: Mapping[str, bool] | None, prefix: str) -> tuple[DataFrame, str, list[Column]]:
    """Encoding repair and NFKD; both in one pass through Python where both are on."""
    fix, decompose = enabled(toggles, "fix_encoding"), enabled(toggles, "nfkd_normalize")
    fired: list[Column] = []
    at = source
    if fix and decompose:
        df = df.withColumn(f"{prefix}u", scripts.unicode_forms(F.col(source)))
        df = df.withColumns({f"{prefix}fix": F.col(f"{prefix}u.fixed"), f"{prefix}nfkd": F.col(f"{prefix}u.nfkd")})
    elif fix:
        df = df.withColumn(f"{prefix}fix", scripts.fix_encoding(F.col(source)))
    elif decompose:
        df = df.withColumn(f"{prefix}nfkd", scripts.nfkd(F.col(source)))
    for on, name, rule in ((fix, "fix", "fix_encoding"), (decompose, "nfkd", "nfkd_normalize")):
        if on:
            fired.append(F.when(F.col(prefix + name) != F.col(at), F.lit(rule)))
            at = prefix + name
    return df, at, fired


def _joined(fired: list[Column]) -> Column:
    return F.array_join(F.array_compact(F.array(*fired)), ",") if fired else F.lit("")


def _name_chain(df: DataFrame, source: str, toggles: Mapping[str, bool] | None, prefix: str, split: bool, parity: bool) -> tuple[DataFrame, str, str | None, list[Column]]:
    """The rules up to white space; returns the columns of the text and of the alias."""
    steps = dict(rules.NAME_RULES) | {"strip_parenthetical_suffix": lambda c: rules.strip_parenthetical_suffix(c, parity)}
    df, at, fired = _unicode_steps(df, source, toggles, prefix)
    df, at, more = fold(df, at, steps, toggles, prefix)
    fired += more
    alias = None
    if split and enabled(toggles, "split_dba"):
        legal, other = rules.dba_parts(F.col(at))
        df = df.withColumns({f"{prefix}legal": legal, f"{prefix}alias": other})
        at, alias = f"{prefix}legal", f"{prefix}alias"
        fired.append(F.when(F.col(alias).isNotNull(), F.lit("split_dba")))
    df, at, more = fold(df, at, {"collapse_whitespace": rules.collapse_whitespace}, toggles, prefix + "w")
    return df, at, alias, fired + more


def normalize_names(df: DataFrame, column: str = schema.NAME, toggles: Mapping[str, bool] | None = None, parity: bool = True) -> DataFrame:
    """df with NAME_COLUMNS. A missing or blank name gives empty texts and false flags.

    parity=False mends known quirks: scripts ignore combining marks, digits decide leetspeak, and a
    parenthesised suffix keeps the space after it.
    """
    own = df.columns
    df = spread(df).withColumn("_raw", F.when(rules.strip(F.coalesce(F.col(column), F.lit(""))) == "", F.lit("")).otherwise(F.col(column)))
    df, text, alias, fired = _name_chain(df, "_raw", toggles, "_n", True, parity)
    df = df.withColumn("_accents", scripts.accents_and_scripts(F.col(text)))
    found = F.col("_accents.scripts") if parity else F.array_remove(F.col("_accents.scripts"), "COMBINING")
    bare = F.col("_accents.no_accent") if enabled(toggles, "strip_accent_noise") else F.col(text)
    out = {
        "name_clean": rules.collapse_whitespace(F.col(text)),
        "name_no_accent": rules.collapse_whitespace(bare),
        "alias_name": F.col(alias) if alias else F.lit(None).cast("string"),
        "has_non_latin": F.size(F.array_remove(found, "LATIN")) > 0,
        "has_leetspeak": rules.has_leetspeak(F.col(text), parity) if enabled(toggles, "flag_leetspeak") else F.lit(False),
        "scripts_detected": F.array_join(F.array_sort(found), ","),
        "name_rules_fired": _joined([*fired, F.when(bare != F.col(text), F.lit("strip_accent_noise"))]),
    }
    df = df.withColumns(out)
    if alias:
        df, cleaned, _, _ = _name_chain(df, "alias_name", toggles, "_a", False, parity)
        df = df.withColumn("alias_clean", rules.collapse_whitespace(F.col(cleaned)))
    else:
        df = df.withColumn("alias_clean", F.lit(None).cast("string"))
    return df.select(*[c for c in own if c not in NAME_COLUMNS], *NAME_COLUMNS)


def normalize_addresses(df: DataFrame, column: str = schema.ADDRESS, toggles: Mapping[str, bool] | None = None, dealt: bool = False) -> DataFrame:
    """df with ADDRESS_COLUMNS; without the column they are empty. dealt: a small df need not be spread any more."""
    own = [c for c in df.columns if c not in ADDRESS_COLUMNS]
    if column not in df.columns:
        return df.select(*own, F.lit("").alias("addr_clean"), F.lit("").alias("addr_no_accent"), F.lit(False).alias("has_addr"), F.lit("").alias("addr_rules_fired"))
    df = (df if dealt else spread(df)).withColumn("_raw", F.when(rules.strip(F.coalesce(F.col(column), F.lit(""))) == "", F.lit("")).otherwise(F.col(column)))
    df, at, fired = _unicode_steps(df, "_raw", toggles, "_d")
    df, at, more = fold(df, at, rules.ADDRESS_RULES, toggles, "_d")
    bare = scripts.accents_and_scripts(F.col(at))["no_accent"] if enabled(toggles, "strip_accent_noise") else F.col(at)
    df = df.withColumns({"_bare": bare, "addr_clean": rules.collapse_whitespace(F.col(at)), "addr_rules_fired": _joined(fired + more)})
    df = df.withColumns({"addr_no_accent": rules.collapse_whitespace(F.col("_bare")), "has_addr": F.col("addr_clean") != ""})
    return df.select(*own, *ADDRESS_COLUMNS)


def normalize(df: DataFrame, toggles: Mapping[str, bool] | None = None, parity: bool = True) -> DataFrame:
    """A source table with all derived columns; also works on a stream, as it keeps no state."""
    return normalize_addresses(normalize_names(df, toggles=toggles, parity=parity), toggles=toggles, dealt=True)


def fire_rates(normalized: DataFrame, column: str = "name_rules_fired") -> DataFrame:
    """(rule, n, rate) of the rules that fired on any row."""
    total = normalized.agg(F.count("*").alias("total"))
    fired = normalized.filter(F.col(column) != "").select(F.explode(F.split(column, ",")).alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))
    return fired.crossJoin(F.broadcast(total)).select("rule", "n", F.round(F.col("n") / F.col("total"), 6).alias("rate"))  # total is one row


def change_statistics(normalized: DataFrame, raw: str = schema.NAME) -> DataFrame:
    """One row: how many names changed beyond case, have other scripts, an alias, an address."""
    return normalized.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("name_clean") != F.lower(F.coalesce(F.col(raw), F.lit("")))).alias("n_changed"),
        F.count_if("has_non_latin").alias("n_non_latin"),
        F.count_if(F.col("alias_name").isNotNull()).alias("n_alias"),
        F.count_if("has_addr").alias("n_addr"),
    )


def changed_names(normalized: DataFrame, n: int = 10, raw: str = schema.NAME) -> DataFrame:
    """The first n names that changed, for a look."""
    return normalized.filter(F.col("name_clean") != F.lower(F.coalesce(F.col(raw), F.lit("")))).orderBy(schema.ID).limit(n)


def check_fire_rates(rates: DataFrame) -> DataFrame:
    """(rule, low, high, rate, within) for each rule with an expected range."""
    bounds = rates.sparkSession.createDataFrame([(r, lo, hi) for r, (lo, hi) in FIRE_RATES.items()], "rule string, low double, high double")
    rate = F.coalesce("rate", F.lit(0.0))
    return bounds.join(rates, "rule", "left").select("rule", "low", "high", rate.alias("rate"), rate.between(F.col("low"), F.col("high")).alias("within"))
