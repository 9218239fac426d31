"""Profiling: distributions, noise patterns, scripts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinsift.functions import scripts, text
from kinsift.sources.tables import scan_patterns

# Noise patterns of names and of addresses.
NAME_NOISE = {
    "hashtag_prefix": r"^[#<\s]+",
    "appended_digits": r"[-\s]\d{6,}\s*$|#\d{5,}\s*$",
    "url_in_name": r"www\.|\.(com|net|org|in|co\.in)|https?://|@\w+",
    "duplicate_adj_word": r"(?i)\b(\w{3,})\s+\1\b",
    "extra_whitespace": r"\s{2,}",
    "null_literal": r"(?i)\bnull\b",
    "angle_brackets": "<<|>>",
    "all_caps_word": r"\b[A-Z]{4,}\b",
    "dba_alias": r"(?i)\bdba\b",
    "parenthetical_sfx": r"(?i)\((?:LLC|LLP|Inc|Corp|Co|Ltd|Limited|Pvt|Private)\)",
    "accent_anomaly": "[À-ÿ]",
    "pipe_separator": r"\|",
    "leetspeak_digit": r"\d[a-zA-Z]|[a-zA-Z]\d",
}
ADDRESS_NOISE = {
    "null_literal": r"(?i)\bnull\b",
    "po_box": r"(?i)\bP\.?O\.?\s*Box\b",
    "all_caps": r"^[A-Z0-9\s,\.#-]+$",
    "reordered_addr": "^[A-Z]{2},",
    "empty": r"^\s*$",
    "non_latin_chars": r"[^\x00-\x7f]",
}
# Fixed value: pattern of odd tokens.
ANOMALOUS = r"[^\w\s]{2,}|\d+[a-z]+|[a-z]+\d+|\w*[^\w\s]+\w+"


def value_counts(rows: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """(column, n), the most frequent first."""
    rows = rows.filter(F.col(column).isNotNull()) if dropna else rows
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def missing_rates(rows: DataFrame, column: str, by: str) -> DataFrame:
    """(by, n_missing, n, rate) of null or empty values."""
    gone = (F.col(column).isNull() | (F.trim(column) == "")).cast("int")
    return rows.groupBy(by).agg(F.sum(gone).alias("n_missing"), F.count("*").alias("n"), F.round(F.avg(gone), 6).alias("rate"))


def top_tokens(rows: DataFrame, column: str, n: int = 30) -> DataFrame:
    """The n most frequent words, with their counts."""
    return rows.select(F.explode(text.words(F.col(column))).alias("token")).groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(n)


def vocabulary_size(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(F.explode(text.words(F.col(column))).alias("token")).agg(F.count_distinct("token").alias("n_tokens"))


def suffix_distribution(rows: DataFrame, column: str, id_column: str, n_examples: int = 5) -> DataFrame:
    """(suffix, n, examples): legal suffixes and the ids of the first few names with each."""
    found = rows.select(F.col(id_column).alias("id"), text.legal_suffix(F.col(column)).alias("suffix")).filter("suffix is not null")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("suffix").orderBy("id")))
    return ranked.groupBy("suffix").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("rank") <= n_examples, F.col("id")))), ",").alias("examples"))


def noise_scan(rows: DataFrame, column: str, patterns: dict[str, str]) -> DataFrame:
    """(pattern, n, pct, total) in one pass."""
    return scan_patterns(rows.filter(F.col(column).isNotNull()), column, patterns)


def anomalous_tokens(rows: DataFrame, column: str, share: float = 0.005) -> DataFrame:
    """(token, n) of odd tokens with more occurrences than the share of rows."""
    found = rows.select(F.explode(F.regexp_extract_all(F.lower(column), F.lit(ANOMALOUS), F.lit(0))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    total = rows.agg((F.count("*") * share).alias("_least"))
    return found.crossJoin(F.broadcast(total)).filter(F.col("n") > F.col("_least")).drop("_least")  # one row


def script_inventory(rows: DataFrame, column: str, n_samples: int = 8) -> DataFrame:
    """(script, n_chars, samples) of the distinct characters beyond ASCII."""
    chars = rows.select(F.explode(F.split(F.coalesce(column, F.lit("")), "")).alias("ch")).filter(r"ch rlike '[^\\x00-\\x7f]'").distinct()

    @F.pandas_udf(T.StringType())
    def family(ch: pd.Series) -> pd.Series:
        import unicodedata

        return ch.map(lambda c: unicodedata.name(c, "UNKNOWN").split(" ")[0])

    named = chars.withColumn("script", family("ch")).withColumn("rank", F.row_number().over(Window.partitionBy("script").orderBy("ch")))
    return named.groupBy("script").agg(F.count("*").alias("n_chars"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("rank") <= n_samples, F.col("ch")))), "").alias("samples"))


def scripts_per_record(rows: DataFrame, column: str) -> DataFrame:
    """(script, n): records with characters of a script; MIXED: with several."""
    found = rows.select(scripts.accents_and_scripts(F.col(column))["scripts"].alias("s"))
    each = found.select(F.explode("s").alias("script")).groupBy("script").agg(F.count("*").alias("n"))
    return each.unionByName(found.agg(F.count_if(F.size("s") > 1).alias("n")).select(F.lit("MIXED").alias("script"), "n"))


def cross_script_pairs(pairs: DataFrame, names: DataFrame, n: int = 10) -> DataFrame:
    """(s1_script, cand_script, n): the most frequent script sets of true pairs; none counts as LATIN."""
    known = names.select("id", F.array_join(scripts.accents_and_scripts(F.col("name"))["scripts"], "+").alias("s"))
    latin = lambda c: F.when(F.coalesce(c, F.lit("")) == "", F.lit("LATIN")).otherwise(c)
    left, right = known.select(F.col("id").alias("s1_id"), F.col("s").alias("a")), known.select(F.col("id").alias("cand_id"), F.col("s").alias("b"))
    joined = pairs.join(left, "s1_id", "left").join(right, "cand_id", "left")
    return joined.groupBy(latin(F.col("a")).alias("s1_script"), latin(F.col("b")).alias("cand_script")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "s1_script", "cand_script").limit(n)


def noise_catalog(scans: dict[str, DataFrame]) -> DataFrame:
    """(pattern, source, n, pct, priority) of scans by source, most urgent first."""
    out = None
    for source, scan in scans.items():
        one = scan.withColumn("source", F.lit(source))
        out = one if out is None else out.unionByName(one)
    priority = F.when(F.col("pct") >= 10, "HIGH").when(F.col("pct") >= 1, "MEDIUM").when(F.col("pct") >= 0.1, "LOW").otherwise("TRACE")
    rank = F.when(F.col("pct") >= 10, 0).when(F.col("pct") >= 1, 1).when(F.col("pct") >= 0.1, 2).otherwise(3)
    return out.filter("n > 0").select("pattern", "source", "n", "pct", priority.alias("priority")).orderBy(rank, F.desc("pct"), "pattern", "source")


def match_histogram(truth: DataFrame) -> DataFrame:
    """(n_matches, n) over entities."""
    return truth.groupBy(F.size("ids").cast("long").alias("n_matches")).agg(F.count("*").alias("n")).orderBy("n_matches")
