"""Tokens, shingles and n-grams as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinsift import schema

# Words that are no blocking keys.
STOPWORDS = (
    "llc", "ltd", "limited", "inc", "corp", "corporation", "pvt", "private", "llp", "lp", "co", "company", "sarl", "sci", "sas", "sa", "plc", "pllc",
    "gmbh", "ag", "pty", "ngo", "npo", "the", "and", "of", "for", "in", "on", "at", "to", "a", "an", "is", "it", "by", "or", "with", "from", "as",
    "services", "solutions", "group", "holdings", "enterprises", "international", "industries", "consulting", "technologies", "tech", "labs", "media",
    "ventures", "partners", "capital", "trust", "foundation", "association", "society", "institute",
)
# Legal suffixes that profiling looks for at the end of a name.
PROFILE_SUFFIXES = (
    "llc", "ltd", "limited", "inc", "corp", "corporation", "pvt", "private", "llp", "lp", "co", "company", "sarl", "sci", "sas", "plc", "pllc",
    "gmbh", "bv", "ag", "sa", "sl", "srl", "pty", "ngo", "npo", "trust", "foundation", "association", "society", "institute", "university", "college",
    "school", "hospital", "clinic", "academy", "services", "solutions", "group", "holdings", "enterprises", "international", "industries",
    "consulting", "technologies", "tech", "labs", "media", "ventures", "partners", "capital",
)


def words(c: Column) -> Column:
    """Runs of ASCII letters and digits, lower-cased, repeats kept."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))


def blocking_tokens(c: Column, least: int = schema.TOKEN_LENGTH, stopwords: tuple[str, ...] = STOPWORDS) -> Column:
    """The distinct words that are long enough, no stopwords and not numbers."""
    return F.filter(F.array_distinct(words(c)), lambda t: (F.length(t) >= least) & ~t.isin(*stopwords) & ~t.rlike("^[0-9]+$"))


def shingles(c: Column, n: int = schema.SHINGLE) -> Column:
    """The distinct n-character strings; a shorter text is its own."""
    c = F.coalesce(c, F.lit(""))
    many = F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - (n - 1), F.lit(1))), lambda i: F.substring(c, i, F.lit(n)))
    return F.when(F.length(c) < n, F.array(c)).otherwise(F.array_distinct(many))


def legal_suffix(c: Column) -> Column:
    """The legal suffix at the end of a name, or null."""
    found = F.regexp_extract(F.lower(F.trim(F.coalesce(c, F.lit("")))), rf"\b({'|'.join(PROFILE_SUFFIXES)})$", 1)
    return F.when(found != "", found)


def spaced(c: Column) -> Column:
    """The lower-cased runs of other characters than white space."""
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"\s+"), lambda w: w != "")


def char_grams(c: Column, low: int, high: int) -> Column:
    """n-grams inside the words of a text, each padded by a space; a word no longer than n gives itself once and ends."""
    padded = F.transform(spaced(c), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def of_size(w: Column, n: int) -> Column:
        slide = F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - (n - 1), F.lit(1))), lambda i: F.substring(w, i, F.lit(n)))
        ended = F.length(w) <= n - 1 if n > low else F.lit(False)
        return F.when(ended, F.array().cast("array<string>")).otherwise(slide)

    return F.flatten(F.transform(padded, lambda w: F.flatten(F.array(*[of_size(w, n) for n in range(low, high + 1)]))))


def map_distinct(rows: DataFrame, column: str, function, name: str) -> DataFrame:
    """rows with function(column), computed once for each distinct value and joined back."""
    values = rows.select(column).distinct().withColumn(name, function(F.col(column)))
    keyed = values.withColumnRenamed(column, "_value")
    return rows.join(keyed, rows[column].eqNullSafe(keyed["_value"]), "left").drop("_value")
