"""Quality rules with risk-controlled cutoffs.

Each rule is a ratio of a text (symbols per character, repeated lines, ...) and rejects what lies at or
above a cutoff.  Cutoffs are chosen per stratum (the language) on labelled holdout texts: going from the
most lenient cutoff on, each is certified by the exact binomial test that, of the good texts, at most
ALPHA / (number of rules) are rejected; the first that can't be certified ends the walk (fixed-sequence
testing, which needs no correction between the cutoffs of a rule).  Strata and rules are corrected for by
Bonferroni, DELTA / (strata * rules).  So with probability 1 - DELTA or more, in every stratum at most
ALPHA of good texts are rejected by all rules together.  A stratum with too few labels certifies nothing
and rejects nothing.  All labelled rows are counted, by one aggregation; nothing is sampled.

Edge cases: null and empty texts have no words and fail the base rule; texts of any length are measured whole;
a ratio equal to a cutoff rejects; a null language is a stratum of its own; repeated rows count as they come;
empty tables, or no labels, give no cutoffs; more columns pass through ``verdicts`` (names that it adds are
replaced).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinsift.llm.scratch import Scratch
from kinsift.llm.textkit import SEPARATOR, Words, slices, span_hashes, spans, windows

ALPHA, DELTA = 0.05, 0.05
#: Cutoffs to try of each rule, the most lenient first.
CUTOFFS = {
    "symbol_ratio": (0.5, 0.3, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02),
    "dup_line_ratio": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2),
    "repeat_ratio": (0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15),
    "capital_ratio": (0.9, 0.7, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = tuple(CUTOFFS)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LINE = np.zeros(256, bool)
_LINE[10] = True


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts and ratios of each text."""
    words = Words(column)
    data, offsets, of = words.data, words.offsets, words.of
    n = len(offsets) - 1

    def within(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    n_words = np.diff(of)
    word_chars = within(~SEPARATOR[data] & (data & 0xC0 != 0x80))
    hashes = words.hashes()
    triples = windows(hashes, 3)
    starts, ends = spans(data, offsets, _LINE)
    first_word = np.searchsorted(words.starts, starts)
    worded = np.searchsorted(words.starts, ends) > first_word
    starts, ends = starts[worded], ends[worded]
    lines = span_hashes(data, starts, ends)
    lines_of = np.searchsorted(starts, offsets)
    dup_lines, repeats = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n):
        own = lines[lines_of[i] : lines_of[i + 1]]
        if len(own) > 1:
            dup_lines[i] = len(own) - len(np.unique(own))
        if n_words[i] > 3:
            own = triples[of[i] : of[i + 1] - 2]
            _, back, times = np.unique(own, return_inverse=True, return_counts=True)
            again = times[back] > 1
            covered = np.zeros(n_words[i], bool)
            for k in range(3):
                covered[k : k + len(again)] |= again
            repeats[i] = covered.sum()
    n_lines = np.diff(lines_of)
    letters = within(((data | 0x20) >= 97) & ((data | 0x20) <= 122))
    symbols = within(_SYMBOL[data])
    per = lambda a, b: a / np.maximum(b, 1)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": symbols,
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeats,
        "symbol_ratio": per(symbols, word_chars),
        "dup_line_ratio": per(dup_lines, n_lines),
        "repeat_ratio": per(repeats, n_words),
        "capital_ratio": per(within((data >= 65) & (data <= 90)), letters),
    }


def measured(docs: DataFrame) -> DataFrame:
    """docs with the counts (long), the ratios (double) and base_failed."""
    docs = docs.drop(*COUNTS, *RATIOS, "base_failed")
    schema = T.StructType(list(docs.schema))
    for c in COUNTS:
        schema = schema.add(c, "long")
    for c in RATIOS:
        schema = schema.add(c, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            m = measure(batch.column(batch.schema.get_field_index("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(m[c].astype(np.int64)) for c in COUNTS), *(pa.array(m[c].astype(np.float64)) for c in RATIOS)], [*batch.schema.names, *COUNTS, *RATIOS])

    return docs.mapInArrow(run, schema).withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))


def tail(rejected: int, n: int, rate: float) -> float:
    """P(X <= rejected) for X binomial(n, rate), exactly."""
    log = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(rate) + (n - k) * math.log1p(-rate) for k in range(rejected + 1)]
    top = max(log)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in log))


def certified(good: int, rejected: list[int], delta: float, alpha: float) -> int:
    """How many of the cutoffs, from the first on, are certified."""
    for i, x in enumerate(rejected):
        if not good or x > alpha * good or tail(x, good, alpha) > delta:
            return i
    return len(rejected)


def choose_cutoffs(labelled: DataFrame, scratch: Scratch, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """stratum and a cutoff (null: none) per rule, from measured rows with stratum and quality.

    One aggregation counts, for each stratum, the good rows and those of them at or above each cutoff.
    """
    counts = labelled.filter("quality = 1 and not base_failed").groupBy("stratum").agg(F.count("*").alias("good"), *[F.count(F.when(F.col(r) >= c, 1)).alias(f"{r}_{i}") for r in RATIOS for i, c in enumerate(CUTOFFS[r])])
    counts = scratch.stage(counts, "counts")
    counts = counts.crossJoin(F.broadcast(counts.agg(F.count("*").alias("strata"))))  # a single row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                chosen = {"stratum": row["stratum"]}
                for r, cutoffs in CUTOFFS.items():
                    k = certified(row["good"], [row[f"{r}_{i}"] for i in range(len(cutoffs))], delta / (row["strata"] * len(CUTOFFS)), alpha / len(CUTOFFS))
                    chosen[f"{r}_cutoff"] = cutoffs[k - 1] if k else None
                out.append(chosen)
            yield pa.RecordBatch.from_pylist(out, pa.schema([("stratum", pa.string()), *((f"{r}_cutoff", pa.float64()) for r in RATIOS)]))

    return counts.mapInArrow(run, "stratum string, " + ", ".join(f"{r}_cutoff double" for r in RATIOS))


def stratum() -> Column:
    return F.col("lang").alias("stratum")


def judged(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The measures of docs (doc_id, stratum, counts, ratios, base_failed), and the cutoffs of their labelled rows.

    Texts are measured once; only measures are joined to labels.
    """
    measures = scratch.stage(measured(docs.select("doc_id", "text", stratum())).drop("text"), "measures")
    marks = labels.filter("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return measures, scratch.stage(choose_cutoffs(measures.join(marks, "doc_id"), scratch), "cutoffs")


def decide(rows: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Measured rows (with stratum) with kept, in place of the stratum."""
    rejected = F.lit(False)
    for r in RATIOS:
        rejected = rejected | F.coalesce(F.col(r) >= F.col(f"{r}_cutoff"), F.lit(False))
    joined = rows.join(cutoffs.withColumnRenamed("stratum", "_stratum"), F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected).drop("stratum", "_stratum", *(f"{r}_cutoff" for r in RATIOS))


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with counts, ratios, base_failed and kept; cutoffs come from the labelled rows of docs."""
    _, cutoffs = judged(docs, labels, Scratch(docs.sparkSession))
    # the columns that the rules don't need travel in a struct, so that none is taken for one of those made here
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "kept", "base_failed", *COUNTS, *RATIOS)]
    packed = docs.select("doc_id", "text", "lang", F.struct(*rest, F.lit(0).alias("")).alias("_rest"))
    judged_ = decide(measured(packed).withColumn("stratum", stratum()), cutoffs)
    own = [c for c in docs.columns if c in ("doc_id", "text", "lang", *rest)]
    return judged_.select(*(F.col("_rest").getField(c).alias(c) if c in rest else F.col(c) for c in own), *COUNTS, *RATIOS, "base_failed", "kept")


def op8_risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = decide(*judged(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), Scratch(spark)))
    return kept.select("doc_id", *COUNTS, "base_failed", "kept")
