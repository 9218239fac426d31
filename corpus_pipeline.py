"""A training corpus of the documents: rules, lines, near duplicates, benchmark, pieces.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of
documents.  ``run`` writes each stage's result as Parquet in the shared folder and reads it again as the
next one's docs.  Columns that an operator doesn't need travel in a struct, so that none of them is taken
for, or replaced by, one of the operator's own of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinsift.llm import edit_screen, near_forest, piece_codec, risk_rules, template_lines
from kinsift.llm.scratch import Scratch


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns of docs, and all others in a struct."""
    rest = [F.col(c) for c in docs.columns if c not in needed]
    return docs.select(*(c for c in docs.columns if c in needed), *([F.struct(*rest).alias("_rest")] if rest else []))


def unpacked(out: DataFrame, docs: DataFrame, *needed: str) -> DataFrame:
    """The columns of docs again, in their order."""
    return out.select(*(F.col(c) if c in needed else F.col("_rest").getField(c).alias(c) for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the risk-controlled rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    needed = "doc_id", "text", "lang"
    return unpacked(risk_rules.verdicts(packed(docs, *needed), labels).filter("kept"), docs, *needed)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one's templates; what loses all its text goes."""
    needed = "doc_id", "text", "n_chars"
    out = template_lines.strip_templates(packed(docs, *needed), shortest=1)
    return unpacked(out.filter("dropped_lines = 0 or trim(text) <> ''"), docs, *needed)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word shingles, Jaccard 0.8 or more."""
    return near_forest.dedup(docs, k=5, threshold=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    needed = "doc_id", "text"
    return unpacked(edit_screen.screen(packed(docs, *needed), benchmark).filter(~F.col("contaminated")), docs, *needed)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, and the text they decode to."""
    out = piece_codec.encode(docs.select("doc_id", "text"), piece_codec.model_path())
    return out.select("doc_id", F.size("piece_ids").cast("long").alias("n_tokens"), "piece_ids", "decoded")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-duplicate removal", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("piece encoding", encode),
]
#: The near-duplicate components, edit distances and pieces have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.stage(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            scratch.drop(f"stage{k - 1}")
    return docs
