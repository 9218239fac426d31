"""Jobs over files: normalize sources, write splits, block and score a validation set, write a submission."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinsift import schema
from kinsift.operators import blocking, evaluate, normalize, split
from kinsift.sources import tables

log = logging.getLogger("kinsift")


def normalize_file(spark: SparkSession, source: str, target: str, toggles: Mapping[str, bool] | None = None, tsv: bool = False) -> DataFrame:
    """Reads a source table, normalizes it, writes it, and returns what was written."""
    tables.require(spark, source)
    rows = normalize.normalize(tables.read_source(spark, source), toggles=toggles)
    tables.write_normalized(rows, target, tsv)
    log.info("normalized %s to %s", source, target)
    return rows if tsv else spark.read.parquet(target)


def normalize_sources(spark: SparkSession, data: str, target: str, toggles: Mapping[str, bool] | None = None, kinds: tuple[str, ...] = ("train", "test")) -> dict[str, DataFrame]:
    """All sources of data/train and data/test, as ``<kind>_source<i>_norm``; a rate of firing per rule is logged."""
    out = {}
    for kind in kinds:
        for i in (1, 2, 3):
            name = f"{kind}_source{i}"
            out[name] = normalize_file(spark, f"{data}/{kind}/{name}.tsv", f"{target}/{name}_norm", toggles)
            log.info("%s", tables.text_report(normalize.change_statistics(out[name]), name))
    return out


def write_split(rows: DataFrame, folder: str) -> None:
    """Writes a split truth (s1_id, ids, is_val): two truth files and two id lists, the latter without a last line end."""
    for name, part in (("train", rows.filter(~F.col("is_val"))), ("val", rows.filter("is_val"))):
        tables.write_id_lists(part, f"{folder}/{name}_ground_truth.tsv", ends="\n")
        tables.write_lines(part.orderBy("s1_id").select(F.col("s1_id").alias("value")), f"{folder}/{name}_s1_ids.txt", last=False)


def split_truth(spark: SparkSession, truth: str, source: str, folder: str, share: float = 0.1, seed: int = 42) -> DataFrame:
    """Splits the entities of a truth file by country and number of matches, and writes the parts."""
    countries = tables.read_source(spark, source, [schema.ID, schema.COUNTRY]).select(F.col(schema.ID).alias("s1_id"), F.col(schema.COUNTRY).alias("country"))
    rows = split.stratified_split(tables.read_id_lists(spark, truth).join(countries, "s1_id", "left"), share, seed)
    write_split(rows, folder)
    return rows


def block_validation(spark: SparkSession, normalized: str, splits: str, target: str, encode=None, goal: float = 0.95, **options) -> tuple[DataFrame, bool | None]:
    """Candidates of the validation entities against the whole pool; writes ``val_candidate_pairs.tsv``.

    Returns the recall by country and in total, and whether the total meets the goal (None without a truth file,
    where all entities are blocked).
    """
    s1, *others = tables.load_sources(spark, normalized, "train")
    pool = tables.union_pool(*others)
    truth_file, truth = f"{splits}/val_ground_truth.tsv", None
    if tables.exists(spark, truth_file):
        truth = tables.read_id_lists(spark, truth_file)
        ids = tables.read_ids(spark, f"{splits}/val_s1_ids.txt", header=False)
        s1 = s1.join(ids.withColumnRenamed("id", schema.ID), schema.ID, "left_semi")
    else:
        log.warning("%s isn't there, so recall isn't measured", truth_file)
    _, lists = blocking.run_blocking(s1, pool, encode, **options)
    if truth is not None:  # every entity of the truth has a row
        lists = tables.lists_of(tables.pairs_of(lists), truth)
    tables.write_id_lists(lists, f"{target}/val_candidate_pairs.tsv", schema.CANDIDATE_HEADER, ends="\n")
    if truth is None:
        return spark.createDataFrame([], "country string"), None
    written = tables.read_id_lists(spark, f"{target}/val_candidate_pairs.tsv")
    countries = s1.select(F.col(schema.ID).alias("s1_id"), F.col(schema.COUNTRY).alias("country"))
    stats = evaluate.country_summary(written, truth.join(countries, "s1_id", "left"), goal)
    total = evaluate.blocking_recall(written, truth).first()["overall_pair_recall"]
    log.info("%s", tables.text_report(stats, f"recall {total:.4f}, goal {goal}"))
    return stats, total >= goal


def write_submission(spark: SparkSession, data: str, target: str, matches: DataFrame | None = None, candidates: DataFrame | None = None) -> None:
    """Matching and candidate files with every test entity; pairs (s1_id, cand_id) that aren't given are empty lists."""
    source = f"{data}/test/test_source1.tsv"
    tables.require(spark, source)
    entities = tables.read_source(spark, source, [schema.ID]).filter(F.col(schema.ID).isNotNull()).select(F.col(schema.ID).alias("s1_id"))
    none = spark.createDataFrame([], "s1_id string, cand_id string")
    for pairs, name, header in ((matches, "matching_results", schema.TRUTH_HEADER), (candidates, "candidate_pairs", schema.CANDIDATE_HEADER)):
        tables.write_id_lists(tables.lists_of(none if pairs is None else pairs, entities), f"{target}/{name}.tsv", header)


def main(spark: SparkSession, arguments: list[str] | None = None) -> int:
    """Writes a submission without matches; --score scores it against the truth of the training data, if that is there."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("--data-dir", default="dataset")
    parser.add_argument("--out-dir", default="output")
    parser.add_argument("--score", action="store_true")
    given = parser.parse_args(arguments)
    if not tables.exists(spark, f"{given.data_dir}/test/test_source1.tsv"):
        log.error("test_source1.tsv isn't in %s/test", given.data_dir)
        return 1
    write_submission(spark, given.data_dir, given.out_dir)
    truth = f"{given.data_dir}/train/train_ground_truth.tsv"
    if given.score and not tables.exists(spark, truth):
        log.warning("%s isn't there, so nothing is scored", truth)
    elif given.score:
        print(f"macro F0.5: {evaluate.score_files(spark, f'{given.out_dir}/matching_results.tsv', truth):.4f}")
    return 0
