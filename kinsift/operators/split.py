"""Stratified split of entities by country and number of matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinsift.sources.tables import seeded


def bracket(n: Column) -> Column:
    """0, 1, 2, 3-5 or 6+ matches."""
    return F.when(n == 0, "0").when(n == 1, "1").when(n == 2, "2").when(n <= 5, "3-5").otherwise("6+")


def with_stratum(truth: DataFrame) -> DataFrame:
    """truth (s1_id, country, ids) with bracket and stratum."""
    rows = truth.withColumn("bracket", bracket(F.size("ids")))
    return rows.withColumn("stratum", F.concat(F.coalesce("country", F.lit("UNKNOWN")), F.lit("__"), "bracket"))


def stratified_split(truth: DataFrame, share: float = 0.1, seed: int = 42) -> DataFrame:
    """truth with stratum and is_val: of each stratum the rounded share whose seeded hash comes first.

    Strata are few and large, so rows are ranked in 4096 buckets of their hashes: whole buckets below the share
    are in, and only inside the bucket that holds its end are rows ranked one by one.
    """
    rows = with_stratum(truth).withColumn("_hash", seeded(F.col("s1_id"), seed)).withColumn("_bucket", F.substring("_hash", 1, 3))
    sizes = rows.groupBy("stratum", "_bucket").agg(F.count("*").alias("_size"))
    inside = Window.partitionBy("stratum")
    sizes = sizes.withColumn("_before", F.sum("_size").over(inside.orderBy("_bucket")) - F.col("_size")).withColumn("_in", F.round(F.sum("_size").over(inside) * share))
    own = Window.partitionBy("stratum", "_bucket").orderBy("_hash", "s1_id")
    ranked = rows.join(sizes, ["stratum", "_bucket"]).withColumn("is_val", F.col("_before") + F.row_number().over(own) <= F.col("_in"))
    return ranked.select(*truth.columns, "bracket", "stratum", "is_val")


def proportions(rows: DataFrame, column: str = "stratum") -> DataFrame:
    """(value, n, share), to 4 places."""
    counts = rows.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(column, "n", F.round(F.col("n") / F.col("total"), 4).alias("share"))  # total is one row


def split_quality(split: DataFrame) -> DataFrame:
    """(stratum, train_share, val_share) side by side."""
    train, val = (proportions(split.filter(f)).select("stratum", F.col("share").alias(n)) for f, n in (("not is_val", "train_share"), ("is_val", "val_share")))
    return train.join(val, "stratum", "full").na.fill(0.0)


def check_split(split: DataFrame) -> DataFrame:
    """One row: sizes, and how many ids are on both sides."""
    ids = split.groupBy("s1_id").agg(F.count_distinct("is_val").alias("sides"))
    sizes = split.agg(F.count("*").alias("n"), F.count_if("is_val").alias("n_val"), F.count_if(~F.col("is_val")).alias("n_train"))
    return sizes.crossJoin(F.broadcast(ids.agg(F.count_if(F.col("sides") > 1).alias("n_overlap"))))  # one row each
