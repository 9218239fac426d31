"""Sharding by a hierarchical weighted hash tree (region, rack, shard).

At every level a row draws one straw per child, ``-ln(u) / weight`` with u from md5(node, doc_id), and
descends to the child with the least; a child is taken in proportion to its weight.  A child's straw
depends on nothing but its own name and weight, so a changed weight moves rows only into or out of the
subtree that changed.  Growth is tagged with a generation: a shard added later stands below children of
its own at every level, so a row that its subtree draws can end nowhere but in the new shard, and one
more shard takes rows only into itself (law ``key``).

Edge cases: a null doc_id draws as the text "null"; null text has 16 bytes and checksum 0; texts of any length
are only measured; of equal straws the child with the lesser name wins; rows with equal doc_id share a shard;
repeated rows get slots of their own; an empty table gives an empty result. Columns besides doc_id and text
pass through ``assign`` (names that it adds are replaced).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LEVELS = 3


@dataclass
class HashTree:
    """children: name of a node -> (name, weight) of each child; shards: name of a leaf -> number."""

    children: dict[str, list[tuple[str, float]]] = field(default_factory=lambda: {"root": []})
    shards: dict[str, int] = field(default_factory=dict)

    @classmethod
    def build(cls, shards: int, per_rack: int = 4, racks: int = 2) -> HashTree:
        """Equal shards: per_rack in a rack, racks in a region; the last ones may be part full."""
        tree = cls()
        for shard in range(shards):
            rack = shard // per_rack
            tree.add(shard, f"region{rack // racks}", f"rack{rack}")
        return tree

    def add(self, shard: int, region: str, rack: str, weight: float = 1.0, generation: int = 0) -> None:
        """Puts a shard in the tree and adds its weight to its ancestors of the same generation."""
        tag = f"@{generation}" if generation else ""
        leaf = f"shard{shard}{tag}"
        for parent, child in (("root", region + tag), (region + tag, rack + tag), (rack + tag, leaf)):
            entries = self.children.setdefault(parent, [])
            at = next((i for i, (name, _) in enumerate(entries) if name == child), None)
            if at is None:
                entries.append((child, weight))
            else:
                entries[at] = (child, entries[at][1] + weight)
        self.shards[leaf] = shard

    def grown(self, region: str = "region0", rack: str = "rack0", weight: float = 1.0) -> HashTree:
        """The tree with one more shard, of a generation of its own."""
        tree = HashTree({k: list(v) for k, v in self.children.items()}, dict(self.shards))
        shard = len(self.shards)
        tree.add(shard, region, rack, weight, generation=shard)
        return tree

    def shard_of(self, doc_id: Column) -> Column:
        """The shard for a doc_id, by descending the levels."""
        straws = F.create_map(*[x for parent, entries in self.children.items() for x in (F.lit(parent), F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in entries]))])
        numbers = F.create_map(*[x for leaf, n in self.shards.items() for x in (F.lit(leaf), F.lit(n))])
        key = F.coalesce(doc_id.cast("string"), F.lit("null"))
        node: Column = F.lit("root")
        for _ in range(LEVELS):
            drawn = F.transform(F.element_at(straws, node), lambda c: F.struct((-F.log(unit(c["name"], key)) / c["weight"]).alias("straw"), c["name"].alias("name")))
            node = F.array_min(drawn)["name"]
        return F.element_at(numbers, node)


def unit(name: Column, key: Column) -> Column:
    """A number in (0, 1): the first 48 bits of md5("name:key"), plus a half."""
    bits = F.conv(F.substring(F.md5(F.concat(name, F.lit(":"), key).cast("binary")), 1, 12), 16, 10).cast("double")
    return (bits + 0.5) / float(2**48)


def assign(docs: DataFrame, tree: HashTree, column: str = "shard") -> DataFrame:
    """docs with the shard of each row; no shuffle."""
    return docs.withColumn(column, tree.shard_of(F.col("doc_id")))


def write_shards(docs: DataFrame, tree: HashTree, path: str) -> None:
    """Writes each shard's rows into a folder of its own, without gathering a shard in one task."""
    assign(docs, tree).write.mode("overwrite").partitionBy("shard").parquet(path)


def slots(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows with slot, gapless from 0 in each group, in order of 4096 buckets (of the first of `order`) and then of `order`.

    Groups are numbered bucket by bucket: counts per (group, bucket) give where a bucket starts, so no
    group meets in one task.  Equal rows are counted first and expanded last, so repeats don't either.
    """
    bucket = F.substring(F.md5(F.coalesce(F.col(order[0]).cast("string"), F.lit("null")).cast("binary")), 1, 3)
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("_n")).withColumn("_bucket", bucket)
    sizes = counted.groupBy(group, "_bucket").agg(F.sum("_n").alias("_size"))
    starts = sizes.select(group, "_bucket", (F.sum("_size").over(Window.partitionBy(group).orderBy("_bucket")) - F.col("_size")).alias("_start"))
    inside = Window.partitionBy(group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = counted.withColumn("_before", F.sum("_n").over(inside) - F.col("_n")).join(starts, [group, "_bucket"])
    return numbered.select(*rows.columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("_i"), "_before", "_start").select(*rows.columns, (F.col("_start") + F.col("_before") + F.col("_i")).alias("slot"))


def op4_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 39 for all documents, by law ``key``, and the shard when there are 41."""
    from kinsift.llm.scratch import Scratch

    tree = HashTree.build(40)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        tree.shard_of(F.col("doc_id")).alias("shard"),
        tree.grown().shard_of(F.col("doc_id")).alias("grown_shard"),
    )
    staged = Scratch(spark).stage(rows, "shards")
    out = slots(staged, "shard", ["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
