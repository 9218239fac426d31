"""Near-duplicate components by an LSH forest over MinHash signatures.

A text's set is its distinct k-word shingles (A-Z lower-cased).  Equal sets form a class at once, named by the
128 bits of its hash, so that neither repeated nor missing doc_ids matter; classes with equal signatures are
linked to the least of them.  For the others, TREES sorted orders are made: tree t sorts by the signature from
its t-th value on, around to the value before.  Rows that share a prefix of some depth are a region.  The depth
is adaptive: a region is taken at the first of DEPTHS at which it has at most DENSE rows.  In each region,
neighbours in the order (those of the longest common prefix) are compared first, and then whatever these leave
apart; rows whose signatures agree by more than the threshold less MARGIN are chained.  The chains of all trees
make blobs.

Links are confirmed on the full sets.  A blob is dealt into blocks of at most BLOCK members and SHINGLES
shingles; in a block, each member is compared with all that aren't reached yet.  The blocks' leaders make the
next round, until they fit one block; then whatever lies outside a blob's largest component is compared with
all of the blob.  So no link inside a blob is lost, no pair list of a group is written, and a group of copies
of any size costs about as much as it has rows.

For a pair at Jaccard 0.85 the chance that no tree of 20 has them in a region is 4e-7 at depth 4, 8e-5 at 6 and
5e-3 at 9 (2e-4, 2e-3 and 6e-2 at 0.8); a signature of 120 values is below the margin for 1 in 10^5 such pairs.
Regions deeper than 4 are those of over DENSE classes, where a class also meets many others of its group.

Edge cases: null and empty texts and those without words have an empty set, linked with nothing; fewer than k
words make one shingle; texts of any length count whole; a similarity of just the threshold links; repeated
rows and equal texts share a class; rows with one doc_id and different texts are told apart by their texts; a
null doc_id is linked as any other and takes its component's smallest doc_id (null if there is none); an empty
table gives an empty result; other columns pass through ``dedup``, which keeps of each component the document
with the smallest doc_id (null last) and text hash, and all rows equal to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinsift.llm.scratch import Scratch
from kinsift.llm.textkit import U, flat, mix, shingle_sets, slices

TREES, VALUES = 20, 6
SIZE = TREES * VALUES
DEPTHS = (4, 6, 9, 14, 24, 48, SIZE)
DENSE, MARGIN, BLOCK, SHINGLES, FEW = 2048, 0.15, 4000, 4_000_000, 500_000
_RANDOM = np.random.Generator(np.random.PCG64(7))
_A = _RANDOM.integers(1, 2**63, SIZE, dtype=np.uint64) * U(2) + U(1)
_B = _RANDOM.integers(0, 2**63, SIZE, dtype=np.uint64)
_LINKS = "a binary, b binary"


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash signatures (uint32, a row per set); empty sets get the largest value everywhere."""
    out = np.full((len(sets), SIZE), 0xFFFFFFFF, np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    at = 0
    while at < len(full):  # pieces that fit the cache
        to, size = at, 0
        while to < len(full) and (to == at or size + len(sets[full[to]]) <= 1 << 15):
            size += len(sets[full[to]])
            to += 1
        values, offsets = flat([sets[i] for i in full[at:to]])
        part = np.empty((SIZE, to - at), np.uint64)
        for k in range(SIZE):
            part[k] = np.minimum.reduceat(values * _A[k] + _B[k], offsets[:-1])
        out[full[at:to]] = (part >> U(32)).T
        at = to
    return out


def text_hash() -> Column:
    """What tells rows with one doc_id apart."""
    return F.xxhash64("text").alias("text_hash")


def sketch(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, set (a 128-bit hash of the set, null for an empty one) and signature of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(batch.column(2), k)
            marks = np.array([[np.bitwise_xor.reduce(mix(s ^ U(c))) if len(s) else 0 for c in (0x1234567, 0xABCDEF987)] for s in sets], np.uint64).reshape(-1, 2)
            names = [m.tobytes() if len(s) else None for m, s in zip(marks, sets, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()), pa.array([row.tobytes() for row in signatures(sets).astype(">u4")], pa.binary())],
                ["doc_id", "text_hash", "n_shingles", "set", "signature"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_hash(), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, set binary, signature binary")


def grouped(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[pa.Table]:
    """The rows of one key after another, of batches sorted by it; a key's rows are held together."""
    held: list[pa.RecordBatch] = []
    key, size = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(column).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
            if held and keys[a] != key:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            key = keys[a]
            held.append(batch.slice(a, b - a))
            size += b - a
    if held:
        yield pa.Table.from_batches(held)


def chains(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Within each region, links of rows whose signatures agree enough, to a leader each.

    Batches have region, set and the signature in the tree's order, sorted by region and that order.
    """
    for table in grouped(batches):
        names = table.column(1).to_pylist()
        rows = np.frombuffer(b"".join(table.column(2).to_pylist()), ">u4").reshape(len(names), -1)
        near = np.mean(rows[1:] == rows[:-1], axis=1) >= least  # the neighbours in the order
        run = np.concatenate([[0], np.cumsum(~near)])
        found: list[tuple[bytes, bytes]] = []
        left = np.arange(len(names))
        while len(left):
            first = left[0]
            queue = left[run[left] == run[first]].tolist()
            left = left[run[left] != run[first]]
            for at in queue:  # grows while it is read
                if at != first:
                    found.append((names[at], names[first]))
                if len(left):
                    like = np.mean(rows[left] == rows[at], axis=1) >= least
                    if like.any():
                        also = np.isin(run[left], run[left[like]])
                        queue.extend(left[also].tolist())
                        left = left[~also]
        if found:
            yield links_of(found)


def links_of(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def exact_links(sets: list[np.ndarray], threshold: int) -> Iterator[tuple[int, int]]:
    """(member, leader) of the components of sets linked by 100 * both >= threshold * either.

    Each member is compared once with all that aren't reached yet, by one pass over their elements.
    """
    values, offsets = flat(sets)
    _, number = np.unique(values, return_inverse=True)
    sizes = np.diff(offsets)
    mark = np.zeros(int(number.max()) + 1 if len(number) else 1, bool)
    left = np.arange(len(sets))
    part, at = number, offsets[:-1]
    while len(left) > 1:
        queue, leader = [left[0]], int(left[0])
        left = left[1:]
        fresh = True
        while queue and len(left):
            if fresh:
                part = np.concatenate([number[offsets[i] : offsets[i + 1]] for i in left.tolist()])
                at = np.concatenate([[0], np.cumsum(sizes[left])[:-1]])
            c = queue.pop()
            own = number[offsets[c] : offsets[c + 1]]
            mark[own] = True
            both = np.add.reduceat(mark[part].astype(np.int64), at)
            mark[own] = False
            linked = 100 * both >= threshold * (sizes[left] + sizes[c] - both)
            fresh = bool(linked.any())
            if fresh:
                for i in left[linked].tolist():
                    queue.append(i)
                    yield i, leader
                left = left[~linked]


def cross_links(sets: list[np.ndarray], component: np.ndarray, outside: np.ndarray, threshold: int) -> Iterator[tuple[int, int]]:
    """Links of the sets outside to sets of other components."""
    values, offsets = flat(sets)
    _, number = np.unique(values, return_inverse=True)
    sizes = np.diff(offsets)
    mark = np.zeros(int(number.max()) + 1 if len(number) else 1, bool)
    for c in np.flatnonzero(outside).tolist():
        own = number[offsets[c] : offsets[c + 1]]
        mark[own] = True
        both = np.add.reduceat(mark[number].astype(np.int64), offsets[:-1])
        mark[own] = False
        linked = (100 * both >= threshold * (sizes + sizes[c] - both)) & (component != component[c])
        yield from ((c, i) for i in np.flatnonzero(linked).tolist())


def components_of_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of all nodes of all edges (a, b): root is the least node of the component."""
    edges = [(a, b) for batch in batches for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
    root: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    nodes = list(root)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array([find(x) for x in nodes], pa.binary())], ["node", "root"])


def connected(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) of all nodes of edges (a, b): root is the least node of the component.

    Up to FEW edges are joined by one task.  More alternate large-star and small-star steps, each an
    aggregation and a join, until nothing changes, which gives the same.
    """
    now = scratch.stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}0")
    if now.count() <= FEW:
        return scratch.stage(now.coalesce(1).mapInArrow(components_of_edges, "node binary, root binary").filter("node <> root"), f"{name}1")
    seen, step = None, 0
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        step += 1
        now = scratch.stage(small, f"{name}{step}")
        scratch.drop(f"{name}{step - 1}")
        got = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if got == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = got


def regions(members: DataFrame, scratch: Scratch) -> DataFrame:
    """region, set, order: the rows of each tree that share a region, with the signature in the tree's order.

    members: set, signature.  Regions of over DENSE rows are divided at the next depth.
    """

    def order(tree: Column) -> Column:
        return F.expr(f"concat(substring(signature, tree * {4 * VALUES} + 1), substring(signature, 1, tree * {4 * VALUES}))")

    def counted(rows: DataFrame, depth: int) -> DataFrame:
        own = rows.select("set", "tree", F.xxhash64("tree", F.substring(order(F.col("tree")), 1, 4 * depth)).alias("region"))
        sizes = own.groupBy("region").agg(F.count("*").alias("n")).filter("n > 1")
        return scratch.stage(own.join(sizes, "region"), f"depth{depth}")

    level = counted(members.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))), DEPTHS[0])
    found = level.filter(F.col("n") <= DENSE)
    for depth in DEPTHS[1:]:
        crowded = level.filter(F.col("n") > DENSE)
        if crowded.isEmpty():
            break
        level = counted(crowded.drop("region", "n").join(members, "set"), depth)
        found = found.unionByName(level.filter(F.col("n") <= DENSE))
    return found.join(members, "set").select("region", "set", order(F.col("tree")).alias("order"))


def confirmed(docs: DataFrame, blobs: DataFrame, k: int, threshold: int, scratch: Scratch) -> DataFrame:
    """a, b: links that connect, in each blob, all sets that links on the full sets connect.

    blobs: blob, set, doc_id and text_hash (of a row with the set), n_shingles.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc_id"), text_hash().alias("_text_hash"), "text")

    def with_texts(tasks: DataFrame, *more: str) -> DataFrame:
        # the list of members grows with the input, so it isn't broadcast at any size
        same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash"))
        rows = texts.join(tasks.hint("merge"), same).select("task", "set", *more, "text").dropDuplicates(["task", "set", *more])
        return rows.repartition("task").sortWithinPartitions("task", "set")

    def blocked(members: DataFrame, round_: int) -> DataFrame:
        sizes = members.groupBy("blob").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / SHINGLES)).cast("int").alias("blocks"))
        return members.join(sizes, "blob").withColumn("block", F.pmod(F.xxhash64("set", F.lit(round_)), F.col("blocks")).cast("int"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches):
            names = table.column(1).to_pylist()
            sets = [s for chunk in table.column(2).chunks for s in shingle_sets(chunk, k)]
            yield links_of([(names[a], names[b]) for a, b in exact_links(sets, threshold)])

    found, members, round_, before = None, blobs, 0, None
    while True:
        dealt = scratch.stage(blocked(members, round_), f"blocks{round_}")
        tasks = dealt.withColumn("task", F.xxhash64("blob", "block"))
        links = scratch.stage(with_texts(tasks).mapInArrow(search, _LINKS), f"links{round_}")
        found = links if found is None else found.unionByName(links)
        many = dealt.filter("blocks > 1")
        if round_ == 0:
            large = many.select("blob").distinct()
        left = many.count()  # a number, not rows
        if not left or (before is not None and 2 * left > before):
            break
        members, before, round_ = many.drop("blocks", "block").join(links.select(F.col("a").alias("set")).distinct(), "set", "left_anti"), left, round_ + 1
    if not round_ and not left:
        return found
    roots = connected(found, scratch, "inner")
    whole = blocked(blobs.join(large, "blob", "left_semi"), 0).join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    whole = scratch.stage(whole, "whole")
    parts = whole.groupBy("blob", "root").agg(F.count("*").alias("n"))
    main = parts.groupBy("blob").agg(F.max(F.struct("n", "root")).alias("main")).select("blob", F.col("main.root").alias("main"))
    outside = whole.join(main, "blob").filter("root <> main").drop("main")
    every = outside.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("outside", F.lit(True))
    asked = every.select("blob", "block").distinct()
    inside = whole.join(main, "blob").filter("root = main").drop("main").join(asked, ["blob", "block"], "left_semi").withColumn("outside", F.lit(False))
    tasks = every.unionByName(inside.select(every.columns)).withColumn("task", F.xxhash64("blob", "block"))

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches):
            names = table.column(1).to_pylist()
            _, component = np.unique(np.array([r.hex() for r in table.column(2).to_pylist()]), return_inverse=True)
            sets = [s for chunk in table.column(4).chunks for s in shingle_sets(chunk, k)]
            yield links_of([(names[a], names[b]) for a, b in cross_links(sets, component, table.column(3).to_numpy(), threshold)])

    return found.unionByName(scratch.stage(with_texts(tasks, "root", "outside").mapInArrow(across, _LINKS), "across"))


def labelled(docs: DataFrame, k: int, threshold: int, scratch: Scratch) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and keeper (doc_id and text_hash of the row that stays) of each row.

    Links are 100 * both >= threshold * either.  Rows with an empty set have no keeper.
    """
    least = threshold / 100 - MARGIN
    sketches = scratch.stage(sketch(docs, k), "sketches")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_hash")).alias("keeper")
    classes = sketches.filter("set is not null").groupBy("set").agg(best, F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    classes = scratch.stage(classes, "classes")
    least_set = classes.groupBy("signature").agg(F.min("set").alias("b"), F.count("*").alias("n")).filter("n > 1").select("signature", "b")
    alike = scratch.stage(classes.select("set", "signature").join(least_set.hint("merge"), "signature").filter("set <> b").select(F.col("set").alias("a"), "b"), "alike")
    members = classes.select("set", "signature").join(alike.select(F.col("a").alias("set")).hint("merge"), "set", "left_anti")
    members = scratch.stage(members, "members")
    dealt = regions(members, scratch).repartition("region").sortWithinPartitions("region", "order", "set")
    links = dealt.mapInArrow(lambda batches: chains(batches, least), _LINKS).unionByName(alike)
    blobs = connected(links, scratch, "blobs")
    blobs = blobs.unionByName(blobs.select(F.col("root").alias("node"), "root").distinct()).select(F.col("node").alias("set"), F.col("root").alias("blob"))
    blobs = scratch.stage(blobs.join(classes.select("set", "keeper.doc_id", "keeper.text_hash", "n_shingles").hint("merge"), "set"), "blobs")
    roots = connected(confirmed(docs, blobs, k, threshold, scratch), scratch, "roots")
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "set")
    # few classes are linked with others, so the rest don't take part in the joins by root
    grouped_ = scratch.stage(roots.join(classes.select("set", "keeper"), "set"), "grouped")
    keepers = grouped_.groupBy("root").agg(F.min("keeper").alias("shared"))
    shared = grouped_.select("set", "root").join(keepers.hint("merge"), "root").select("set", "shared")
    final = classes.select("set", "keeper").join(shared.hint("merge"), "set", "left").select("set", F.coalesce("shared", "keeper").alias("keeper"))
    out = sketches.select("doc_id", "text_hash", "n_shingles", "set").join(final.hint("merge"), "set", "left")
    component = F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("keeper.doc_id")).alias("component_id")
    return out.select("doc_id", "text_hash", "n_shingles", component, "keeper")


def components(docs: DataFrame, k: int, threshold: int, scratch: Scratch) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs, by links of 100 * both >= threshold * either."""
    rows = labelled(docs, k, threshold, scratch)
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def dedup(docs: DataFrame, k: int = 5, threshold: int = 80) -> DataFrame:
    """The rows of docs but those that have a near duplicate which stays in their place."""
    rows = labelled(docs, k, threshold, Scratch(docs.sparkSession))
    stays = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("text_hash") == F.col("keeper.text_hash"))
    gone = rows.filter(F.col("keeper").isNotNull() & ~stays).select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_gone_hash")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(gone["_gone"]) & (F.xxhash64(docs["text"]) == gone["_gone_hash"])
    return docs.join(gone, same, "left_anti")


def op5_near_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents: 3-word shingles, Jaccard 0.85 or more."""
    return components(spark.read.parquet(f"{sf_dir}/documents.parquet"), 3, 85, Scratch(spark))
