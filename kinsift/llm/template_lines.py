"""Line dedup by a log-template tree.

A line's tokens (split at white space) are masked: one that holds a digit is a variable field, ``<*>``.
The tree has a fixed depth: the number of tokens, then the first LEAD masked tokens; a leaf holds the lines
that agree in these.  Two lines of a leaf are linked if they agree in MIN_CONSTANT constants or more, a
CONSTANT_SHARE of their tokens: these are a template of both, the other places being variable fields.  Lines of
one masked text enter once, by first and last document.

Of the blocks into which a line's places are cut (one more than the variable fields allowed), two linked lines
agree in at least one without variable fields.  So lines are compared with those of their leaf that agree in a
block, each with each, and no link is left out; unrelated lines of the leaf never matter.  Where over HELD
different lines agree in a block, they are dealt into parts, and each two parts are compared in a task of
their own.

A line recurs if it and those linked with it are in MIN_DOCS or more documents; a masked line needs MIN_TOKENS
tokens and a MASKED_SHARE of constants, and other lines recur only word for word.  The first document (the least
doc_id) that has a line or one linked with it keeps it; later documents drop theirs.

Edge cases: a null text stays null and an empty one empty; blank lines are kept and have no template; texts of
any length count whole; rows with equal doc_id are one document; a null doc_id loses recurring lines but
counts for no document; an empty table gives an empty result; other columns pass through (n_chars, if there, is recounted).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinsift.llm.near_forest import grouped
from kinsift.llm.scratch import Scratch
from kinsift.llm.textkit import U, Words, mix, slices

LEAD, MIN_DOCS, MIN_TOKENS, HELD = 3, 2, 5, 512
MIN_CONSTANT, CONSTANT_SHARE, MASKED_SHARE = 6, 0.7, 0.5
VARIABLE = U(0xA5A5A5A5)  # stands for the hash of a masked token


def least(n: int) -> int:
    """In how many constants two lines of n tokens must agree."""
    return max(MIN_CONSTANT, math.ceil(CONSTANT_SHARE * n - 1e-9))


class Lines:
    """The lines of a column that have so many tokens: text, number in it, first token, number of tokens; and the tokens' hashes."""

    def __init__(self, column: pa.Array, shortest: int = MIN_TOKENS):
        words = Words(column)
        data = words.data
        digits = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
        breaks = np.concatenate([[0], np.cumsum(data == 10)])
        self.variable = digits[words.ends] > digits[words.starts]
        own = words.hashes()
        self.hashes = np.where(self.variable, VARIABLE, own)
        text = np.searchsorted(words.of, np.arange(len(words.starts)), "right") - 1
        line = breaks[words.starts] - breaks[words.offsets[text]]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (line[1:] != line[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(text)))
        self.place = np.arange(len(text)) - np.repeat(first, count)
        long = count >= shortest
        self.text, self.line, self.first, self.count = text[first][long], line[first][long], first[long], count[long]
        places = mix(self.place.astype(U))
        sums, plain = (np.concatenate([[U(0)], np.cumsum(mix(h + places))]) for h in (self.hashes, own))
        size = self.count.astype(U)
        masked = np.concatenate([[0], np.cumsum(self.variable)])
        constants = self.count - (masked[self.first + self.count] - masked[self.first])
        # short lines, and those that are mostly numbers, stand for themselves
        sums_of = np.where((self.count < MIN_TOKENS) | (constants < MASKED_SHARE * self.count), plain[self.first + self.count] - plain[self.first], sums[self.first + self.count] - sums[self.first])
        self.template = mix(sums_of + size)
        leaf = mix(sums[self.first + np.minimum(LEAD, self.count)] - sums[self.first] + (size << U(32)))
        # lines with too few constants for a link are a leaf of their own
        self.leaf = np.where(constants >= np.maximum(MIN_CONSTANT, np.ceil(CONSTANT_SHARE * self.count - 1e-9)), leaf, self.template)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def parse(batches: Iterator[pa.RecordBatch], shortest: int) -> Iterator[pa.RecordBatch]:
    """doc_id, at (the line's number), template and leaf of each line."""
    for batch in slices(batches):
        x = Lines(batch.column(1), shortest)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(x.text)), pa.array(x.line.astype(np.int32)), signed(x.template), signed(x.leaf)], ["doc_id", "at", "template", "leaf"])


def fields(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """template, tokens (hashes, 0 for masked ones) and keys of the blocks, of lines with the templates asked for.

    Batches have doc_id, text, and the templates asked for in it.
    """
    for batch in slices(batches):
        x = Lines(batch.column(1))
        asked = [set(a) for a in batch.column(2).to_pylist()]
        templates = x.template.view(np.int64).tolist()
        found: dict[int, tuple[bytes, list[int]]] = {}
        for i, (t, template) in enumerate(zip(x.text.tolist(), templates, strict=True)):
            if template not in asked[t] or template in found:
                continue
            n = int(x.count[i])
            own = slice(int(x.first[i]), int(x.first[i]) + n)
            tokens = np.where(x.variable[own], U(0), x.hashes[own] | U(1))
            blocks = n - least(n) + 1
            if blocks < 1:
                continue
            cuts = LEAD + (n - LEAD) * np.arange(blocks + 1) // blocks
            sums = np.concatenate([[U(0)], np.cumsum(mix(tokens + mix(np.arange(n).astype(U))))])
            masked = np.concatenate([[0], np.cumsum(tokens == 0)])
            keys = mix(x.leaf[i] ^ mix(sums[cuts[1:]] - sums[cuts[:-1]] + np.arange(blocks).astype(U)))
            found[template] = tokens.tobytes(), keys[masked[cuts[1:]] == masked[cuts[:-1]]].view(np.int64).tolist()
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([a for a, _ in found.values()], pa.binary()), pa.array([k for _, k in found.values()], pa.list_(pa.int64()))], ["template", "tokens", "keys"])


def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """template, first and last document of it and of the templates of the same task that are like it.

    Batches have task, template, first and last document and tokens, sorted by task.
    """
    low, high = -(2**63), 2**63 - 1
    for table in grouped(batches):
        column = table.column(4).combine_chunks()
        size = column.to_numpy(zero_copy_only=False)
        lengths = np.fromiter(map(len, size), np.int64, len(size))
        template, first, last = (table.column(i).fill_null(x).to_numpy() for i, x in ((1, 0), (2, high), (3, low)))
        for length in np.unique(lengths).tolist():  # one, but for hash accidents
            own = np.flatnonzero(lengths == length)
            tokens = np.frombuffer(b"".join(size[own]), U).reshape(len(own), -1)
            need, k = least(tokens.shape[1]), len(own)
            others = np.where(tokens == 0, U(2), tokens)  # tokens are odd, and masked ones agree with nothing
            a, b = first[own], last[own]
            before, after = a.copy(), b.copy()
            step = max(1, (1 << 22) // tokens.size)
            for i in range(0, k, step):
                like = (tokens[i : i + step, None, :] == others[None, :, :]).sum(axis=2) >= need
                before[i : i + step] = np.minimum(a[i : i + step], np.where(like, a, high).min(axis=1))
                after[i : i + step] = np.maximum(b[i : i + step], np.where(like, b, low).max(axis=1))
            # of a line without a doc_id, documents of several tasks count together
            fine = np.flatnonzero((before < after) | (a == high) & (before < high))
            yield pa.RecordBatch.from_arrays([pa.array(x[fine]) for x in (template[own], before, after)], ["template", "first", "last"])


def dropped(docs: DataFrame, scratch: Scratch, shortest: int) -> DataFrame:
    """doc_id and the sorted numbers of the lines to drop, at least one."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lines = scratch.stage(texts.mapInArrow(lambda batches: parse(batches, shortest), "doc_id long, at int, template long, leaf long"), "lines")
    templates = lines.groupBy("template").agg(F.first("leaf").alias("leaf"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("times"))
    templates = scratch.stage(templates, "templates")
    exact = templates.filter("first < last").select("template", "first", "last")
    # leaves of several documents whose lines differ; the lists grow with the input, so none is broadcast
    mixed = templates.groupBy("leaf").agg(F.min("first").alias("a"), F.max("last").alias("b"), F.count("*").alias("k")).filter("a < b and k > 1").select("leaf").hint("merge")
    wanted = scratch.stage(templates.join(mixed, "leaf").select("template", "first", "last", "times"), "wanted")
    asked = wanted.groupBy(F.col("first").alias("_first")).agg(F.collect_list("template").alias("templates"))
    found = texts.join(asked.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_first"))).select("doc_id", "text", "templates")
    words = found.mapInArrow(fields, "template long, tokens binary, keys array<long>").dropDuplicates(["template"])
    words = scratch.stage(words.join(wanted.hint("merge"), "template"), "words")
    # blocks of lines that differ, of several documents; of those with the same lines one will do
    keys = words.select("template", "first", "last", F.explode("keys").alias("key"))
    blocks = keys.groupBy("key").agg(F.min("first").alias("a"), F.max("last").alias("b"), F.count("*").alias("k"), F.sum(F.col("template").cast("decimal(20,0)")).alias("sum"), F.count("first").alias("known")).filter("(a < b or known < k) and k > 1")
    # lines of a block with many are dealt into parts, fewer than in proportion, and each two parts meet in a task
    parts = F.when(F.col("k") > HELD, F.ceil(F.least(F.col("k") / HELD, 4 * F.sqrt(F.col("k") / HELD)))).otherwise(F.lit(1)).cast("long").alias("parts")
    blocks = scratch.stage(blocks.groupBy("k", "sum").agg(F.min("key").alias("key")).select("key", parts), "blocks")
    members = keys.select("template", "key").join(blocks.hint("merge"), "key").join(words.drop("keys").hint("merge"), "template")
    own = members.withColumn("_own", F.pmod(F.xxhash64("template"), F.col("parts"))).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    task = F.when(F.col("parts") == 1, F.col("key")).otherwise(F.xxhash64("key", F.least("_own", "_other"), F.greatest("_own", "_other"))).alias("task")
    dealt = own.select(task, "template", "first", "last", "tokens").repartition("task").sortWithinPartitions("task")
    general = dealt.mapInArrow(linked, "template long, first long, last long")
    # staged, so that the join can split a template with very many lines
    recurring = scratch.stage(exact.unionByName(general).groupBy("template").agg(F.min("first").alias("first"), F.max("last").alias("last")).filter("first < last").select("template", "first"), "recurring")
    gone = lines.join(recurring.hint("merge"), "template").filter("doc_id is null or doc_id > first").select("doc_id", "at")
    return scratch.stage(gone.groupBy("doc_id").agg(F.array_sort(F.collect_set("at")).alias("dropped")), "dropped")


def strip_templates(docs: DataFrame, shortest: int = MIN_TOKENS) -> DataFrame:
    """docs without the lines that repeat other documents' templates; with dropped_lines, how many.

    Lines of fewer than ``shortest`` tokens are kept; op3 and the pipeline take 1, so that every line counts.
    """
    scratch = Scratch(docs.sparkSession)
    gone = dropped(docs, scratch, shortest).withColumnRenamed("doc_id", "_id").hint("merge")
    scratch.release()
    # the row travels in a struct, so that none of its columns is taken for one of those made here
    row = docs.drop("dropped_lines").select(F.struct(*(c for c in docs.columns if c != "dropped_lines")).alias("_row"))
    joined = row.join(gone, F.col("_row.doc_id").cast("long").eqNullSafe(F.col("_id")), "left")
    kept = F.array_join(F.filter(F.split("_row.text", "\n"), lambda _, i: ~F.array_contains("dropped", i)), "\n")
    text = F.when(F.col("dropped").isNull() | F.col("_row.text").isNull(), F.col("_row.text")).otherwise(kept)
    own = {"text": text, "n_chars": F.when(F.col("dropped").isNull(), F.col("_row.n_chars")).otherwise(F.length(text).cast(dict(docs.dtypes)["n_chars"]))} if "n_chars" in docs.columns else {"text": text}
    columns = [own.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns if c != "dropped_lines"]
    return joined.select(*columns, F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("dropped_lines"))


def op3_template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: how many lines they have and lose, and a digest of what is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total = F.size(F.split("text", "\n")).cast("long").alias("n_lines")
    out = strip_templates(docs.select("doc_id", "text", total), shortest=1)
    return out.select("doc_id", "n_lines", F.col("dropped_lines").alias("n_dropped"), F.octet_length("text").cast("long").alias("kept_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
