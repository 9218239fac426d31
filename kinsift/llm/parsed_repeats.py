"""Removal of repeated byte strings by prefix-free parsing.

Every byte that lies in a WIDTH-byte string which also starts in a document with a smaller doc_id is
removed; strings are judged on the input, and matches never cross documents.

1. Parse.  A window is a WIDTH-byte string.  Its trigger is the place, of the GRAM-byte strings in it, with
   the least rolling hash (the leftmost of equals).  Windows side by side with one trigger make a phrase,
   which reaches from the first window's start to the last one's end; phrases overlap, so no phrase is a
   prefix of what follows, and equal windows always lie in phrases with equal trigger strings.
2. Dictionary.  Phrases meet by trigger hash.  A phrase that a smaller document has too is repeated as a
   whole, and is settled by its hash.  Only where phrases with one trigger differ (at the borders of
   repeats) does the order inside them matter; there each document's bytes of first occurrences are kept.
3. Order.  For each trigger the suffixes of its dictionary phrases are sorted by their first WIDTH bytes:
   with the parse (which phrases occur where) that is the corpus order to depth WIDTH.  Suffixes
   next to each other that agree in WIDTH bytes are one string, and its smallest document is found.
4. The documents' repeated windows are joined into spans and cut out.

Phrases with one trigger can only share a window if the SIDE bytes left of the trigger agree, or those
right of it, as a window has one or the other; one byte of a hash of each side rules out nearly all others.
Phrases travel packed, a block per batch and bucket of trigger hashes, so the shuffle carries about as many
bytes as the text has, and answers travel packed by buckets of documents.  A document's phrases spread over
all buckets, so large groups of copies do too.  There are so many buckets that each stands for BUCKET bytes of
text, and a task holds one bucket at a time.  A trigger with over HOT windows to compare (a passage of very many
documents, which differ around it) is not compared in one task: its windows are dealt by their own hashes, and
one aggregation finds the smallest document of each.

Edge cases: null and empty texts have nothing to remove; texts shorter than WIDTH are left whole, and texts of
any length are read whole; equal texts lose everything in all but the smallest document; rows with the same
doc_id do not count as earlier for each other; a null doc_id counts as larger than all; empty tables give
empty results; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinsift.llm.scratch import Scratch
from kinsift.llm.textkit import _BYTE, SAME, U, mix, powers, slices, span_hashes, text_bytes

WIDTH, GRAM = 50, 19
SPAN = WIDTH - GRAM + 1  # places of a trigger in a window: a power of two
SIDE = (WIDTH - GRAM) // 2  # a window has at least so many bytes left of its trigger, or more right of it
BUCKET, HOT = 64 << 20, 1 << 20
LAST = np.iinfo(np.int64).max
_CODEC = pa.Codec("zstd", 1)
_TURNED = SAME[::-1].copy()  # other values of the bytes, for a second hash


def phrases(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each phrase: trigger hash, content hash, document, place of its first window in it, number of windows, hashes of both sides (0: not known)."""
    n = len(data)
    sizes = np.diff(offsets)
    if n < WIDTH or not (sizes >= WIDTH).any():
        return tuple(np.zeros(0, t) for t in (U, U, np.int64, np.int64, np.int64, np.uint8, np.uint8))
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, U)
    np.cumsum(_BYTE[data] * down[:-1], out=sums[1:])
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * up[: n + 1 - GRAM])
    least, step = grams, 1
    while step < SPAN:  # the least of SPAN hashes from each place on, by doubling
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    edge = np.zeros(len(least) + 1, np.int8)
    full = sizes >= WIDTH
    edge[offsets[:-1][full]] += 1
    edge[offsets[1:][full] - WIDTH + 1] -= 1
    valid = np.cumsum(edge[:-1]) > 0
    begins = valid.copy()
    begins[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
    begins[offsets[:-1][full]] = True
    first = np.flatnonzero(begins)
    count = np.add.reduceat(valid.astype(np.int64), first)
    hashes = least[first]
    content = mix((sums[first + count + WIDTH - 1] - sums[first]) * up[first] + count.astype(U))
    doc = np.searchsorted(offsets, first, "right") - 1
    at = np.full(len(first), -1)
    for o in range(SPAN):
        new = (at < 0) & (grams[first + o] == hashes)
        at[new] = first[new] + o
    known = first + count - 1 <= at
    sides = []
    for a, b in ((at - SIDE, at), (at + GRAM, at + GRAM + SIDE)):
        # a phrase that ends before SIDE bytes has no window with them, and a hash of its own there
        inside = (a >= first) & (b <= first + count + WIDTH - 1)
        a, b = np.clip(a, 0, n), np.clip(b, 0, n)
        side = (mix((sums[b] - sums[a]) * up[a]) % U(254)).astype(np.uint8) + 1
        sides.append(np.where(known, np.where(inside, side, 255), 0).astype(np.uint8))
    return hashes, content, doc, first - offsets[doc], count, *sides


def squeeze(*arrays: np.ndarray) -> bytes:
    raw = b"".join(a.tobytes() for a in arrays)
    return struct.pack("<I", len(raw)) + _CODEC.compress(raw, asbytes=True)


def unsqueeze(data: bytes) -> memoryview:
    return memoryview(_CODEC.decompress(data[4:], struct.unpack("<I", data[:4])[0]))


def cut(buffer: memoryview, shapes: list[tuple[str, int]]) -> list[np.ndarray]:
    out, at = [], 0
    for kind, n in shapes:
        out.append(np.frombuffer(buffer, kind, n, at))
        at += np.dtype(kind).itemsize * n
    return out


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        yield int(bucket[part[0]]), part


def parse(buckets: int):
    """Documents to packed phrases: bucket, block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = text_bytes(batch.column(1))
            tags = np.array([zlib.crc32(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.uint32)
            h, c, doc, pos, count, left, right = phrases(data, offsets)
            own, rest, blocks = (h % U(buckets)).astype(np.int64), h // U(buckets), []
            for b, at in by_bucket(own):
                docs, times = np.unique(doc[at], return_counts=True)
                short = [x.astype(t) for x, t in ((rest[at], "<u4"), (rest[at] >> U(32), "u1"), (c[at], "<u4"), (c[at] >> U(32), "<u2"))]
                raw = b"".join(x.tobytes() for x in (*short, left[at], right[at]))
                blocks.append((b, struct.pack("<II", len(at), len(docs)) + raw + squeeze(ids[docs], tags[docs], times.astype("<u4"), pos[at].astype("<u4"), count[at].astype("<u4"))))
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in blocks], pa.int32()), pa.array([x for _, x in blocks], pa.binary())], ["bucket", "block"])

    return run


def read_block(block: bytes) -> list[np.ndarray]:
    """Trigger, content, left, right, doc_id, tag, pos, count of each phrase of a block."""
    n, docs = struct.unpack("<II", block[:8])
    h, h2, c, c2, left, right = cut(memoryview(block)[8:], [("<u4", n), ("u1", n), ("<u4", n), ("<u2", n), ("u1", n), ("u1", n)])
    ids, tags, times, pos, count = cut(unsqueeze(block[8 + 13 * n :]), [("<i8", docs), ("<u4", docs), ("<u4", docs), ("<u4", n), ("<u4", n)])
    return [h.astype(U) | h2.astype(U) << U(32), c.astype(U) | c2.astype(U) << U(32), left, right, np.repeat(ids, times), np.repeat(tags, times), pos, count]


def differs(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """For rows in this order, whether one begins a new key."""
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
    return new


def shared(doc: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Whether another document has a row with the same keys."""
    if not len(doc):
        return np.zeros(0, bool)
    order = np.lexsort((doc, *keys))
    starts = np.flatnonzero(differs(order, *keys))
    ends = np.append(starts[1:], len(order))
    out = np.zeros(len(doc), bool)
    out[order] = np.repeat(doc[order[starts]] != doc[order[ends - 1]], ends - starts)
    return out


def packed(doc: np.ndarray, tag: np.ndarray, pos: np.ndarray, count: np.ndarray, key: np.ndarray, buckets: int, kind: int) -> Iterator[tuple[int, int, bytes]]:
    """Answers for documents: bucket of the documents, kind, block."""
    for b, at in by_bucket(doc % buckets):
        yield b, kind, struct.pack("<I", len(at)) + squeeze(doc[at], tag[at].astype("<u4"), pos[at].astype("<u4"), count[at].astype("<u4"), key[at])


def answers(blocks: list[bytes]) -> list[np.ndarray]:
    """doc, tag, pos, count, key of packed answers, in order of doc and tag."""
    parts = [cut(unsqueeze(b[4:]), [("<i8", n), ("<u4", n), ("<u4", n), ("<u4", n), ("<u8", n)]) for b in blocks for n in struct.unpack("<I", b[:4])]
    if not parts:
        return [np.zeros(0, t) for t in ("<i8", "<u4", "<u4", "<u4", "<u8")]
    out = [np.concatenate(x) for x in zip(*parts, strict=True)]
    order = np.lexsort((out[1], out[0]))
    return [x[order] for x in out]


WHOLE, ASKED, SPREAD = 1, 0, 2
_ANSWER = "bucket int, kind int, block binary"


def rows_of(found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    b, k, x = zip(*found, strict=True) if found else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(k, pa.int32()), pa.array(x, pa.binary())], ["bucket", "kind", "block"])


def runs(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[int, list]]:
    """The second column's values for each run of the first, of batches sorted by it."""
    key, held = None, []
    for batch in batches:
        for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if k != key and held:
                yield key, held
                held = []
            key = k
            held.append(x)
    if held:
        yield key, held


def settle(buckets: int):
    """Blocks of phrases to answers: spans of phrases that a smaller document has (WHOLE), and phrases whose bytes must be compared (ASKED, or SPREAD for those of hot triggers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, blocks in runs(batches):
            h, c, left, right, doc, tag, pos, count = (np.concatenate(x) for x in zip(*map(read_block, blocks), strict=True))
            order = np.lexsort((doc, c, h))
            starts = np.flatnonzero(differs(order, h, c))
            lengths = np.diff(np.append(starts, len(order)))
            first = np.empty(len(doc), bool)
            first[order] = doc[order] == np.repeat(doc[order[starts]], lengths)
            found = list(packed(*(x[~first] for x in (doc, tag, pos, count)), np.zeros((~first).sum(), "<u8"), buckets, WHOLE))
            h, left, right, doc, tag, pos, count = (x[first] for x in (h, left, right, doc, tag, pos, count))
            with_unknown = np.isin(h, h[left == 0])
            ask = (shared(doc, left, h) & (left != 255)) | (shared(doc, right, h) & (right != 255)) | (with_unknown & shared(doc, h))
            triggers, own = np.unique(h[ask], return_inverse=True)
            hot = (np.bincount(own, count[ask], len(triggers)) > HOT)[own]
            for kind, part in ((ASKED, np.flatnonzero(ask)[~hot]), (SPREAD, np.flatnonzero(ask)[hot])):
                found += packed(*(x[part] for x in (doc, tag, pos, count)), h[part] * U(buckets) + U(bucket), buckets, kind)
            yield rows_of(found)

    return run


def documents_with(docs: DataFrame, blocks: DataFrame, buckets: int, tasks: int) -> DataFrame:
    """bucket, kind, doc_id, text, block: for each bucket the answers and then the documents."""
    kept = docs.select(F.pmod(F.col("doc_id"), F.lit(buckets)).cast("int").alias("bucket"), F.lit(2).alias("kind"), "doc_id", "text", F.lit(None).cast("binary").alias("block"))
    own = blocks.select("bucket", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "block")
    return own.unionByName(kept).repartition(tasks, "bucket").sortWithinPartitions("bucket", "kind")


def with_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, np.ndarray, list[np.ndarray]]]:
    """Each document: its doc_id, bytes, and its answers (tag, pos, count, key)."""
    bucket, blocks, held = None, [], None
    for batch in batches:
        keys, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        ids = batch.column(2).to_pylist()
        data, offsets = text_bytes(batch.column(3))
        for i in range(batch.num_rows):
            if keys[i] != bucket:
                bucket, blocks, held = keys[i], [], None
            if kinds[i] == 0:
                blocks.append(batch.column(4)[i].as_py())
                continue
            if held is None:
                held, blocks = answers(blocks), []
            text = data[offsets[i] : offsets[i + 1]]
            a, b = np.searchsorted(held[0], ids[i]), np.searchsorted(held[0], ids[i], "right")
            tag, pos, count, key = (x[a:b] for x in held[1:])
            own = tag == zlib.crc32(text) if b > a else tag == 0
            yield ids[i], text, [x[own] for x in (pos, count, key)]


def dictionary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The asked phrases' bytes: trigger, doc_id, tag, pos, bytes."""
    out: list[tuple] = []

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["trigger", "doc_id", "tag", "pos", "bytes"])

    for doc, text, (pos, count, key) in with_answers(batches):
        if len(pos):
            tag = zlib.crc32(text)
            for p, n, k in zip(pos.tolist(), count.tolist(), key.view("<i8").tolist(), strict=True):
                out.append((k, doc, tag, p, text[p : p + n + WIDTH - 1].tobytes()))
            if len(out) > 20_000:
                yield batch_of()
                out.clear()
    if out:
        yield batch_of()


def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of the asked phrases: 128 bits of hash, doc_id, tag, pos."""
    for doc, text, (pos, count, _) in with_answers(batches):
        for a in range(0, len(pos), 10_000):
            part = count[a : a + 10_000].astype(np.int64)
            if not len(part):
                continue
            places = np.repeat(pos[a : a + 10_000].astype(np.int64) - (np.cumsum(part) - part), part) + np.arange(part.sum())
            hashes = [span_hashes(text, places, places + WIDTH, fold) for fold in (SAME, _TURNED)]
            same = pa.array(np.full(len(places), doc)), pa.array(np.full(len(places), zlib.crc32(text), np.int64))
            yield pa.RecordBatch.from_arrays([*(pa.array(h.view(np.int64)) for h in hashes), *same, pa.array(places)], ["wa", "wb", "doc_id", "tag", "pos"])


def pack(buckets: int):
    """doc_id, tag, pos of single windows to answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tag, pos = (batch.column(i).to_numpy() for i in range(3))
            yield rows_of(list(packed(doc, tag, pos, np.ones(len(doc), np.int64), np.zeros(len(doc), "<u8"), buckets, WHOLE)))

    return run


def suffix_order(doc: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of phrases in suffix order: phrase, place in it, and whether a smaller document has it.

    The suffixes are sorted by their first WIDTH bytes; those next to each other and equal are one string.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    counts = np.array([len(t) - WIDTH + 1 for t in texts])
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]]).astype(np.int64)
    phrase = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(phrase)) - np.repeat(np.cumsum(counts) - counts, counts)
    words = np.empty((len(phrase), WIDTH + 1), np.uint8)
    words[:, :WIDTH] = np.lib.stride_tricks.sliding_window_view(data, WIDTH)[np.repeat(starts, counts) + place]
    words[:, WIDTH] = 1  # numpy leaves out zero bytes at the end
    suffix = words.view(f"S{WIDTH + 1}").ravel()
    order = np.argsort(suffix, kind="stable")
    phrase, place, suffix = phrase[order], place[order], suffix[order]
    new = np.ones(len(order), bool)
    new[1:] = suffix[1:] != suffix[:-1]
    at = np.flatnonzero(new)
    owner = doc[phrase]
    return phrase, place, owner > np.repeat(np.minimum.reduceat(owner, at), np.diff(np.append(at, len(order))))


def compare(buckets: int, most: int = 100_000):
    """Phrases with their bytes, sorted by trigger, to spans of windows that a smaller document has."""

    def answer(columns: list[list]) -> pa.RecordBatch:
        doc, tag, pos = (np.array(x, np.int64) for x in columns[1:4])
        phrase, place, again = suffix_order(doc, columns[4])
        phrase, place = phrase[again], place[again]
        order = np.lexsort((place, phrase))
        phrase, place = phrase[order], place[order]
        new = np.ones(len(phrase), bool)
        new[1:] = (phrase[1:] != phrase[:-1]) | (place[1:] != place[:-1] + 1)
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(phrase)))
        phrase, place = phrase[at], place[at]
        return rows_of(list(packed(doc[phrase], tag[phrase], pos[phrase] + place, count, np.zeros(len(at), "<u8"), buckets, WHOLE)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], []]
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if size > most and row[0] != held[0][-1]:  # only whole groups
                    yield answer(held)
                    held, size = [[], [], [], [], []], 0
                for x, v in zip(held, row, strict=True):
                    x.append(v)
                size += len(row[4]) - WIDTH + 1
        if held[0]:
            yield answer(held)

    return run


def remove(with_bytes: bool):
    """Documents with their spans to what is left of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * with_bytes
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_bytes
        size = 0
        for doc, text, (pos, count, _) in with_answers(batches):
            edge = np.zeros(len(text) + 1, np.int32)
            np.add.at(edge, pos, 1)
            np.subtract.at(edge, pos.astype(np.int64) + count + WIDTH - 1, 1)
            gone = np.cumsum(edge[:-1]) > 0
            kept = text[~gone].tobytes()
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            out.append((None if doc == LAST else doc, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), *[kept] * with_bytes))
            size += len(kept) * with_bytes
            if len(out) >= 5000 or size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return run


def remove_repeats(docs: DataFrame, with_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes) of each row of docs."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(partitions, -(-size // BUCKET))
    buckets = max(2 * partitions, tasks)
    parsed = rows.mapInArrow(parse(buckets), "bucket int, block binary").repartition(tasks, "bucket").sortWithinPartitions("bucket")
    settled = scratch.stage(parsed.mapInArrow(settle(buckets), _ANSWER), "settled")
    del parsed
    scratch.release()
    asked = documents_with(rows, settled.filter(F.col("kind") == ASKED), buckets, tasks).mapInArrow(dictionary, "trigger long, doc_id long, tag long, pos long, bytes binary")
    windows = scratch.stage(asked.repartition(tasks, "trigger").sortWithinPartitions("trigger").mapInArrow(compare(buckets), _ANSWER), "windows")
    del asked
    scratch.release()
    spans = settled.filter(F.col("kind") == WHOLE).unionByName(windows)
    hot = settled.filter(F.col("kind") == SPREAD)
    if not hot.isEmpty():
        single = scratch.stage(documents_with(rows, hot, buckets, tasks).mapInArrow(spread, "wa long, wb long, doc_id long, tag long, pos long"), "single")
        first = single.groupBy("wa", "wb").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").select("wa", "wb", "first")
        again = single.join(first.hint("merge"), ["wa", "wb"]).filter("doc_id > first").select("doc_id", "tag", "pos")
        spans = spans.unionByName(scratch.stage(again.mapInArrow(pack(buckets), _ANSWER), "spread"))
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    return documents_with(rows, spans, buckets, tasks).mapInArrow(remove(with_bytes), result)


def op2_parsed_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all documents without repeated 50-byte strings."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
