"""Benchmark decontamination by CGK embeddings and bit-sampling LSH.

Texts and items are sequences of words (runs of letters and digits, A-Z lower-cased).  A document is
contaminated by an item if a part of it is within RATE of the item's words in edit distance.

1. Seeds: of m words with k edits, m - 2 - 3k triples survive; so windows with fewer of the benchmark's
   triples within m + k words are out, without loss.  Windows begin where a run of known triples does, at
   every STRIDE words of it, and a few words before it.
2. CGK: a random walk reads a window of the item's size; each step copies the word at the walk's place and
   moves on or not, as a random function of step and word says.  Sequences a few edits apart fall in step
   again, so edit distance becomes Hamming distance.
3. LSH: SAMPLE random places of the embedding make a key; windows and items of the same size that share a
   key are candidates.  Items are classed by size, and each class has as many embeddings as bring RECALL:
   copies of its items with RATE random edits are planted between random words, and the share whose
   windows, as chosen above, meet the item under one embedding is measured when the tables are built.
4. Candidates are confirmed by the exact edit distance (Myers' bit vectors) to any part near the window.

Items of at most SHORT words, of which edits may leave no triple, are found without loss: as they are,
without one word, with one word changed, or with one more between (only items of 5 words may have an edit).

The benchmark goes to the executors in blocks of at most ITEMS items and WORDS words, one after another: of
several blocks, each one's finds are written before the next is sent, so what is broadcast is bounded.

Edge cases: null and empty texts and items without words match nothing; an item of 1 to 4 words only matches
itself word for word; equal items are all reported, each once however often a text has it; repeated rows and
texts of any length are judged alike, by the whole text; an empty benchmark leaves all clean.  ``screen`` keeps
other columns (names that it adds are replaced).
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinsift.llm.scratch import Scratch
from kinsift.llm.textkit import LOWER, U, mix, slices, span_hashes, spans, text_bytes, windows

RATE, RECALL = 0.2, 0.999
SAMPLE, KEYS, STRIDE, ITEMS, WORDS, SHORT = 2, 8, 4, 20_000, 2_000_000, 5
#: Windows also begin so many words before a run of known triples, in case its first words were edited.
BEFORE = (2, 4, 7)
_OTHER = np.ones(256, bool)
_OTHER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
PAD = U(0x5BD1E9955BD1E995)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's begin."""
    data, offsets = text_bytes(column)
    starts, ends = spans(data, offsets, _OTHER)
    return span_hashes(data, starts, ends, LOWER), np.searchsorted(starts, offsets)


def embed(words: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """CGK embeddings of rows of words; a row of size m uses m words and 2m places."""
    n, most = words.shape
    padded = np.concatenate([words, np.full((n, 1), PAD)], axis=1)
    padded[np.arange(most + 1) >= sizes[:, None]] = PAD
    steps = np.random.Generator(np.random.PCG64(seed)).integers(1, 2**63, 1 << 16, dtype=np.uint64) * U(2) + U(1)
    rows, at = np.arange(n), np.zeros(n, np.int64)
    out = np.empty((2 * most, n), np.uint64)
    for j in range(2 * most):
        out[j] = padded[rows, at]
        at = np.minimum(at + (mix(out[j] * steps[j % len(steps)]) >> U(63)).astype(np.int64), sizes)
    return out


def keys(words: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """KEYS LSH keys of each row: hashes of its size and of SAMPLE places of its embedding."""
    e = embed(words, sizes, seed)
    at = np.random.Generator(np.random.PCG64(seed + 1_000_003)).random((KEYS, SAMPLE))
    rows = np.arange(len(sizes))
    out = np.empty((len(sizes), KEYS), np.uint64)
    for k in range(KEYS):
        total = mix(sizes.astype(U) * U(64) + U(k))
        for s in range(SAMPLE):
            total = mix(total * U(0x9E3779B97F4A7C15) + e[(at[k, s] * 2 * sizes).astype(np.int64), rows])
        out[:, k] = total
    return out


def edits(m: int) -> int:
    return int(RATE * m)


def distance(item: np.ndarray, text: np.ndarray) -> int:
    """The least edit distance between item and any part of text."""
    at: dict[int, int] = defaultdict(int)
    for i, w in enumerate(item.tolist()):
        at[w] |= 1 << i
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best = m
    for w in text.tolist():
        eq = at.get(w, 0)
        x = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | ~(x | up) & full, up & x
        score += bool(plus & top) - bool(minus & top)
        best = min(best, score)
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = minus | ~(x | plus) & full, plus & x
    return best


FACTOR = 0xD6E8FEB86659FD93


def patterned(h: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    """For each place a hash of the words at these offsets from it, in order (the last places are left out)."""
    n = max(0, len(h) - offsets[-1])
    total, factor = np.zeros(n, U), 1
    for o in offsets:
        factor = factor * FACTOR % 2**64
        total += h[o : o + n] * U(factor)
    return mix(total + U(len(offsets)))


class Short:
    """Items of one size of at most SHORT words, by their own words and what one edit leaves of them."""

    def __init__(self, size: int, items: list[tuple[int, np.ndarray]]):
        every = tuple(range(size))
        #: words of an item that must stand at these places of a text
        self.rules: list[tuple[tuple[int, ...], tuple[int, ...]]] = [(every, every)]
        if edits(size):
            for i in every:  # one word less
                self.rules.append((tuple(x for x in every if x != i), tuple(range(size - 1))))
            for i in every[1:-1]:  # another word
                self.rules.append((tuple(x for x in every if x != i),) * 2)
            for i in every[1:]:  # one word more
                self.rules.append((every, tuple(x + (x >= i) for x in every)))
        self.tables: dict[tuple[int, ...], list[tuple[int, int]]] = defaultdict(list)
        for own, places in self.rules:
            for x, words in items:
                self.tables[places].append((int(patterned(words[list(own)], tuple(range(len(own))))[0]), x))

    def find(self, h: np.ndarray, of: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Text, place and item of each place that fits."""
        for places, entries in self.tables.items():
            if len(h) <= places[-1]:
                continue
            entries = sorted(entries)
            wanted, owner = np.array([k for k, _ in entries], U), [x for _, x in entries]
            got = patterned(h, places)
            lo = np.searchsorted(wanted, got)
            for at in np.flatnonzero(wanted[np.minimum(lo, len(wanted) - 1)] == got).tolist():
                text = int(np.searchsorted(of, at, "right")) - 1
                if at + places[-1] < of[text + 1]:
                    for i in range(int(lo[at]), int(np.searchsorted(wanted, got[at], "right"))):
                        yield text, at, owner[i]


class Screen:
    """Tables of a block of benchmark items."""

    def __init__(self, ids: list[int], texts: pa.Array):
        h, of = word_hashes(texts)
        self.items = [(i, h[of[n] : of[n + 1]]) for n, i in enumerate(ids) if of[n + 1] > of[n]]
        self.words = [frozenset(w.tolist()) for _, w in self.items]
        number: dict[int, list[int]] = defaultdict(list)
        for x, (_, w) in enumerate(self.items):
            number[len(w)].append(x)
        self.short = [Short(m, [(x, self.items[x][1]) for x in number[m]]) for m in sorted(number) if m <= SHORT]
        self.sizes = np.array(sorted(m for m in number if m > SHORT), np.int64)
        self.edits = np.array([edits(m) for m in self.sizes.tolist()], np.int64)
        self.kind = np.array([m.bit_length() for m in self.sizes.tolist()], np.int64)  # the class of each size
        long = [w for _, w in self.items if len(w) > SHORT]
        self.triples = np.unique(np.concatenate([windows(w, 3) for w in long])) if long else np.zeros(0, U)
        self.tables: dict[int, list[list[tuple[np.ndarray, np.ndarray]]]] = {}
        for kind in sorted(set(self.kind.tolist())):
            own = np.array([x for m in self.sizes[self.kind == kind].tolist() for x in number[m]])
            rows, sizes = self._rows([self.items[x][1] for x in own.tolist()])
            self.tables[kind] = []
            for seed in range(self.needed(own.tolist())):
                k = keys(rows, sizes, seed)
                orders = [np.argsort(k[:, j], kind="stable") for j in range(KEYS)]
                self.tables[kind].append([(k[o, j], own[o]) for j, o in enumerate(orders)])

    @staticmethod
    def _rows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(t) for t in texts], np.int64)
        out = np.full((len(texts), int(sizes.max()) if len(texts) else 1), PAD)
        for row, t in zip(out, texts, strict=True):
            row[: len(t)] = t
        return out, sizes

    def needed(self, own: list[int]) -> int:
        """Embeddings for RECALL of these items, by the share of edited copies of them that one finds."""
        draw = np.random.Generator(np.random.PCG64(11))
        noise = lambda n: draw.integers(1, 2**63, n, dtype=np.uint64)
        chosen = own[:: max(1, len(own) // 200)] * max(1, 100 // len(own))
        texts = []
        for x in chosen:
            words = self.items[x][1]
            other = words.tolist()
            for _ in range(edits(len(words))):
                at, change = int(draw.integers(0, len(other))), int(draw.integers(0, 3))
                other[at : at + (change != 1)] = [int(noise(1)[0])] if change else []
            texts.append(np.concatenate([noise(20), np.array(other, U), noise(20)]))
        h, of = np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        begin, text, size = self._windows(h, of)
        wanted = np.array([len(self.items[x][1]) for x in chosen])
        fits = self.sizes[size] == wanted[text]
        begin, text = begin[fits], text[fits]
        rows, sizes = self._rows([self.items[x][1] for x in chosen])
        places = begin[:, None] + np.arange(rows.shape[1])
        near = np.where(places < of[text + 1][:, None], h[np.minimum(places, len(h) - 1)], PAD)
        met = 0
        for seed in range(4):
            same = (keys(near, sizes[text], seed) == keys(rows, sizes, seed)[text]).any(axis=1)
            met += len(np.unique(text[same]))
        p = min(max(met / (4 * len(chosen)), 0.02), 0.999)
        return max(2, math.ceil(math.log(1 - RECALL) / math.log(1 - p)))

    def _windows(self, h: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where windows begin, their texts and the numbers of their sizes."""
        none = (np.zeros(0, np.int64),) * 3
        if len(h) < 3 or not len(self.sizes):
            return none
        known = np.zeros(len(h), bool)
        t = windows(h, 3)
        at = np.minimum(np.searchsorted(self.triples, t), len(self.triples) - 1)
        known[: len(t)] = self.triples[at] == t
        for d in (1, 2):  # triples across texts
            inner = of[1:] - d
            known[inner[(inner >= 0) & (of[1:] > of[:-1])]] = False
        sums = np.concatenate([[0], np.cumsum(known)])
        need = np.maximum(1, self.sizes - 2 - 3 * self.edits)
        places = np.flatnonzero(known)
        if not len(places):
            return none
        run = np.concatenate([[True], places[1:] != places[:-1] + 1])
        begun = places[run][np.cumsum(run) - 1]
        text_of = np.searchsorted(of, places, "right") - 1
        chosen = ((places - begun) % STRIDE == 0) & (sums[of[text_of + 1]] - sums[places] >= need.min())
        places, text_of, run = places[chosen], text_of[chosen], run[chosen]
        early = [(np.maximum(places[run] - d, of[text_of[run]]), text_of[run]) for d in BEFORE]
        begin, text = np.concatenate([places, *(x for x, _ in early)]), np.concatenate([text_of, *(x for _, x in early)])
        near = sums[np.minimum(begin[:, None] + self.sizes + self.edits, of[text + 1][:, None])] - sums[begin][:, None]
        window, size = np.nonzero(near >= need)
        return begin[window], text[window], size

    def hits(self, column: pa.Array) -> list[list[int]]:
        """For each text the ids of items that it has."""
        h, of = word_hashes(column)
        found: list[set[int]] = [set() for _ in range(len(of) - 1)]
        for short in self.short:
            for text, at, x in short.find(h, of):
                self._confirm(h, of, at, text, x, found)
        begin, text, size = self._windows(h, of)
        for kind in self.tables:
            own = np.flatnonzero(self.kind[size] == kind)
            for a in range(0, len(own), 20_000):
                part = own[a : a + 20_000]
                self._match(kind, h, of, begin[part], text[part], self.sizes[size[part]], found)
        return [sorted(f) for f in found]

    def _match(self, kind: int, h: np.ndarray, of: np.ndarray, begin: np.ndarray, text: np.ndarray, sizes: np.ndarray, found: list[set[int]]) -> None:
        """Adds the items of a class that windows share a key with and are close to."""
        index = begin[:, None] + np.arange(int(sizes.max()))
        words = np.where(index < of[text + 1][:, None], h[np.minimum(index, len(h) - 1)], PAD)
        pairs: set[tuple[int, int]] = set()
        for seed, table in enumerate(self.tables[kind]):
            own = keys(words, sizes, seed)
            for j, (sorted_keys, owners) in enumerate(table):
                lo, hi = np.searchsorted(sorted_keys, own[:, j]), np.searchsorted(sorted_keys, own[:, j], "right")
                for w in np.flatnonzero(hi > lo).tolist():
                    pairs.update((w, int(x)) for x in owners[lo[w] : hi[w]])
        for w, x in sorted(pairs):
            self._confirm(h, of, int(begin[w]), int(text[w]), x, found)

    def _confirm(self, h: np.ndarray, of: np.ndarray, begin: int, text: int, x: int, found: list[set[int]]) -> None:
        """Adds item x to a text's finds, if a part near the place is close enough."""
        item, words = self.items[x]
        if item in found[text]:
            return
        m = len(words)
        near = h[max(int(of[text]), begin - m) : min(int(of[text + 1]), begin + 2 * m + edits(m))]
        # k edits leave m - k of the item's words, so fewer different ones can't be close
        if len(self.words[x].intersection(near.tolist())) >= len(self.words[x]) - edits(m) and distance(words, near) <= edits(m):
            found[text].add(item)


def blocks(benchmark: DataFrame) -> Iterator[Screen]:
    """Screens of the benchmark's items, at most ITEMS items and about WORDS words at a time, in item_id order."""
    rows = benchmark.select(F.col("item_id").cast("long"), "text").filter("item_id is not null and text is not null").orderBy("item_id").toLocalIterator()
    ids: list[int] = []
    texts: list[str] = []
    words = 0
    for r in rows:
        ids.append(r[0])
        texts.append(r[1])
        words += len(r[1]) // 4 + 1
        if len(ids) == ITEMS or words > WORDS:
            yield Screen(ids, pa.array(texts, pa.string()))
            ids, texts, words = [], [], 0
    if ids:
        yield Screen(ids, pa.array(texts, pa.string()))


def searched(rows: DataFrame, shared: Broadcast, only_found: bool = False) -> DataFrame:
    """rows with item_ids, the items of a block that each text has; a map without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = shared.value.hits(batch.column(batch.schema.get_field_index("text")))
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int64()))], [*batch.schema.names, "item_ids"])
            yield out.filter(pa.array([bool(f) for f in found])) if only_found else out

    return rows.mapInArrow(run, T.StructType(list(rows.schema)).add("item_ids", T.ArrayType(T.LongType())))


def screen(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs with item_ids array<long> (the items found) and contaminated."""
    docs = docs.drop("item_ids", "contaminated")
    none = F.array().cast("array<long>")
    several = blocks(benchmark)
    context = docs.sparkSession.sparkContext
    first, second = next(several, None), next(several, None)
    if first is None:
        out = docs.withColumn("item_ids", none)
    elif second is None:
        out = searched(docs, context.broadcast(first))
    else:
        scratch, found = Scratch(docs.sparkSession), None
        texts = docs.select(*_text_keys(), "text")
        for k, block in enumerate(chain((first, second), several)):
            shared = context.broadcast(block)
            part = scratch.stage(searched(texts, shared, only_found=True).drop("text"), f"found{k}")
            shared.destroy()  # its finds are written
            found = part if found is None else found.unionByName(part)
        found = found.select("_a", "_b", F.explode("item_ids").alias("item")).groupBy("_a", "_b").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
        # the row travels in a struct, so that none of its columns is taken for one of those made here
        rows = docs.select(F.struct(*docs.columns).alias("_row"), *_text_keys())
        out = rows.join(found.hint("merge"), ["_a", "_b"], "left").select("_row.*", F.coalesce("item_ids", none).alias("item_ids"))
    return out.withColumn("contaminated", F.size("item_ids") > 0)


def _text_keys() -> tuple[Column, Column]:
    """128 bits that stand for a text."""
    return F.xxhash64("text").alias("_a"), F.xxhash64("text", F.lit(7)).alias("_b")


def op6_edit_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: contaminated, how many items, and which."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = screen(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "contaminated", F.size("item_ids").cast("long").alias("n_items"), F.array_join(F.col("item_ids").cast("array<string>"), ",").alias("item_ids"))
