"""Candidate generation: every strategy returns (country, s1_id, cand_id[, score])."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinsift import schema
from kinsift.functions import text
from kinsift.operators import blocks

KEYS = ("country", "s1_id", "cand_id")
PRIME = 2**31 - 1
PAIRS = 4_000_000  # of one key in one task
LISTED = 2048  # rows of a list of ``meet_lists``, about
BLOCK = 4096  # rows of s1 that a task holds
RANKED = 200_000  # rows that a task ranks at once


class PairBudgetExceeded(RuntimeError):
    """A join would make more pairs than its budget."""


def sides(s1: DataFrame, pool: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(country, id, value) of both sides, without rows of no country."""
    return tuple(d.filter(F.col(schema.COUNTRY).isNotNull()).select(F.col(schema.COUNTRY).alias("country"), F.col(schema.ID).alias("id"), F.col(column).alias("value")) for d in (s1, pool))


def check_budget(left: DataFrame, right: DataFrame, keys: list[str], budget: int) -> None:
    """Raises PairBudgetExceeded if a join would make more pairs (n1 * n2, over keys)."""
    sizes = left.groupBy(*keys).agg(F.count("*").alias("a")).join(right.groupBy(*keys).agg(F.count("*").alias("b")), keys)
    pairs = sizes.agg(F.sum(F.col("a").cast("decimal(38,0)") * F.col("b"))).first()[0] or 0
    if pairs > budget:
        raise PairBudgetExceeded(f"{pairs} pairs; the budget is {budget}")


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], budget: int | None = None) -> DataFrame:
    """Distinct (country, s1_id, cand_id) that share a key.

    budget: the most pairs, counted over keys (n1 * n2) before the join; more raises PairBudgetExceeded.
    """
    if budget is not None:
        check_budget(left, right, keys, budget)
    joined = left.withColumnRenamed("id", "s1_id").join(right.withColumnRenamed("id", "cand_id"), keys)
    return joined.select(*KEYS).distinct()


def exact_blocking(s1: DataFrame, pool: DataFrame, column: str = "name_clean") -> DataFrame:
    """Pairs with equal, non-empty values."""
    left, right = (d.filter("value <> ''") for d in sides(s1, pool, column))
    return join_on_keys(left, right, ["country", "value"])


def keyed(tokens: list[DataFrame], allowed: DataFrame, budget: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(country, id, keys) of both sides: the sorted keys that both sides have, with the number of parts each is dealt into.

    tokens: distinct (country, id, token); allowed: (country, token, df) of the right side, df its number of rows.
    budget: the most pairs, counted over keys (n1 * n2); more raises PairBudgetExceeded.
    """
    sizes = tokens[0].groupBy("country", "token").agg(F.count("*").alias("a")).join(allowed.withColumnRenamed("df", "b"), ["country", "token"])
    if budget is not None:
        pairs = sizes.agg(F.sum(F.col("a").cast("decimal(38,0)") * F.col("b"))).first()[0] or 0
        if pairs > budget:
            raise PairBudgetExceeded(f"{pairs} pairs; the budget is {budget}")
    lists = lambda n: F.ceil(F.col(n) / F.lit(float(LISTED)))
    sizes = sizes.select("country", "token", F.greatest(F.ceil(F.col("a") * F.col("b") / F.lit(float(PAIRS))), lists("a")).cast("int").alias("parts"), lists("b").cast("int").alias("lists"))
    return tuple(t.join(sizes, ["country", "token"]).groupBy("country", "id").agg(F.array_sort(F.collect_list(F.struct("token", "parts", "lists"))).alias("keys")) for t in tokens)


def meet(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each pair of a left and a right row of one country that share a key, once; no pair is shuffled.

    left, right: country, keys (of ``keyed``) and other columns, whose names differ.  A row goes to each of its keys, with those
    before it, and a pair is made at the first key that both have.  Where a key makes over PAIRS pairs, its left
    rows are dealt out and its right rows go to each part.
    """
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(d: DataFrame, side: int) -> DataFrame:
        own = [c for c in d.columns if c not in ("country", "keys")]
        before = F.transform(F.slice("keys", F.lit(1), F.col("_at")), lambda k: k["token"]).alias(f"_before{side}")
        at = d.select("country", *own, "keys", F.posexplode("keys").alias("_at", "_key")).select("country", *own, before, "_key.*")
        part = F.pmod(F.xxhash64(*own), F.col("parts")) if side == 1 else F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1))
        # with a number of partitions, as pairs are much work on few bytes
        return at.select("country", "token", part.alias("_part"), f"_before{side}", *own).repartition(n, "country", "token", "_part")

    joined = dealt(left, 1).join(dealt(right, 2).hint("merge"), ["country", "token", "_part"])
    return joined.filter(~F.arrays_overlap("_before1", "_before2")).drop("token", "_part", "_before1", "_before2")


def meet_lists(left: DataFrame, right: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], kind: str) -> DataFrame:
    """What `run` (see ``pairs``) makes of the pairs of ``meet``: keys are joined as lists of rows, in which no pair stands yet.

    left, right: country, keys and s1_id or cand_id, and other columns.
    """
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def listed(d: DataFrame, side: int) -> DataFrame:
        own = [c for c in d.columns if c not in ("country", "keys")]
        hashed = F.xxhash64(own[0])
        before = F.transform(F.slice("keys", F.lit(1), F.col("_at")), lambda k: k["token"]).alias("_before")
        at = d.select("country", *own, "keys", F.posexplode("keys").alias("_at", "_key")).select("country", *own, before, "_key.*")
        part = F.pmod(hashed, F.col("parts")) if side == 1 else F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1))
        of = F.lit(0) if side == 1 else F.pmod(hashed, F.col("lists"))
        rows = at.select("country", "token", part.alias("_part"), of.alias("_list"), F.struct(*own, "_before").alias("_row")).repartition(n, "country", "token", "_part")
        return rows.groupBy("country", "token", "_part", "_list").agg(F.collect_list("_row").alias(f"_rows{side}")).drop("_list")

    joined = listed(left, 1).join(listed(right, 2).hint("merge"), ["country", "token", "_part"])
    return joined.select("_rows1", "_rows2").mapInArrow(run, kind)


def token_keys(s1: DataFrame, pool: DataFrame, column: str, most: float, stopwords: tuple[str, ...], budget: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(country, id, keys) of both sides: the tokens that at most int(most * n) of the country's n pool rows have."""
    left, right = sides(s1, pool, column)
    tokens = [d.select("country", "id", F.explode(text.blocking_tokens(F.col("value"), stopwords=stopwords)).alias("token")).distinct() for d in (left, right)]
    cutoff = right.groupBy("country").agg(F.floor(F.count("*") * F.lit(float(most))).alias("cutoff"))
    rare = tokens[1].groupBy("country", "token").agg(F.count("*").alias("df")).join(cutoff, "country").filter("df <= cutoff").select("country", "token", "df")
    return keyed(tokens, rare, budget)


def token_blocking(s1: DataFrame, pool: DataFrame, column: str = "name_no_accent", most: float = schema.TOKEN_FREQUENCY, stopwords: tuple[str, ...] = text.STOPWORDS, budget: int | None = None) -> DataFrame:
    """Pairs that share a token which at most int(most * n) of the country's n pool rows have."""
    left, right = token_keys(s1, pool, column, most, stopwords, budget)
    return meet(left.withColumnRenamed("id", "s1_id"), right.withColumnRenamed("id", "cand_id")).select(*KEYS)


def long_token_blocking(s1: DataFrame, pool: DataFrame, column: str = "name_no_accent", most: float = schema.TOKEN_FREQUENCY, stopwords: tuple[str, ...] = text.STOPWORDS) -> DataFrame:
    """The pairs of token_blocking, for texts of many tokens: a text goes to blocks of the other side, not to each of its tokens."""
    both = sides(s1, pool, column)
    cutoff = both[1].groupBy("country").agg(F.floor(F.count("*") * F.lit(float(most))).alias("cutoff"))
    left, right = (d.select("country", "id", F.array_join(text.blocking_tokens(F.col("value"), stopwords=stopwords), " ").alias("value")) for d in both)
    # an id counts once for a token, whatever its rows
    texts = right.groupBy("country", "id").agg(F.array_join(F.collect_list("value"), " ").alias("value"))
    counts = texts.select("country", F.explode(F.array_distinct(F.split("value", " "))).alias("value")).groupBy("country", "value").agg(F.count("*").alias("df"))
    frequent = counts.join(F.broadcast(cutoff), "country").filter("df > cutoff").select("country", "value")
    return blocks.in_blocks(left, texts, blocks.sharing(blocks.words), schema.PAIR, BLOCK * 8, BLOCK * 8, frequent)


def address_blocking(s1: DataFrame, pool: DataFrame, most: float = schema.TOKEN_FREQUENCY, column: str = "addr_no_accent") -> DataFrame:
    """Token blocking over addresses; rows without one have no tokens."""
    return token_blocking(s1, pool, column, most, stopwords=())


def jaccard_join(s1: DataFrame, pool: DataFrame, column: str = "name_no_accent", least: float = schema.LSH_THRESHOLD, n: int = schema.SHINGLE) -> DataFrame:
    """Pairs whose sets of character shingles have a Jaccard similarity of `least` or more, exactly, with score.

    Sets are compared once for each distinct pair of a block's names; no pair is shuffled (see ``blocks``).
    """
    left, right = (d.withColumn("value", F.coalesce("value", F.lit(""))) for d in sides(s1, pool, column))
    return blocks.in_blocks(left, right, blocks.jaccard(least, n), f"{schema.PAIR}, score double", BLOCK, BLOCK * 8)


def permutations(n: int) -> list[tuple[int, int]]:
    """n pairs (a, b) of the hash functions x -> (a * x + b) mod PRIME, by a rule of their own."""
    out, x = [], 1
    for _ in range(2 * n):
        x = x * 48271 % PRIME
        out.append(x)
    return list(zip(out[::2], out[1::2], strict=True))


def minhash_signature(grams: Column, n: int = schema.NUM_PERM) -> Column:
    """n MinHash values of an array of shingles; a shingle's number is the first 28 bits of its MD5."""
    numbers = F.transform(grams, lambda g: F.conv(F.substring(F.md5(g.cast("binary")), 1, 7), 16, 10).cast("long"))
    pairs = F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in permutations(n)])
    # bound as one element, so that the numbers are made once
    return F.flatten(F.transform(F.array(numbers), lambda own: F.transform(pairs, lambda p: F.array_min(F.transform(own, lambda x: (p["a"] * x + p["b"]) % PRIME)))))


def minhash_blocking(s1: DataFrame, pool: DataFrame, column: str = "name_no_accent", bands: int = schema.BANDS, rows: int = schema.ROWS, parity: bool = True, budget: int | None = None) -> DataFrame:
    """Pairs whose MinHash signatures agree in a band; not verified further.

    Signatures are made once per distinct name; no pair is shuffled (see ``blocks``).  parity=False leaves out empty
    names, which all collide.  budget: the most pairs, counted over bands before the join (see join_on_keys).
    """
    signed = []
    for side in sides(s1, pool, column):
        side = side.withColumn("value", F.coalesce("value", F.lit("")))
        if not parity:
            side = side.filter("value <> ''")
        names = side.select("value").distinct().withColumn("sig", minhash_signature(text.shingles(F.col("value")), bands * rows).cast("array<int>"))
        signed.append(side.join(names, "value").select("country", "id", F.col("sig").alias("value")))
    if budget is not None:
        band = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.slice("value", i * rows + 1, rows))).alias("band", "bucket")
        check_budget(*(d.select("country", band) for d in signed), ["country", "band", "bucket"], budget)
    return blocks.in_blocks(*signed, blocks.sharing(blocks.bands(bands, rows)), schema.PAIR, BLOCK * 2, BLOCK * 8)


def most_frequent(vocabulary: DataFrame, features: int) -> DataFrame:
    """The grams (country, gram, df, times) of each country with the most `times`, ties by gram; at most so many.

    No task ranks a country's whole vocabulary: a histogram of `times` tells which are in, and only grams of the
    count at the border are ranked, within those of the same first two characters.
    """
    by_times = vocabulary.groupBy("country", "times").agg(F.count("*").alias("_n"))
    above = F.sum("_n").over(Window.partitionBy("country").orderBy(F.desc("times"))) - F.col("_n")
    by_times = by_times.withColumn("_room", features - above).filter("_room > 0").select("country", "times", "_n", "_room")
    placed = vocabulary.join(by_times, ["country", "times"])
    whole, border = placed.filter("_n <= _room"), placed.filter("_n > _room").withColumn("_start", F.substring("gram", 1, 2))
    starts = border.groupBy("country", "_start").agg(F.count("*").alias("_k"))
    starts = starts.withColumn("_before", F.sum("_k").over(Window.partitionBy("country").orderBy("_start")) - F.col("_k"))
    inside = F.row_number().over(Window.partitionBy("country", "_start").orderBy("gram"))
    some = border.join(starts, ["country", "_start"]).withColumn("_rank", F.col("_before") + inside).filter("_rank <= _room")
    return whole.select(*vocabulary.columns).unionByName(some.select(*vocabulary.columns))


def tfidf_blocking(s1: DataFrame, pool: DataFrame, column: str = "name_no_accent", k: int = schema.TFIDF_TOP, least: float = schema.TFIDF_LEAST, grams: tuple[int, int] = schema.TFIDF_GRAMS, features: int = schema.TFIDF_FEATURES) -> DataFrame:
    """For each record of s1 the k pool records of the highest TF-IDF cosine of `least` or more (ties: by id), with score.

    Weights have sublinear tf, smooth idf over distinct names of both sides, and length one.  Every name of the pool is
    compared with every name of a block of s1, which keeps the k best: no pair is shuffled, nor are weights.
    """
    left, right = (d.withColumn("value", F.coalesce("value", F.lit(""))) for d in sides(s1, pool, column))
    names = left.select("country", "value").unionByName(right.select("country", "value")).distinct()
    total = names.groupBy("country").agg(F.count("*").alias("n"))
    spaced = F.array_join(text.spaced(F.col("value")), " ").alias("value")
    vocabulary = names.select("country", spaced).mapInArrow(blocks.gram_counts(*grams), "country string, gram string, df long, times long").groupBy("country", "gram").agg(F.sum("df").alias("df"), F.sum("times").alias("times"))
    idf = F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1
    given = most_frequent(vocabulary, features).join(total, "country").select("country", F.col("gram").alias("value"), idf.alias("number"))
    left, right = (d.select("country", "id", spaced, F.lit(None).cast("double").alias("number")) for d in (left, right))
    return blocks.in_blocks(left, right, blocks.tfidf(k, least, *grams), f"{schema.PAIR}, score double", BLOCK * 2, given=given)


def top_k(pairs: DataFrame, k: int) -> DataFrame:
    """The k best pairs of each s1_id by score, ties by cand_id."""
    order = Window.partitionBy("country", "s1_id").orderBy(F.desc("score"), "cand_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank")


def cosine_top_k(queries: DataFrame, pool: DataFrame, k: int = schema.EMBEDDING_TOP, over: float | None = schema.EMBEDDING_OVER, block: int = 4096, by: str | None = None) -> DataFrame:
    """([by,] q_id, cand_id, score): for each query the exact k best pool vectors by cosine, if over the bound (strictly).

    Both sides have (id, vector) and, with `by`, a column that must be equal.  The pool is dealt into blocks;
    each task multiplies a block of queries by a block of the pool with the same `by`, keeps k a query, and a
    window keeps k of those: nothing is collected or broadcast.  The number of blocks comes from one count a
    side, so the vectors of a side are sent once for each block of the other, as exact search needs.
    """
    own = [by] if by else []

    def dealt(d: DataFrame, name: str) -> DataFrame:
        """d with the blocks of its `by` and the own one."""
        sizes = d.groupBy(*own).agg(F.ceil(F.count("*") / block).alias(f"n_{name}"))
        with_sizes = d.join(sizes.hint("merge"), own) if own else d.crossJoin(F.broadcast(sizes))  # one row, or one a value of `by`
        return with_sizes.withColumn(name, F.pmod(F.xxhash64("id"), F.col(f"n_{name}")))

    q, p = dealt(queries, "qb"), dealt(pool, "pb")
    # blocks of the other side: a pool without rows of a query's `by` has none
    q_sizes, p_sizes = q.select(*own, "n_qb").distinct(), p.select(*own, "n_pb").distinct()
    meet = lambda d, sizes: d.join(sizes.hint("merge"), own) if own else d.crossJoin(F.broadcast(sizes))  # noqa: E731  # the latter one row
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = meet(q, p_sizes).select(*own, "qb", every("n_pb").alias("pb"), F.lit(0).alias("side"), "id", "vector")
    right = meet(p, q_sizes).select(*own, every("n_qb").alias("qb"), "pb", F.lit(1).alias("side"), "id", "vector")
    label = (lambda rows: rows[by].iloc[0]) if by else (lambda rows: None)

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = rows[rows.side == 0], rows[rows.side == 1].sort_values("id")
        if not len(a) or not len(b):
            return pd.DataFrame({c: [] for c in [*own, "q_id", "cand_id", "score"]})
        x, y = (np.stack(d.vector.to_list()).astype(np.float64) for d in (a, b))
        x, y = (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-30) for v in (x, y))
        scores = np.round(x @ y.T, 6)
        # the k-th best score of each query; ties at it are kept, and the window decides among them by id
        least = -np.partition(-scores, min(k, scores.shape[1]) - 1, axis=1)[:, [min(k, scores.shape[1]) - 1]]
        row, col = np.nonzero((scores >= least) & (scores > over if over is not None else True))
        tied = scores[row, col] == least[row, 0]
        rank = np.cumsum(tied) - np.concatenate([[0], np.cumsum(np.bincount(row, tied, len(a)))])[row]
        room = k - np.bincount(row, ~tied, len(a))
        fine = ~tied | (rank <= room[row])  # columns are in order of id
        row, col = row[fine], col[fine]
        out = pd.DataFrame({"q_id": a.id.to_numpy()[row], "cand_id": b.id.to_numpy()[col], "score": scores[row, col]})
        if by:
            out.insert(0, by, label(rows))
        return out

    kinds = dict(queries.dtypes)
    schema_ = "".join(f"{by} {kinds[by]}, " for _ in own) + f"q_id {kinds['id']}, cand_id {dict(pool.dtypes)['id']}, score double"
    found = left.unionByName(right).groupBy(*own, "qb", "pb").applyInPandas(best, schema_)
    order = Window.partitionBy(*own, "q_id").orderBy(F.desc("score"), "cand_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank")


def embedding_blocking(s1: DataFrame, pool: DataFrame, encode, column: str = "name_clean", k: int = schema.EMBEDDING_TOP, over: float = schema.EMBEDDING_OVER) -> DataFrame:
    """Pairs of s1 with pool records of its country in other scripts, by cosine of embeddings; encode: Column -> array column."""
    sides_ = (s1, pool.filter("has_non_latin"))
    rows = [d.filter(F.col(schema.COUNTRY).isNotNull()).select(F.col(schema.ID).alias("id"), F.col(schema.COUNTRY).alias("country"), F.coalesce(column, F.lit("")).alias("value")) for d in sides_]
    vectors = [text.map_distinct(d, "value", encode, "vector").select("id", "country", "vector") for d in rows]
    return cosine_top_k(*vectors, k, over, by="country").select("country", F.col("q_id").alias("s1_id"), "cand_id", "score")


def foremost(rows: DataFrame, by: list[str], score: str | None, tie: str, most: int | str) -> DataFrame:
    """rows without such as can't be among the `most` (a number or a column) best of their `by`, by score (ties: least `tie`).

    All that are among them stay, and some more: each task ranks what it has, so that little is shuffled for
    the ranks of all.  Without a score the order is that of `tie`.
    """

    def codes(column: pa.ChunkedArray, ordered: bool = False) -> np.ndarray:
        found = pa.concat_arrays(column.chunks).dictionary_encode()
        own = found.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        if not ordered:
            return own
        rank = np.empty(len(found.dictionary) + 1, np.int64)
        rank[pc.sort_indices(found.dictionary).to_numpy()] = np.arange(len(found.dictionary))
        rank[-1] = -1  # null
        return rank[own]

    def best(table: pa.Table) -> pa.Table:
        group = np.zeros(len(table), np.int64)
        for c in by:
            own = codes(table[c]) + 1
            group = np.unique(group * (own.max() + 1) + own, return_inverse=True)[1]
        points = np.zeros(len(table)) if score is None else table[score].cast(pa.float64()).to_numpy()
        null = np.zeros(len(table), bool) if score is None else table[score].is_null().to_numpy()
        points = np.where(null, -np.inf, np.where(np.isnan(points), np.inf, points))
        order = np.lexsort((codes(table[tie], True), null, -points, group))
        start = np.flatnonzero(np.diff(group[order], prepend=-1))
        rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
        room = table[most].to_numpy()[order] if isinstance(most, str) else most
        return table.take(pa.array(np.sort(order[rank < room])))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= RANKED:
                kept = best(pa.Table.from_batches(held))
                if len(kept) > RANKED // 2:
                    yield from kept.to_batches()
                    held, n = [], 0
                else:
                    held, n = kept.to_batches(), len(kept)
        if n:
            yield from best(pa.Table.from_batches(held)).to_batches()

    return rows.mapInArrow(cut, rows.schema)


def merge_candidates(strategies: list[DataFrame], entities: DataFrame | None = None, most: int = schema.CANDIDATES, by_score: bool = False) -> DataFrame:
    """(s1_id, ids): the union of the strategies' pairs, at most so many: the first ids in order, or the best scores.

    entities (s1_id) without candidates get an empty list.
    """
    union = None
    for pairs in strategies:
        pairs = pairs.select("s1_id", "cand_id", F.col("score") if "score" in pairs.columns else F.lit(0.0).alias("score"))
        # the best of all are among the best of each, as a strategy gives a pair once
        pairs = foremost(pairs, ["s1_id"], "score" if by_score else None, "cand_id", most)
        union = pairs if union is None else union.unionByName(pairs)
    best = union.groupBy("s1_id", "cand_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("s1_id").orderBy(*([F.desc("score")] if by_score else []), "cand_id")
    capped = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    lists = capped.groupBy("s1_id").agg(F.array_sort(F.collect_list("cand_id")).alias("ids"))
    if entities is None:
        return lists
    return entities.select("s1_id").distinct().join(lists, "s1_id", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))


class Strategy(Protocol):
    """A way to find candidates: both sides in, (country, s1_id, cand_id[, score]) out."""

    def __call__(self, s1: DataFrame, pool: DataFrame) -> DataFrame: ...


#: Strategies that run_blocking uses unless it is given others; own ones may be added.
STRATEGIES: dict[str, Strategy] = {"minhash": minhash_blocking, "tfidf": tfidf_blocking, "token": token_blocking}


def run_blocking(s1: DataFrame, pool: DataFrame, encode=None, most: int = schema.CANDIDATES, strategies: dict[str, Strategy] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """All strategies over all countries in one plan each, and their merged lists; s1 may be restricted, the pool is whole."""
    found = {name: strategy(s1, pool) for name, strategy in (STRATEGIES if strategies is None else strategies).items()}
    if encode is not None:
        found["embedding"] = embedding_blocking(s1, pool, encode)
    return found, merge_candidates(list(found.values()), s1.select(F.col(schema.ID).alias("s1_id")), most)
