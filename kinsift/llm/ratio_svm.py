"""Quality classifier: Naive Bayes support vectors over byte n-grams.

A text's features are indicators of its byte n-grams (n = 1 to ORDER, hashed to 2**BITS), each scaled by the
classes' log-count ratio and the whole scaled to length one.  A linear hinge-loss model is fitted by dual
coordinate descent; Platt's sigmoid on out-of-fold margins turns a margin into the chance of quality 1.

The fit uses a bounded sample: at most SAMPLE labelled rows, those whose hashed doc_id comes first, and of
these the whole texts.  Only their features (2 bytes each) go to the driver.  All documents are scored, in
one map without a shuffle; what is broadcast is 2**BITS weights.

Edge cases: null and empty texts have no feature and get the score of the bias; texts of any length are read
whole; repeated labels of a doc_id count once (the least); labels that are null or other than 0 and 1, or of
documents that aren't there, are left out; of rows with one doc_id the fit takes one (by text hash), and each
is scored; with no labels of either class all scores are 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinsift.llm.textkit import slices, text_bytes

BITS, ORDER, SAMPLE = 16, 4, 10_000
EPOCHS, COST, SMOOTH = 12, 1.0, 1.0


def grams(text: np.ndarray) -> np.ndarray:
    """The distinct hashed n-grams of a text, as uint16 numbers in order."""
    seen = np.zeros(1 << BITS, bool)
    code = np.zeros(len(text), np.uint32)
    for n in range(1, ORDER + 1):
        if len(text) < n:
            break
        code = (code[: len(text) - n + 1] << np.uint32(8)) | text[n - 1 :]
        seen[(code * np.uint32(2654435761) + np.uint32(n * 40503)) * np.uint32(2246822519) >> np.uint32(32 - BITS)] = True
    return np.flatnonzero(seen).astype(np.uint16)


@dataclass
class Model:
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, features: np.ndarray) -> float:
        r = self.ratio[features]
        return float(self.weight[features] @ r / max(np.sqrt(r @ r), 1e-9)) + self.bias

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(features) + self.shift, -30, 30))))


def log_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = [np.full(1 << BITS, SMOOTH), np.full(1 << BITS, SMOOTH)]
    for x, y in zip(rows, labels.tolist(), strict=True):
        counts[y][x] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def descend(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for min |w|^2 / 2 + sum c_i max(0, 1 - y_i w x_i); rare classes weigh more."""
    w, b = np.zeros(1 << BITS), 0.0
    sign = np.where(labels == 1, 1.0, -1.0)
    cost = COST * np.where(labels == 1, 1.0, np.sqrt(max(1, (labels == 1).sum()) / max(1, (labels == 0).sum())))
    scaled = [ratio[x] / max(np.sqrt(ratio[x] @ ratio[x]), 1e-9) for x in rows]
    square = np.array([s @ s + 1 for s in scaled])
    dual = np.zeros(len(rows))
    draw = np.random.Generator(np.random.PCG64(5))
    for _ in range(EPOCHS):
        for i in draw.permutation(len(rows)).tolist():
            x, y = rows[i], sign[i]
            gradient = y * (w[x] @ scaled[i] + b) - 1
            new = min(max(dual[i] - gradient / square[i], 0.0), cost[i])
            if new != dual[i]:
                step = (new - dual[i]) * y
                w[x] += step * scaled[i]
                b += step
                dual[i] = new
    return w, float(b)


def platt(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the sigmoid that fits labels best, by Newton's method."""
    good, bad = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (target - p) - 1e-6 * at)
        at += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    if not len(rows) or len(set(labels.tolist())) < 2:
        return Model(np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 1.0, 0.0)
    fold = np.random.Generator(np.random.PCG64(3)).permutation(len(rows)) % 2
    margins = np.zeros(len(rows))
    for k in (0, 1):
        own = [r for r, f in zip(rows, fold, strict=True) if f != k]
        if len(set(labels[fold != k].tolist())) == 2:
            ratio = log_ratios(own, labels[fold != k])
            part = Model(ratio, *descend(own, labels[fold != k], ratio), 1.0, 0.0)
            margins[fold == k] = [part.margin(r) for r, f in zip(rows, fold, strict=True) if f == k]
    ratio = log_ratios(rows, labels)
    return Model(ratio, *descend(rows, labels, ratio), *platt(margins, labels))


def texts_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield data[a:b]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of at most `sample` labelled rows of docs."""
    marks = labels.filter("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = marks.join(docs.select("doc_id").distinct(), "doc_id")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([grams(t).tobytes() for t in texts_of(batch)], pa.binary())], ["doc_id", "quality", "grams"])

    joined = docs.select("doc_id", "text").join(chosen, "doc_id").select(F.col("doc_id").cast("long"), F.col("quality").cast("int"), "text")
    joined = joined.groupBy("doc_id", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = joined.mapInArrow(run, "doc_id long, quality int, grams binary").toArrow()
    order = np.argsort(rows.column(0).to_numpy(), kind="stable")
    features = rows.column(2).to_pylist()
    return fit([np.frombuffer(features[i], np.uint16) for i in order.tolist()], rows.column(1).to_numpy()[order])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs' doc_id and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m.score(grams(t)) for t in texts_of(batch)], pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def op1_ratio_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, by a model of the labels outside the held-out quarter."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out)
    out = score(docs, train(docs, labels))
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
