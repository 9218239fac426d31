"""Normalization of a stream: it keeps no state, so any stream of source rows will do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from kinsift.operators.normalize import normalize


def normalize_stream(rows: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Writes the normalized rows of a stream as Parquet, exactly once."""
    return normalize(rows, **options).writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").start(path)
