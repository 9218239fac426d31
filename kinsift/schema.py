"""Schemas and fixed values of the record-linkage engine."""

from __future__ import annotations

from pyspark.sql import types as T

ID, NAME, ADDRESS, COUNTRY = "entity_id", "business_name", "business_address", "country"
SOURCE = T.StructType([T.StructField(c, T.StringType()) for c in (ID, NAME, ADDRESS, COUNTRY)])
TRUTH_HEADER = ("source1_entity_id", "matched_entity_ids")
CANDIDATE_HEADER = ("source1_entity_id", "candidate_entity_ids")
PAIR = "country string, s1_id string, cand_id string"

# Texts that count as missing when a table is read.
NA_VALUES = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Parameters of the blocking strategies.
NUM_PERM, BANDS, ROWS, SHINGLE, LSH_THRESHOLD = 128, 28, 2, 3, 0.2
TFIDF_GRAMS, TFIDF_FEATURES, TFIDF_TOP, TFIDF_LEAST = (3, 5), 500_000, 50, 0.15
TOKEN_LENGTH, TOKEN_FREQUENCY = 3, 0.01
EMBEDDING_TOP, EMBEDDING_OVER = 30, 0.35
CANDIDATES = 100
