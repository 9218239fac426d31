"""Rows that the test tables don't have, against the queries' SQL."""

import duckdb
import pytest

from kinsift.plans import catalog

NAMES = ["acme co ", "acme co.", "acme corp", "acme ltd. ", "acme ltd", "acmeltd", "éltd", "x inc.\t", "x inc ", "x incorporated", "x pvt", "ltd", "", None]


def rows_of(spark, tmp_path, name: str, texts: list) -> tuple[list, list]:
    """What the query and its SQL make of documents of these texts, of every kind of noise."""
    documents = spark.createDataFrame([(11 * 3 * i + k, t, "en", "web", len(t or "")) for i, t in enumerate(texts) for k in range(33)], "doc_id long, text string, lang string, source string, n_chars long")
    documents.coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        found = catalog.QUERIES[name](spark, str(tmp_path))
        want = db.execute(f"SELECT {', '.join(found.columns)} FROM ({catalog.ORACLE_SQL[name]})").fetchall()
    return sorted(map(str, map(tuple, found.collect()))), sorted(map(str, want))


def test_legal_suffixes_of_the_sql(spark, tmp_path):
    """A white space after "co", a suffix after a letter that is not ASCII, suffixes that the SQL leaves alone."""
    got, want = rows_of(spark, tmp_path, "rule_normalize_legal_suffix", NAMES)
    assert got == want
    whole = {r.value for r in catalog.QUERIES["whole_rule_normalize_legal_suffix"](spark, str(tmp_path)).collect()}
    assert {"acme corporation", "acme co", "éltd"} <= whole
