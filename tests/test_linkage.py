"""Rules on a corpus of hand-derived results, metrics, validation, blocking against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from kinsift.functions import text
from kinsift.operators import blocking, evaluate, matching, normalize, split, validate
from kinsift.sources import tables

NAMES = [
    ("SHIVSHAKTI VIDYALAYA VIDYALAYA OVERSEAS CORPORATION | www.shivshakti.com", "shivshakti vidyalaya overseas corporation", "lowercase,strip_pipe_fragments,collapse_duplicate_words"),
    ("wilfordhancock.com", "wilfordhancock", "strip_urls"),
    ("info@shivshakti.com", "", "strip_email"),
    ("Sweet Barbershop (Co)", "sweet barbershop co", "lowercase,strip_parenthetical_suffix"),
    ("COBALT (LLC) Group", "cobalt llcgroup", "lowercase,strip_parenthetical_suffix"),
    ("Diamond Star Works L.L.C. - 7149969359", "diamond star works llc", "lowercase,strip_appended_digits,normalize_legal_suffix"),
    ("GM (INDIA) FABRICS LTD", "gm fabrics limited", "lowercase,strip_geo_parenthetical,normalize_legal_suffix"),
    ("Ectolumdrex dba X+ Madison Inc", "ectolumdrex", "lowercase,split_dba"),
    (">> Astro Handlooms", "astro handlooms", "lowercase,strip_angle_brackets,strip_email"),
    ("FOUNDATION EXCEL AGENCY PRIVATE  LIMITED", "foundation excel agency private limited", "lowercase,collapse_whitespace"),
    ("#hanumaneducational", "hanumaneducational", "strip_hashtag_prefix"),
    ("Pvt. EFS Print Ventures Ltd.", "pvt. efs print ventures limited", "lowercase,normalize_legal_suffix"),
    ("FERRERO FERRERO DUKE", "ferrero duke", "lowercase,collapse_duplicate_words"),
    ("राम मार्केटिंग प्राइवेट लिमिटेड", "राम मार्केटिंग प्राइवेट लिमिटेड", ""),
    ("Tata Motors", "tata motors", "lowercase"),
    ("M/s Pearl Bróthers Private", "pearl bróthers private", "nfkd_normalize,lowercase,strip_ms_prefix,strip_accent_noise"),
    (None, "", ""),
    ("   ", "", ""),
]
ADDRESSES = [
    ("914 PIERPONT AVE, CLEVELAND, OH", "914 pierpont avenue, cleveland, oh", True),
    ("G.t. Karnal Road, Industrial Area, New Delhi, null, A-68", "g.t. karnal road, industrial area, new delhi, , a-68", True),
    ("PO Box 6009", "", False),
    ("12 Main St, Miami, FL", "12 main street, miami, floor", True),
    (None, "", False),
]


def test_names(spark):
    rows = spark.createDataFrame([(str(i), n) for i, (n, _, _) in enumerate(NAMES)], "entity_id string, business_name string")
    got = {r["entity_id"]: r for r in normalize.normalize_names(rows).collect()}
    for i, (name, clean, fired) in enumerate(NAMES):
        assert (got[str(i)]["name_clean"], got[str(i)]["name_rules_fired"]) == (clean, fired), name
    assert got["7"]["alias_clean"] == "x+ madison inc"
    assert got["13"]["scripts_detected"] == "DEVANAGARI" and got["13"]["has_non_latin"]
    assert got["15"]["name_no_accent"] == "pearl brothers private"


def test_toggles(spark):
    rows = spark.createDataFrame([("1", "ABC LTD")], "entity_id string, business_name string")
    off = {"lowercase": False, "fix_encoding": False, "split_dba": False}
    assert normalize.normalize_names(rows, toggles=off).first()["name_clean"] == "ABC limited"


def test_addresses(spark):
    rows = spark.createDataFrame([(i, a) for i, (a, _, _) in enumerate(ADDRESSES)], "i int, business_address string")
    got = {r["i"]: (r["addr_clean"], r["has_addr"]) for r in normalize.normalize_addresses(rows).collect()}
    assert got == {i: (c, h) for i, (_, c, h) in enumerate(ADDRESSES)}
    assert normalize.normalize_addresses(rows.drop("business_address")).first()["has_addr"] is False


@pytest.mark.parametrize(("truth", "predicted", "want"), [([], [], 1.0), ([], ["a"], 0.0), (["a"], [], 0.0), (["a", "b"], ["c"], 0.0), (["a", "b"], ["a"], 0.833333), (["a"], ["a", "b"], 0.555556), (["a", "b"], ["a", "b"], 1.0)])
def test_f05(spark, truth, predicted, want):
    kind = "s1_id string, ids array<string>"
    t, p = spark.createDataFrame([("x", truth)], kind), spark.createDataFrame([("x", predicted), ("y", ["q"])], kind)
    assert evaluate.macro_f05(p, t).first()[0] == pytest.approx(want, abs=1e-6)


def test_token_blocking_against_plain_python(spark):
    rng = random.Random(42)
    pool = ["alpha beta", "alpha llc", "gamma 123", "the delta", "delta gamma", "epsilon", "zeta alpha", "eta", "theta of", "iota", "kappa beta", "42 llc"]
    s1 = [(f"S1-{i}", rng.choice(pool), "US") for i in range(40)]
    other = [(f"S2-{i}", rng.choice(pool), "US") for i in range(80)]
    kind = "entity_id string, name string, country string"
    keys = lambda n: {w for w in re.findall("[a-z0-9]+", n) if len(w) >= 3 and w not in text.STOPWORDS and not w.isdigit()}
    df = {}
    for _, n, _ in other:
        for w in keys(n):
            df[w] = df.get(w, 0) + 1
    rare = {w for w, k in df.items() if k <= int(0.2 * len(other))}
    want = {(a, b) for a, n, _ in s1 for b, m, _ in other if keys(n) & keys(m) & rare}
    got = blocking.token_blocking(spark.createDataFrame(s1, kind), spark.createDataFrame(other, kind), "name", 0.2)
    assert {(r.s1_id, r.cand_id) for r in got.collect()} == want
    with pytest.raises(blocking.PairBudgetExceeded):
        blocking.token_blocking(spark.createDataFrame(s1, kind), spark.createDataFrame(other, kind), "name", 0.2, budget=1)


def test_top_k_is_exact_and_strict(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    q, p = rng.normal(size=(12, 8)), rng.normal(size=(30, 8))
    frame = lambda v: spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, vector array<double>")
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    scores = np.round(unit(q) @ unit(p).T, 6)
    want = {(i, int(j)) for i in range(12) for j in sorted(range(30), key=lambda j: (-scores[i, j], j))[:5] if scores[i, j] > 0.35}
    assert {(r.q_id, r.cand_id) for r in blocking.cosine_top_k(frame(q), frame(p), 5, block=7).collect()} == want


def test_findings(spark, tmp_path):
    path = tmp_path / "m.tsv"
    path.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S2-1\nS1-1\t\nS1-2\tS1-9\nS1-3\tS2-8,\nnotab\n")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    header = ("source1_entity_id", "matched_entity_ids")
    got = {(r.check, r.offender) for r in validate.findings(spark, str(path), header, ids("S1-1", "S1-4"), ids("S2-1")).collect()}
    assert got == {("duplicate_row", "S1-1"), ("repeated_id", "S1-1"), ("self_match", "S1-9"), ("wrong_prefix", ""), ("unknown_id", "S2-8"), ("missing_required", "S1-4"), ("extra_id", "S1-2"), ("extra_id", "S1-3"), ("no_tab", "notab")}
    assert validate.findings(spark, str(tmp_path / "none"), header).first()["check"] == "missing_file"
    (tmp_path / "c.tsv").write_text("a,b\n")
    assert validate.findings(spark, str(tmp_path / "c.tsv"), header).first()["check"] == "bad_header"


def test_id_lists_round_trip(spark, tmp_path):
    lists = spark.createDataFrame([("S1-2", ["S3-1", "S2-5"]), ("S1-1", [])], "s1_id string, ids array<string>")
    part = tmp_path / "out.tsv"
    tables.write_id_lists(lists, str(part))
    assert part.read_text().split("\n")[:2] == ["source1_entity_id\tmatched_entity_ids", "S1-1\t"]
    assert {r.s1_id: r.ids for r in tables.read_id_lists(spark, str(part)).collect()} == {"S1-1": [], "S1-2": ["S2-5", "S3-1"]}


def test_split(spark):
    truth = spark.range(200).select(F.concat(F.lit("S1-"), "id").alias("s1_id"), F.when(F.col("id") % 2 == 0, "US").alias("country"), F.array().cast("array<string>").alias("ids"))
    check = split.check_split(split.stratified_split(truth)).first()
    assert (check.n, check.n_val, check.n_train, check.n_overlap) == (200, 20, 180, 0)


def test_claims(spark):
    rows = spark.createDataFrame([("a", "x", 0.5), ("b", "x", 0.9), ("c", "y", 0.9), ("b", "y", 0.9)], "s1_id string, cand_id string, p double")
    assert {(r.s1_id, r.cand_id) for r in matching.resolve_claims(rows).collect()} == {("b", "x"), ("b", "y")}


def test_whole_texts(spark, tmp_path):
    from kinsift.plans import catalog

    start = "a shared opening of well over one hundred characters " * 3
    rows = [(3, start + "zebra", "en"), (4, start + "yak", "en"), (6, start + "lion", "en"), (7, start + "lion", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    tokens = {r.token for r in catalog.QUERIES["whole_token_topk"](spark, str(tmp_path)).collect()}
    assert {"zebra", "yak", "lion"} <= tokens
    assert {tuple(r) for r in catalog.QUERIES["whole_exact_name_join"](spark, str(tmp_path)).select("s1_id", "cand_id").collect()} == {("S1-6", "S2-7")}
    assert catalog.QUERIES["exact_name_join"](spark, str(tmp_path)).count() == 4
    assert not any(n.startswith("whole_") for n in catalog.ORACLE_SQL)
