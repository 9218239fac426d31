"""Files in and out: lists of many parts, line ends, splits, the blocking of a validation set, submissions, streams."""

import logging

import pytest
from pyspark.sql import functions as F

from kinsift import jobs, schema
from kinsift.functions import scripts
from kinsift.operators import blocking, evaluate, matching, normalize, validate
from kinsift.sources import tables
from kinsift.streaming.normalize import normalize_stream


def lists(spark, rows):
    return spark.createDataFrame(rows, "s1_id string, ids array<string>")


def as_dict(rows):
    return {r.s1_id: sorted(r.ids) for r in rows.collect()}


@pytest.fixture
def data(tmp_path):
    for kind in ("train", "test"):
        folder = tmp_path / "data" / kind
        folder.mkdir(parents=True)
        for i in (1, 2, 3):
            rows = [f"S{i}-{n}\tAcme Widgets {n % 4} Ltd.\t{n} Main st, Springfield\t{'US' if n % 2 else 'India'}" for n in range(40)]
            (folder / f"{kind}_source{i}.tsv").write_text("\n".join(["entity_id\tbusiness_name\tbusiness_address\tcountry", *rows]) + "\n")
    truth = [f"S1-{n}\t{'' if n % 5 == 0 else f'S2-{n},S3-{n}'}" for n in range(40)]
    (tmp_path / "data/train/train_ground_truth.tsv").write_text("\n".join(["\t".join(schema.TRUTH_HEADER), *truth]) + "\n")
    return tmp_path


def test_list_file(spark, tmp_path):
    rows = lists(spark, [(f"S1-{i}", [f"S3-{i}", f"S2-{i}"] if i % 3 else []) for i in range(20)]).repartition(8)
    path = str(tmp_path / "m.tsv")
    tables.write_id_lists(rows, path)
    raw = open(path, newline="").read()
    assert raw.startswith("source1_entity_id\tmatched_entity_ids\r\nS1-0\t\r\nS1-1\tS2-1,S3-1\r\n") and raw.endswith("\r\n") and raw.count("\r\n") == 21
    assert as_dict(tables.read_id_lists(spark, path)) == {f"S1-{i}": sorted([f"S3-{i}", f"S2-{i}"]) if i % 3 else [] for i in range(20)}
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["m.tsv"]
    assert tables.id_list_lines(rows, schema.TRUTH_HEADER).first()[0] == "source1_entity_id\tmatched_entity_ids"


def test_lists_in_parts_and_repeated_ids(spark, tmp_path):
    """A header in each part is no entity; of lines with one id the last stands."""
    folder = tmp_path / "parts"
    folder.mkdir()
    for k in range(8):
        (folder / f"part-{k}.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{k}-{i}\tS2-{i}\n" for i in range(1 + 30 * (k % 2))) + f"S1-x\tS2-{k}, S3-1\n\n")
    got = as_dict(tables.read_id_lists(spark, str(folder)))
    assert len(got) == 4 * 1 + 4 * 31 + 1 and got["S1-x"] == [" S3-1", "S2-7"]
    assert {r.id for r in tables.read_ids(spark, str(folder)).collect()} == set(got)
    assert tables.read_ids(spark, str(folder), header=False).count() == len(got) + 1


def test_findings_of_files(spark, tmp_path, capsys):
    good, bad, test = tmp_path / "good.tsv", tmp_path / "bad.tsv", tmp_path / "test"
    test.mkdir()
    (test / "test_source1.tsv").write_text("entity_id\tx\nS1-1\ta\nS1-2\tb\n")
    good.write_bytes(b"source1_entity_id\tmatched_entity_ids\r\nS1-1\tS2-1\r\nS1-2\t\r\n")
    bad.write_bytes(b"source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S2-1\nS1-2\nS1-\xff\tS2-1\n")
    assert validate.main(spark, str(good), None, str(test)) == 0
    assert validate.main(spark, str(bad), None, str(test)) == 1
    said = capsys.readouterr().out
    assert all(x in said for x in ("no_tab", "not_utf8", "repeated_id", "missing_required"))
    assert validate.main(spark, str(good), None, str(tmp_path / "nowhere")) == 1
    assert "FAIL unreadable" in capsys.readouterr().out
    with pytest.warns(UserWarning, match="test_source2"):
        assert tables.match_targets(spark, str(test)) is None


def test_source_with_line_breaks(spark, tmp_path):
    path = tmp_path / "s.tsv"
    path.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"two\nlines"\tNA\tUS\nS1-2\tplain\tx\tnull\n')
    assert tables.has_line_breaks(spark, str(path))
    assert [tuple(r) for r in tables.read_source(spark, str(path)).collect()] == [("S1-1", "two\nlines", None, "US"), ("S1-2", "plain", "x", None)]
    path.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"a ""b"""\tx\tUS\n')
    assert not tables.has_line_breaks(spark, str(path)) and tables.read_source(spark, str(path), ["business_name"]).first()[0] == 'a "b"'


def test_jobs(spark, data, caplog):
    source, normed, splits, out = (str(data / x) for x in ("data", "norm", "splits", "out"))
    caplog.set_level(logging.INFO, "kinsift")
    done = jobs.normalize_sources(spark, source, normed)
    assert len(done) == 6 and done["train_source1"].filter("name_clean = 'acme widgets 1 limited'").count() == 10 and "n_changed" in caplog.text
    tsv = jobs.normalize_file(spark, f"{source}/test/test_source1.tsv", str(data / "one"), tsv=True)
    assert tsv.count() == 40
    rows = jobs.split_truth(spark, f"{source}/train/train_ground_truth.tsv", f"{source}/train/train_source1.tsv", splits, share=0.25)
    val = {r.s1_id for r in rows.filter("is_val").collect()}
    text = (data / "splits/val_s1_ids.txt").read_text()
    assert set(text.split("\n")) == val and not text.endswith("\n") and 8 <= len(val) <= 12
    assert set(as_dict(tables.read_id_lists(spark, f"{splits}/train_ground_truth.tsv"))) == {f"S1-{i}" for i in range(40)} - val
    exact = {"exact": blocking.exact_blocking}
    stats, met = jobs.block_validation(spark, normed, splits, out, strategies=exact)
    assert met and stats.filter("country is null").first().status == "MET"
    written = as_dict(tables.read_id_lists(spark, f"{out}/val_candidate_pairs.tsv"))
    assert set(written) == val and "\r" not in open(f"{out}/val_candidate_pairs.tsv", newline="").read()
    _, met = jobs.block_validation(spark, normed, str(data / "none"), out, strategies=exact)
    assert met is None and len(as_dict(tables.read_id_lists(spark, f"{out}/val_candidate_pairs.tsv"))) == 40


def test_submission(spark, data, capsys):
    out = str(data / "sub")
    assert jobs.main(spark, ["--data-dir", str(data / "data"), "--out-dir", out, "--score"]) == 0
    assert as_dict(tables.read_id_lists(spark, f"{out}/matching_results.tsv")) == {f"S1-{i}": [] for i in range(40)}
    assert "macro F0.5: 0.2000" in capsys.readouterr().out  # a fifth has no match
    assert validate.main(spark, f"{out}/matching_results.tsv", f"{out}/candidate_pairs.tsv", str(data / "data/test")) == 0
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S3-1")], "s1_id string, cand_id string")
    jobs.write_submission(spark, str(data / "data"), out, matches=pairs)
    assert as_dict(tables.read_id_lists(spark, f"{out}/matching_results.tsv"))["S1-1"] == ["S2-1", "S3-1"]
    assert jobs.main(spark, ["--data-dir", str(data / "nowhere")]) == 1


def test_features(spark, tmp_path):
    pairs = spark.createDataFrame([("S1-1", "S3-1", "acme ltd", "1 x st, paris, fr", "acme limited", "2 x st, paris, fr", 0.5, None)], "s1_id string, cand_id string, name1 string, addr1 string, name2 string, addr2 string, embedding double, tfidf double")
    made = matching.features(pairs)
    r = made.first()
    assert (r.city_match, r.state_match, r.from_s3, r.missing_addr, r.tfidf) == (1.0, 1.0, 1.0, 0.0, 0.0) and r.name_or_embedding == max(r.name_levenshtein, 0.5)
    tables.write_features(made, str(tmp_path), "train")
    again = tables.read_features(spark, str(tmp_path), "train")
    assert dict(again.dtypes)["name_levenshtein"] == "float" and again.count() == 1
    assert tables.text_report(spark.createDataFrame([(12345, 0.5, True)], "n int, rate double, fine boolean")) == "n       rate    fine\n12,345  0.5000  True"


def test_candidates_of_other_countries(spark):
    """Vectors are only compared within a country, so those of others take nobody's place."""
    row = "entity_id string, country string, has_non_latin boolean, name_clean string"
    s1 = spark.createDataFrame([("S1-1", "US", False, "1 0"), ("S1-2", "IN", False, "1 0"), ("S1-3", None, False, "1 0")], row)
    pool = spark.createDataFrame([("S2-1", "IN", True, "1 0"), ("S2-2", "US", True, "1 0.1"), ("S2-3", "US", False, "1 0"), ("S2-4", "FR", True, "1 0")], row)
    found = blocking.embedding_blocking(s1, pool, lambda c: F.transform(F.split(c, " "), lambda x: x.cast("double")), k=1)
    assert {(r.country, r.s1_id, r.cand_id) for r in found.collect()} == {("US", "S1-1", "S2-2"), ("IN", "S1-2", "S2-1")}


def test_breakdowns(spark):
    truth = spark.createDataFrame([("a", ["x"], "US"), ("b", [], "US"), ("c", ["y", "z"], None)], "s1_id string, ids array<string>, country string")
    found = lists(spark, [("a", ["x"]), ("c", [])])
    scripts = spark.createDataFrame([("a", "LATIN"), ("x", "TAMIL"), ("c", "LATIN"), ("y", "LATIN"), ("z", "LATIN")], "id string, scripts string")
    got = {(r.dimension, r.value): (r.n, r.macro_f05) for r in evaluate.breakdowns(found, truth, scripts).collect()}
    assert got[("country", "US")] == (2, 1.0) and got[("country", "UNKNOWN")] == (1, 0.0) and got[("cross_script", "yes")] == (1, 1.0) and got[("bracket", "2")] == (1, 0.0)


def test_vocabulary_border(spark):
    """Of each country the most frequent grams, ties at the border by gram."""
    rows = [("US", f"{a}{b}", 1, t) for a in "abc" for b in "xyz" for t in ((3,) if a == "a" else (1,))] + [("FR", "q", 1, 1)]
    kept = blocking.most_frequent(spark.createDataFrame(rows, "country string, gram string, df long, times long"), 5)
    assert sorted((r.country, r.gram) for r in kept.collect()) == [("FR", "q"), *(("US", g) for g in ("ax", "ay", "az", "bx", "by"))]


def test_plan_of_normalization(spark, data):
    """Each rule's expression stands in the plan once."""
    rows = tables.read_source(spark, str(data / "data/train/train_source1.tsv"))
    plan = normalize.normalize(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") < 400


def test_stream(spark, data):
    rows = spark.readStream.schema(schema.SOURCE).csv(str(data / "data/train"), sep="\t", header=True, pathGlobFilter="train_source*.tsv")
    query = normalize_stream(rows, str(data / "stream"), str(data / "checkpoint"))
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(str(data / "stream")).filter("name_clean like 'acme widgets%'").count() == 120


@pytest.mark.parametrize(
    ("broken", "whole"),
    [
        ("Caf\u00c3\u00a9", "Café"),
        ("Caf\u00c3\u0192\u00c2\u00a9", "Café"),  # twice
        ("Smith &amp; S&ouml;hne", "Smith & Söhne"),
        ("a <b> &amp; c", "a <b> &amp; c"),
        ("\x1b[31mred\x1b[0m", "red"),
        ("\u201cx\u201d \ufb01t \uff21\uff22", '"x" fit AB'),
        ("a\r\nb\x00\x08c", "a\nbc"),
        ("e\u0301", "é"),
        ("5 \x80", "5 €"),
        ("plain", "plain"),
        ("", ""),
    ],
)
def test_text_repair(broken, whole):
    assert scripts.fix_text(broken) == whole
