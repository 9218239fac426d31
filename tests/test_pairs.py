"""Candidate pairs are made once and where they are counted: no shuffle or list of them."""

import random
import re

import pytest
from pyspark.sql import functions as F

from kinsift.functions import text
from kinsift.operators import blocking, evaluate, matching
from kinsift.plans import catalog

SF = "/root/testdata/sf0.001"
JOIN = r"SortMergeJoin \[country#\d+, token#\d+, _part#"


def above_the_join(df) -> str:
    """The plan's nodes above the join that makes the pairs."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert re.search(JOIN, plan), plan
    return re.split(JOIN, plan)[0]


def grouped_first(df) -> bool:
    """Whether pairs are summed up, or cut to the best, before they are shuffled."""
    above = above_the_join(df)
    last = [n for n in re.findall(r"Exchange|HashAggregate|MapInArrow|Window", above)]
    return "Exchange" not in last or last[::-1].index("HashAggregate" if "HashAggregate" in last else "MapInArrow") < last[::-1].index("Exchange")


def test_pairs_are_not_shuffled(spark):
    assert "Exchange" not in above_the_join(catalog.QUERIES["token_blocking"](spark, SF))


def forced(spark, monkeypatch, seed=3):
    """Random rows of both sides, their pairs by plain Python, and with keys dealt into many parts."""
    monkeypatch.setattr(blocking, "PAIRS", 3)
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "theta", "kappa"]
    rows = lambda p, n: [(f"{p}-{i % (n - 2)}", " ".join(rng.sample(words, rng.randint(0, 4))) or None, rng.choice(["US", "US", "FR", None])) for i in range(n)]
    s1, pool = rows("S1", 40), rows("S2", 70)
    kind = "entity_id string, name string, country string"
    return s1, pool, spark.createDataFrame(s1, kind), spark.createDataFrame(pool, kind)


def test_every_pair_once(spark, monkeypatch):
    """Rows with the same id, no name or no country; each pair once at the first of its shared tokens, in whatever part."""
    s1, pool, a, b = forced(spark, monkeypatch)
    keys = lambda n: set(re.findall("[a-z]+", n or ""))
    want = set()
    for country in ("US", "FR"):
        right = [(i, keys(n)) for i, n, c in pool if c == country]
        df = {w: len({i for i, k in right if w in k}) for w in {w for _, k in right for w in k}}
        rare = {w for w, k in df.items() if k <= int(0.5 * len(right))}
        merged = lambda rows: {i: set().union(*(k for j, k in rows if j == i)) for i, _ in rows}
        want |= {(country, i, j) for i, x in merged([(i, keys(n)) for i, n, c in s1 if c == country]).items() for j, y in merged(right).items() if x & y & rare}
    got = blocking.token_blocking(a, b, "name", 0.5, stopwords=text.STOPWORDS).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


@pytest.mark.parametrize("name", ["brier", "reliability_bins", "threshold_sweep", "singleton_rule", "ablation_stages", "fp_fn_breakdown", "strategy_contributions", "feature_matrix", "alias_similarity", "claim_conflict_resolution", "hard_negative_sample"])
def test_queries_shuffle_no_pairs(spark, name):
    assert grouped_first(catalog.QUERIES[name](spark, SF))


def scored(spark, n=3000, seed=5):
    rng = random.Random(seed)
    rows = [(f"S1-{rng.randrange(30)}", f"S2-{i}", int(rng.random() < 0.05), rng.choice([None, 0.0, 0.1, 0.25, 0.5, 0.75, float("nan")])) for i in range(n)]
    return spark.createDataFrame(rows, "s1_id string, cand_id string, label int, score double").repartition(5)


def test_foremost(spark, monkeypatch):
    """What tasks leave out can't be among the best: null and NaN scores, ties, a group without a name."""
    monkeypatch.setattr(blocking, "RANKED", 100)
    pairs = scored(spark).withColumn("s1_id", F.when(F.col("s1_id") != "S1-7", F.col("s1_id")))
    kept = blocking.foremost(pairs, ["s1_id"], "score", "cand_id", 4)
    assert kept.count() < 1500
    best = lambda d: sorted(map(str, d.withColumn("k", F.expr("row_number() over (partition by s1_id order by score desc, cand_id)")).filter("k <= 4").collect()))
    assert best(kept) == best(pairs)


def test_hard_negatives_with_a_bound(spark, monkeypatch):
    monkeypatch.setattr(blocking, "RANKED", 100)
    pairs = scored(spark)
    bounds = pairs.groupBy("s1_id").agg(F.sum("label").alias("bound"))
    got = matching.hard_negatives(pairs.join(bounds, "s1_id"), bound="bound")
    assert got.columns == pairs.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, matching.hard_negatives(pairs).collect()))


def test_counts_of_labels(spark):
    """Errors and contributions by label are those of the joins and lists."""
    pairs = scored(spark).withColumnRenamed("score", "p").filter("not isnan(p)")
    truth = pairs.filter("label = 1").select("s1_id", "cand_id").unionByName(spark.createDataFrame([("S1-1", "S2-x"), ("S1-99", "S2-1")], "s1_id string, cand_id string"))
    want = matching.error_causes(matching.confusion(pairs.filter("p >= 0.5"), truth), pairs)
    rows = lambda d: sorted(map(str, d.collect()))
    assert rows(matching.error_counts(pairs, truth)) == rows(want)
    lists = truth.groupBy("s1_id").agg(F.collect_set("cand_id").alias("ids"))
    assert rows(evaluate.strategy_contributions({"a": pairs}, lists, 3)) == rows(evaluate.strategy_contributions({"a": pairs.drop("label")}, lists, 3))


def test_fits_of_counts(spark):
    """Fits and curves read each score and label once, not the pairs."""
    pairs = scored(spark).withColumnRenamed("score", "p").filter("p is not null and not isnan(p)")
    assert matching.counted(pairs, "label", "p").count() <= 10
    curve = {r.p: r.calibrated for r in matching.calibrate_platt(pairs).collect()}
    rate = pairs.agg(F.avg("label")).first()[0]
    mean = sum(curve[r.p] for r in pairs.collect()) / pairs.count()
    assert mean == pytest.approx(rate, abs=1e-4)
