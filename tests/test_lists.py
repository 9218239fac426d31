"""Pairs that are made of lists of rows and compared by numpy."""

import random

import numpy as np
import pytest

from kinsift.operators import blocking, matching, pairs
from kinsift.plans import catalog
from tests.test_sql_rows import rows_of

SF = "/root/testdata/sf0.001"


def plainly(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_distances(monkeypatch):
    """Empty texts, such of one, two and three words of bits, letters that are not ASCII."""
    monkeypatch.setattr(pairs, "BLOCK", 7)
    rng = random.Random(1)
    sides = [["".join(rng.choice("abé😀") for _ in range(n)) for n in (0, 1, 5, 40, 63, 64, 65, 90, 128, 129, 150)] for _ in range(2)]
    i, j = (x.reshape(-1) for x in np.meshgrid(*[np.arange(len(s)) for s in sides]))
    got = pairs.distances(*pairs.coded(*sides), i, j)
    assert got.tolist() == [plainly(sides[0][a], sides[1][b]) for a, b in zip(i, j, strict=True)]


@pytest.mark.parametrize("masked", [pairs.MASKED, 2])
def test_queries_of_lists(spark, tmp_path, monkeypatch, masked):
    """Against the SQL, with keys of many lists and steps of few pairs: every pair once, with its own values."""
    monkeypatch.setattr(blocking, "PAIRS", 4000)
    monkeypatch.setattr(blocking, "LISTED", 5)
    rng = random.Random(2)
    words = [a + b for a in ("alp", "bet", "gam", "del", "éps", "zet") for b in ("ha", "ax", "mo", "ta", "lé", "ny", "or", "ik")]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 9))) + rng.choice(["", " 12345", ", paris, tx"]) for _ in range(22)] + ["", None]
    for name in ("alias_similarity", "feature_matrix", "strategy_contributions") if masked > 2 else ("feature_matrix",):
        monkeypatch.setattr(pairs, "MASKED", masked)
        got, want = rows_of(spark, tmp_path, name, texts)
        assert got == want and got


@pytest.mark.parametrize("name", ["alias_similarity", "feature_matrix", "gbdt_scores"])
def test_distances_are_not_made_pair_by_pair(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "_rows1" in plan and "levenshtein(" not in plan


def test_trees(spark):
    """Probabilities of the trees as read are those of the model."""
    rng = random.Random(4)
    rows = [(float(i), int(x > 0.4), x, y) for i in range(300) for x, y in [(rng.random(), rng.random())]]
    d = spark.createDataFrame(rows, "id double, label int, x double, y double")
    model = matching.fit_gbdt(d, ("x", "y"), maxIter=3)
    want = [r.p for r in matching.predict(model, d).orderBy("id").collect()]
    step = pairs.Step(0, 1, np.zeros(1, np.int64), np.zeros(300, np.int64), np.arange(300))
    known = {"label": np.array([r[1] for r in rows]), "x": np.array([r[2] for r in rows]), "y": np.array([r[3] for r in rows])}
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pairs, "features", lambda one, two: lambda step, kept: known)
        got = pairs.predicted(matching.trees(model), ("x", "y"))(None, None)(step, np.arange(300))
    assert got["p"] == pytest.approx(want, abs=1e-6)
