"""Boosted models grown in step: against MLlib, against plain loops, on both paths."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from prospect.operators import boosting as B
from prospect.operators import models as MD
from prospect.operators import tuning as TU
from prospect.spec import TableSpec

SPEC = TableSpec(categorical=("job",), numeric=("a", "b"), id="id")


def _rows(spark, n=900):
    rnd = np.random.default_rng(8)
    a, b, job = rnd.normal(size=n), rnd.normal(size=n), rnd.integers(0, 4, n)
    yes = a + 0.5 * b + (job == 2) + rnd.normal(size=n) > 0.7
    return spark.createDataFrame([(i, f"j{job[i]}", float(a[i]), float(b[i]), "yes" if yes[i] else "no") for i in range(n)],
                                 "id long, job string, a double, b double, y string")


@pytest.fixture(scope="module")
def trainer(spark):
    t = MD.Trainer(_rows(spark), SPEC)
    yield t
    t.close()


def _margins(model, x):
    return np.array([r[0] for r in model.transform(x).select(vector_to_array("rawPrediction")[1]).collect()])


def test_models_are_those_of_mllib(trainer, spark):
    settings = {"maxIter": 5, "stepSize": 0.2, "maxDepth": 3}
    plain = MD.make_classifier("gbt", **settings).fit(trainer.x)
    own = trainer.fit("gbt", **settings).stages[-1]
    assert np.allclose(_margins(own, trainer.x), _margins(plain, trainer.x), atol=1e-9)
    assert np.allclose(own.featureImportances.toArray(), plain.featureImportances.toArray(), atol=1e-9)
    assert own.treeWeights == plain.treeWeights and own.getNumTrees == 5
    assert {p.name: v for p, v in own.extractParamMap().items()} == {p.name: v for p, v in plain.extractParamMap().items()}
    other = [m.trees for m in (own, plain)]
    for a, b in zip(*other, strict=True):
        assert a.toDebugString.split("\n")[1].split("<=")[0] == b.toDebugString.split("\n")[1].split("<=")[0]


def test_steps_and_tasks_grow_the_same_trees(trainer, monkeypatch):
    """In step over blocks, with nodes finished in tasks and the lineage cut, as in one task a model."""
    settings = [{"maxIter": 4, "stepSize": 0.3, "maxDepth": 7}, {"maxIter": 3, "stepSize": 0.1, "maxDepth": 2}]
    rows = trainer.boosting_rows()
    whole = B.fit(rows, settings, squares=True)
    for name, value in (("WHOLE_ROWS", 0), ("LOCAL_ROWS", 150), ("CUT", 2), ("WORK_A_PARTITION", 300), ("NODES_A_GROUP", 2)):
        monkeypatch.setattr(B, name, value)
    for direct in (B.DIRECT, 0):
        monkeypatch.setattr(B, "DIRECT", direct)
        for a, b in zip(whole, B.fit(rows, settings, squares=True), strict=True):
            assert a.weights == b.weights and len(a.trees) == len(b.trees)
            for s, t in zip(a.trees, b.trees, strict=True):
                x, y = ([v[:4] + v[5:6] for v in B._saved(k)] for k in (s, t))
                assert len(x) == len(y) and [v[0] for v in x] == [v[0] for v in y]
                assert np.allclose([v[1:3] for v in x], [v[1:3] for v in y], atol=1e-9)
                assert np.allclose([v[3] for v in x], [v[3] for v in y], atol=1e-6)


def test_every_split_is_the_best(trainer):
    """Each inner node's gain is the largest that plain loops find, each leaf's value the mean of its rows."""
    rows = trainer.boosting_rows()
    tree = B.fit(rows, [{"maxIter": 1, "stepSize": 0.1, "maxDepth": 6}])[0].trees[0]
    found = trainer.x.select("label", vector_to_array("features")).collect()
    x, y = np.array([r[1] for r in found]), np.array([2 * r[0] - 1 for r in found])

    def check(node, here):
        assert tree.rows[node] == here.sum() and np.isclose(tree.value[node], y[here].mean())
        if tree.feature[node] < 0:
            return 1
        gains = []
        for j in range(x.shape[1]):
            for v in np.unique(x[here, j])[:-1]:
                low = here & (x[:, j] <= v)
                high = here & ~low
                gains.append(y[here].var() - (low.sum() * y[low].var() + high.sum() * y[high].var()) / here.sum())
        assert np.isclose(tree.gain[node], max(gains))
        low = x[:, tree.feature[node]] <= tree.threshold[node]
        return check(tree.left[node], here & low) + check(tree.left[node] + 1, here & ~low)

    assert check(0, np.ones(len(y), dtype=bool)) > 8


def test_features_of_many_values_and_odd_ones(spark):
    """More values than bins, or a value that isn't a number: MLlib's own learner. Negative values and constant features fit."""
    from pyspark.ml.linalg import Vectors

    rnd = np.random.default_rng(3)
    x = np.stack([rnd.integers(-3, 3, 300), rnd.integers(1, 4, 300), np.full(300, 7)], axis=1).astype(float)
    y = (x[:, 0] + x[:, 1] + rnd.normal(size=300) > 1.5).astype(float)
    df = spark.createDataFrame([(float(a), Vectors.dense(b.tolist())) for a, b in zip(y, x, strict=True)], ["label", "features"]).repartition(1).cache()
    settings = {"maxIter": 3, "stepSize": 0.3, "maxDepth": 4}
    rows = B.Rows.of(df)
    own = [r[0][0] for r in B.margins(B.fit(rows, [settings]), df, [3], "m").select("m").collect()]
    assert np.allclose(own, _margins(MD.make_classifier("gbt", **settings).fit(df), df), atol=1e-9)
    for bad in ([float(i) for i in range(40)], [float("nan"), 1.0]):
        assert B.Rows.of(spark.createDataFrame([(0.0, Vectors.dense([v])) for v in bad], ["label", "features"])) is None
    assert B.Rows.of(df.where("label > 5")) is None
    assert not B.takes({"maxIter": 3, "maxDepth": 2, "stepSize": 0.1, "subsamplingRate": 0.5})


def test_sweeps_and_grids_fit_no_chain_a_model(spark, trainer, monkeypatch):
    """the number of jobs doesn't grow with rates, rounds or levels."""
    def never(*a, **b):
        raise AssertionError("a fit of its own")

    monkeypatch.setattr(TU, "make_classifier", never)
    rows = TU.sweep(trainer.x, trainer.x, [0.1, 0.2, 0.3], [2, 5]).collect()
    assert [(r["rate"], r["trees"]) for r in rows] == [(r, k) for r in (0.1, 0.2, 0.3) for k in (2, 5)]
    monkeypatch.setattr(MD.Trainer, "fit", never)
    sc = spark.sparkContext

    def jobs(grid):
        before = sc._jsc.sc().dagScheduler().numTotalJobs()
        TU.grid_search(_rows(spark, 300), SPEC, "gbt", grid, folds=2).collect()
        return sc._jsc.sc().dagScheduler().numTotalJobs() - before

    assert abs(jobs({"maxDepth": [2, 3], "maxIter": [1, 2]}) - jobs({"maxDepth": [2, 8], "maxIter": [1, 20]})) < 20
