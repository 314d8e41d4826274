"""Fits on large tables: how training rows are laid out, and that work shared by fits is done once."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.recommendation import ALS
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

from prospect.operators import models as MD
from prospect.operators import recommend as R
from prospect.operators import tuning as TU
from prospect.operators.features import encoding_stages, labelled
from prospect.operators.sampling import fold_index
from prospect.plans import q_models, q_streaming
from prospect.spec import TableSpec

SPEC = TableSpec(categorical=("job",), numeric=("a", "b"), id="id")


def _rows(spark, n=600):
    rnd = np.random.default_rng(5)
    a, b, job = rnd.normal(size=n), rnd.normal(size=n), rnd.integers(0, 4, n)
    yes = a + 0.5 * b + (job == 2) + rnd.normal(size=n) > 0.7
    return spark.createDataFrame([(i, f"j{job[i]}", float(a[i]), float(b[i]), "yes" if yes[i] else "no") for i in range(n)],
                                 "id long, job string, a double, b double, y string")


def test_partitions_of_large_tables():
    """Small tables keep their partitions; a large one's grow with the rows, but are few."""
    assert [MD.fit_partitions(n) for n in (0, 20_000, 20_001, 120_000, 480_000)] == [1, 1, 2, 6, 24]
    assert [MD.fit_partitions(n) for n in (7_200_000, 43_200_000, 432_000_000)] == [24, 108, 1080]
    mlp = (MD.ROWS_A_PARTITION_MLP, MD.MOST_ROWS_A_PARTITION_MLP)
    assert [MD.fit_partitions(n, *mlp) for n in (2_000, 12_000, 7_200_000)] == [1, 6, 72]
    assert [MD.fit_partitions(n, together=16) for n in (0, 216_000, 7_200_000)] == [1, 1, 18]
    assert MD.fit_partitions(216_000, together=4) == 3


def test_deep_trees_keep_node_ids_and_their_trees(spark):
    rows = _rows(spark)
    for name, params in (("dt", {"maxDepth": 12}), ("rf", {"maxDepth": 12, "numTrees": 5})):
        assert MD.make_classifier(name).getCacheNodeIds()
        a, b = (MD.train_pipeline(rows, SPEC, name, **params, **kw) for kw in ({}, {"cacheNodeIds": False}))
        assert a.stages[-1].toDebugString.split("\n")[1:] == b.stages[-1].toDebugString.split("\n")[1:]


def test_cross_validation_equals_the_plain_one_and_fits_encoders_once_a_fold(spark, monkeypatch):
    rows, grid = _rows(spark), {"regParam": [0.0, 0.1, 0.5]}
    fits = []
    monkeypatch.setattr(TU, "encoding_stages", lambda *a, **b: fits.append(1) or encoding_stages(*a, **b))
    model, report = TU.cross_validate(rows, SPEC, "lr", grid, folds=3)
    assert len(fits) == 4  # three folds and the last model, whatever the candidates
    clf = MD.make_classifier("lr")
    data = labelled(rows, SPEC).withColumn("_fold", fold_index("id", 3, 4201)).repartition(1, "id").sortWithinPartitions("id")
    plain = CrossValidator(estimator=Pipeline(stages=[*encoding_stages(SPEC), clf]), estimatorParamMaps=TU.param_grid(clf, grid), numFolds=3,
                           foldCol="_fold", evaluator=BinaryClassificationEvaluator(numBins=0)).fit(data)
    got = [r["avg_auc"] for r in report.orderBy("candidate").collect()]
    assert np.allclose(got, plain.avgMetrics, atol=1e-9) and np.allclose(model.avgMetrics, got)
    assert np.allclose(model.bestModel.stages[-1].coefficients.toArray(), plain.bestModel.stages[-1].coefficients.toArray(), atol=1e-6)


def test_als_cross_validation_equals_the_plain_one(spark, monkeypatch):
    rnd = np.random.default_rng(2)
    pairs = sorted({(int(u), int(i)) for u, i in zip(rnd.integers(0, 40, 900), rnd.integers(0, 30, 900), strict=True)})
    r = spark.createDataFrame([(f"{u}:{i}", u, i, float((u * i) % 7)) for u, i in pairs], "key string, userIndex int, itemIndex int, rating double")
    intervals = []
    monkeypatch.setattr(R, "ALS", lambda **kw: intervals.append(kw.get("checkpointInterval", 10)) or ALS(**kw))
    grid = {"regParam": [0.01, 0.1], "rank": [2, 3]}
    got = [x["avg_rmse"] for x in R.cross_validate_als(r, "key", grid, folds=3, max_iter=4).orderBy("candidate").collect()]
    als = ALS(maxIter=4, seed=42, userCol="userIndex", itemCol="itemIndex", ratingCol="rating", coldStartStrategy="drop")
    maps = ParamGridBuilder().addGrid(als.regParam, grid["regParam"]).addGrid(als.rank, grid["rank"]).build()
    data = r.repartition(1, "userIndex").sortWithinPartitions("userIndex", "itemIndex").withColumn("_fold", fold_index("key", 3, 4201))
    plain = CrossValidator(estimator=als, estimatorParamMaps=maps, numFolds=3, foldCol="_fold",
                           evaluator=RegressionEvaluator(metricName="rmse", labelCol="rating")).fit(data)
    assert np.allclose(got, plain.avgMetrics, atol=1e-4)
    R.fit_als(r, max_iter=1)
    assert intervals and max(intervals) <= 2  # shuffles of earlier iterations go while the fit runs


def test_contacts_are_joined_once(spark, small_dir, monkeypatch):
    seen = []
    plain = MD.labelled
    monkeypatch.setattr(q_models, "labelled", lambda df, spec: seen.append(df.inputFiles()) or plain(df, spec))
    assert q_models.q_unfitted_refit(spark, small_dir).first()["n_differ"] == 0
    fit = MD.train_pipeline
    monkeypatch.setattr(q_streaming.MD, "train_pipeline", lambda df, *a, **b: seen.append(df.inputFiles()) or fit(df, *a, **b))
    assert q_streaming.q_stream_batch_diff(spark, small_dir).first()["n_differ"] == 0
    assert len(seen) == 2 and all(files and not any("lineitem" in f for f in files) for files in seen)


def test_fits_side_by_side_share_the_partitions(spark, monkeypatch):
    class Asked(Exception):
        pass

    def trainer(*a, together, **b):
        raise Asked(together)

    monkeypatch.setattr(TU, "Trainer", trainer)
    for name, grid, fits in (("gbt", {"maxDepth": [1, 2], "maxIter": [1, 2]}, 4), ("rf", {"maxDepth": [1, 2], "numTrees": [1, 2]}, 1)):
        with pytest.raises(Asked, match=f"^{fits}$"):
            TU.grid_search(_rows(spark), SPEC, name, grid, folds=2)


def test_deep_boosted_fits_cut_their_lineage_after_every_tree(spark):
    assert MD.make_classifier("gbt", maxDepth=15).getCheckpointInterval() == 1
    assert MD.make_classifier("gbt").getCheckpointInterval() == 10
    assert MD.make_classifier("gbt", maxDepth=15, checkpointInterval=3).getCheckpointInterval() == 3
    t = MD.Trainer(_rows(spark, 300), SPEC)
    try:
        a, b = (t.fit("gbt", maxIter=3, maxDepth=10, **p).stages[-1] for p in ({}, {"checkpointInterval": 10}))
    finally:
        t.close()
    assert a.toDebugString.split("\n", 1)[1] == b.toDebugString.split("\n", 1)[1]


def test_grid_rows_are_scored_once(spark, monkeypatch):
    plans, areas = [], TU.auc_many

    def seen(x, *args, **kw):
        plans.append(x._jdf.queryExecution().optimizedPlan().toString())
        return areas(x, *args, **kw)

    monkeypatch.setattr(TU, "auc_many", seen)
    TU.grid_search(_rows(spark, 200), SPEC, "gbt", {"maxDepth": [2, 3], "maxIter": [1, 2]}, folds=2).collect()
    assert len(plans) == 2
    assert all(p.startswith("Relation") for p in plans), plans
