"""What MLlib keeps with the rows of a forest's fit."""

from __future__ import annotations

import threading
import time

import numpy as np

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


def test_shallow_forests_keep_no_node_ids(spark):
    """a forest of 300 trees would keep 300 numbers a row for every level."""
    assert not MD.make_classifier("rf", maxDepth=7, numTrees=300).getCacheNodeIds()
    assert MD.make_classifier("rf").getCacheNodeIds() and MD.make_classifier("dt").getCacheNodeIds()


def test_large_forests_are_fitted_one_at_a_time(spark, monkeypatch):
    """the bootstrap of a fold is kept with its rows, so folds don't stand side by side."""
    at_once, most, lock, fit = [0], [0], threading.Lock(), MD.Trainer.fit

    def counted(self, *a, **b):
        with lock:
            at_once[0] += 1
            most[0] = max(most[0], at_once[0])
        time.sleep(1)
        try:
            return fit(self, *a, **b)
        finally:
            with lock:
                at_once[0] -= 1

    monkeypatch.setattr(MD.Trainer, "fit", counted)
    monkeypatch.setattr(TU, "MOST_DRAWS", 0)
    TU.grid_search(_rows(spark, 200), SPEC, "rf", {"maxDepth": [2], "numTrees": [2, 3]}, folds=2).collect()
    assert most[0] == 1
