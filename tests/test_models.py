"""Property tests of fitted models, SMOTE and streaming (no SQL twin for these)."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from prospect.operators import metrics as M
from prospect.operators import models as MD
from prospect.operators import sampling as SA
from prospect.plans.q_stats import cts
from prospect.session import scratch_path
from prospect.spec import CONTACTS

MID = "/root/testdata/sf0.01"


def _split(spark, d):
    return SA.split_frames(cts(spark, d), "contact_id", {"train": 0.8, "test": 0.2}, seed=420)


def _preds(df):
    return {r["contact_id"]: (r["prediction"], round(r["p1"], 12)) for r in df.collect()}


def test_gbt_repeatable_save_load_and_probabilities(spark, small_dir):
    p = _split(spark, small_dir)
    a = MD.train_pipeline(p["train"], CONTACTS, "gbt", maxIter=10)
    b = MD.train_pipeline(p["train"], CONTACTS, "gbt", maxIter=10)
    sa = _preds(MD.score(p["test"], a, "contact_id"))
    assert sa == _preds(MD.score(p["test"], b, "contact_id"))
    path = scratch_path(spark, "model-roundtrip")
    MD.save(a, path)
    assert sa == _preds(MD.score(p["test"], MD.load(path), "contact_id"))
    prob = a.transform(p["test"]).select(vector_to_array("probability").alias("v"))
    bad = prob.where((F.abs(F.col("v")[0] + F.col("v")[1] - 1) > 1e-9) | (F.col("v")[0] < 0) | (F.col("v")[1] < 0))
    assert bad.count() == 0


def test_gbt_auc_above_chance_on_planted_signal(spark):
    p = _split(spark, MID)
    model = MD.train_pipeline(p["train"], CONTACTS, "gbt", maxIter=10)
    auc = M.auc_exact(MD.score(p["test"], model, "contact_id"), score="p1").first()["auc"]
    assert auc > 0.6


def test_training_partitions_follow_the_rows(spark, small_dir):
    assert [MD.train_partitions(n) for n in (0, 1, 20_000, 20_001, 10 ** 9)] == [1, 1, 1, 2, 50_000]
    t = MD.Trainer(_split(spark, small_dir)["train"], CONTACTS, partitions=5)
    try:
        rows = t.x.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
        assert len(rows) == 5 and min(rows) > 0 and max(rows) < sum(rows) / 2
    finally:
        t.close()


def test_bin_borders(spark):
    from prospect.operators.features import bin_borders
    rnd = np.random.default_rng(3)
    n = 4000
    cols = {"even": rnd.normal(size=n), "few": rnd.integers(0, 3, n).astype(float), "one": np.full(n, 7.0),
            "hot": np.where(rnd.random(n) < 0.9, 999.0, rnd.random(n)), "odd": np.where(np.arange(n) == 5, -5.0, np.where(np.arange(n) % 2, 1.0, 2.0))}
    df = spark.createDataFrame([tuple(float(v[i]) if i % 50 or k != "even" else None for k, v in cols.items()) for i in range(n)],
                               ", ".join(f"{k} double" for k in cols)).repartition(6)
    got = bin_borders(df, list(cols), bins=32)
    assert len(got["even"]) == 31 and got["even"] == sorted(got["even"])
    assert got["few"] == [1.0, 2.0] and got["one"] == [7.0]
    for k, v in cols.items():
        x = np.array([c for i, c in enumerate(v) if i % 50 or k != "even"])
        share = np.bincount(np.searchsorted(got[k], x, side="right"), minlength=len(got[k]) + 1)
        assert k == "one" or share.min() >= len(x) / 128
    assert bin_borders(df.where("false"), ["even"])["even"] == [0.0]


def test_grid_search_scores_prefixes_like_separate_fits(spark, small_dir):
    """Every candidate's area equals that of models fitted one by one on the same folds."""
    from prospect.operators import tuning as TU
    from prospect.operators.sampling import fold_index
    train = _split(spark, small_dir)["train"]
    grid = {"maxDepth": [2, 3], "maxIter": [3, 8]}
    rows = TU.grid_search(train, CONTACTS, "gbt", grid, folds=2, stepSize=0.1).collect()
    assert [r["candidate"] for r in rows] == [0, 1, 2, 3] and sum(r["is_best"] for r in rows) == 1
    assert max(rows, key=lambda r: (r["avg_auc"], -r["candidate"]))["is_best"]
    import json
    for r in rows:
        areas = []
        for fold in range(2):
            f = fold_index("contact_id", 2, 4201)
            m = MD.train_pipeline(train.where(f != fold), CONTACTS, "gbt", stepSize=0.1, **json.loads(r["params"]))
            areas.append(M.auc_exact(MD.score(train.where(f == fold), m, "contact_id"), score="p1", digits=12).first()["auc"])
        assert abs(r["avg_auc"] - sum(areas) / 2) < 1e-9
    forest = TU.grid_search(train, CONTACTS, "rf", {"maxDepth": [2], "numTrees": [4, 9]}, folds=2).collect()
    assert len(forest) == 2 and all(0.4 < r["avg_auc"] <= 1 for r in forest)


def test_forests_of_all_depths_come_from_one_fit(spark, small_dir, monkeypatch):
    """Areas of a forest grid over depths equal those of forests fitted one by one; one fit a fold."""
    import json
    from prospect.operators import tuning as TU
    from prospect.operators.sampling import fold_index
    from prospect.session import stored
    train = stored(_split(spark, small_dir)["train"], "grid-test")
    fits, plain = [], MD.Trainer.fit
    monkeypatch.setattr(MD.Trainer, "fit", lambda self, name, **p: fits.append(p) or plain(self, name, **p))
    rows = TU.grid_search(train, CONTACTS, "rf", {"maxDepth": [2, 5], "numTrees": [5]}, folds=2).collect()
    assert len(fits) == 2
    for r in rows:
        areas = []
        for fold in range(2):
            f = fold_index("contact_id", 2, 4201)
            m = MD.train_pipeline(train.where(f != fold), CONTACTS, "rf", **json.loads(r["params"]))
            areas.append(M.auc_exact(MD.score(train.where(f == fold), m, "contact_id"), score="p1", digits=12).first()["auc"])
        assert abs(r["avg_auc"] - sum(areas) / 2) < 1e-9, r


def test_running_scores_of_a_forest(spark, small_dir):
    """After all trees the mean share of class 1 is the forest's own probability."""
    from prospect.operators import tuning as TU
    p = _split(spark, small_dir)
    t = MD.Trainer(p["train"], CONTACTS)
    try:
        model = t.fit("rf", numTrees=7, maxDepth=4)
    finally:
        t.close()
    x = TU.running_scores(model.stages[-1], t.features(p["test"], "contact_id"), [1, 7], "s").select("contact_id", "s")
    own = {r["contact_id"]: r["p1"] for r in MD.score(p["test"], model, "contact_id").collect()}
    rows = x.collect()
    assert len(rows) == len(own) and all(abs(own[r["contact_id"]] - r["s"][1]) < 1e-12 for r in rows)


def test_sweep_counts_match_the_model(spark, small_dir):
    from prospect.operators import tuning as TU
    p = _split(spark, small_dir)
    t = MD.Trainer(p["train"], CONTACTS)
    try:
        x = t.features(p["test"]).persist()
        got = {(r["rate"], r["trees"]): r for r in TU.sweep(t.x, x, [0.1, 0.3], [2, 6]).collect()}
        one = {r["rate"]: r for r in TU.sweep(t.x, x, [0.1, 0.3], [6]).collect()}
        for rate in (0.1, 0.3):
            m = t.fit("gbt", maxIter=6, stepSize=rate, maxDepth=3).stages[-1]
            want = M.binary_metrics(m.transform(x), digits=6).first()
            for r in (got[rate, 6], one[rate]):
                assert (r["accuracy"], r["recall"], r["precision"]) == (want["accuracy"], want["recall"], want["precision"])
        assert len(got) == 4 and sum(r["is_best"] for r in got.values()) == 1
    finally:
        t.close()


def test_smote_balanced_and_between_parents(spark, small_dir):
    from prospect.operators.smote import smote, synthetic_rows
    cols = ["cons_conf_idx", "nr_employed"]
    c = cts(spark, small_dir).select("contact_id", "y", *cols)
    out = smote(c, "contact_id", "y", cols, k=5, seed=3)
    counts = {r["y"]: r["n"] for r in out.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts["yes"] == counts["no"]
    minority = c.where(F.col("y") == "yes")
    n_new = counts["no"] - minority.count()
    syn = synthetic_rows(minority, "contact_id", cols, n_new, k=5, seed=3)
    x = minority.select(F.col("contact_id"), *[F.col(k).alias(f"x_{k}") for k in cols])
    nb = minority.select(F.col("contact_id").alias("nid"), *[F.col(k).alias(f"n_{k}") for k in cols])
    rows = syn.join(x, "contact_id").join(nb, "nid").collect()
    assert len(rows) == n_new
    for r in rows:
        us = [(r[k] - r[f"x_{k}"]) / (r[f"n_{k}"] - r[f"x_{k}"]) for k in cols if r[f"n_{k}"] != r[f"x_{k}"]]
        assert all(-1e-9 <= u <= 1 + 1e-9 for u in us)
        assert not us or max(us) - min(us) < 1e-6  # one weight for every feature: on the segment


def test_cells_are_numbered_by_search(spark):
    """A cell's number is the count of borders at most the value: repeats count, and what is no number lies past all of them."""
    from prospect.operators.smote import _in_cells
    nan = float("nan")
    borders = {"a": [0.0, 0.25, 0.25, 0.25, 0.5], "b": [], "c": [0.1, nan], "d": [0.5]}
    values = [-1.0, 0.0, 0.1, 0.2, 0.25, 0.3, 0.5, 0.75, nan]
    df = spark.createDataFrame([(x,) for x in values], "z double")
    out = _in_cells(df, {k: ("z", at) for k, at in borders.items()})
    assert out.columns == ["z", *borders] and [t for _, t in out.dtypes[1:]] == ["int"] * 4
    assert "lambda" not in out._jdf.queryExecution().executedPlan().toString()  # no pass over the borders a row
    for r in out.collect():
        for k, at in borders.items():
            assert r[k] == (len(at) if r["z"] != r["z"] else sum(b <= r["z"] for b in at)), (k, r)


def test_mixed_neighbours_equal_brute_force(spark):
    """Seven nominal and eight numeric columns, with ties, repeated rows, nulls, and a hot combination."""
    from prospect.operators.smote import knn_mixed
    rng = np.random.default_rng(5)
    nominal, numeric = [f"c{i}" for i in range(7)], [f"x{i}" for i in range(8)]
    rows = []
    for i in range(140):
        cats = ["a"] * 7 if i % 3 == 0 else [str(v) for v in rng.integers(0, 3, 7)]
        nums = [float(v) for v in rng.normal(size=8).round(1 if i % 4 else 0)]
        rows.append([i, *cats, *nums])
    rows[7][1:] = rows[8][1:] = rows[9][1:]
    rows[11][3] = rows[12][3] = None
    rows[20][10] = None
    df = spark.createDataFrame([tuple(r) for r in rows], "id long, " + ", ".join([f"{c} string" for c in nominal] + [f"{c} double" for c in numeric])).repartition(4)
    for cats, nums, k in ((nominal, numeric, 5), (nominal[:2], numeric[:1], 3), (nominal, [], 4), ([], numeric[:2], 3)):
        used = [r for r in rows if all(r[8 + numeric.index(c)] is not None for c in nums)]
        lo = {c: min(r[8 + numeric.index(c)] for r in used) for c in nums}
        hi = {c: max(r[8 + numeric.index(c)] for r in used) for c in nums}
        z = {r[0]: [(r[8 + numeric.index(c)] - lo[c]) / (hi[c] - lo[c]) for c in nums] for r in used}
        n = {r[0]: [r[1 + nominal.index(c)] for c in cats] for r in used}
        got = {}
        for r in knn_mixed(df, "id", cats, nums, k).collect():
            got.setdefault(r["qid"], {})[r["rank"]] = (r["nid"], r["dist"])
        assert set(got) == set(z)
        for q in z:
            def far(p):
                s = 2.0 * sum(a != b for a, b in zip(n[p], n[q]))
                for a, b in zip(z[p], z[q]):
                    s += (a - b) * (a - b)
                return s
            want = sorted((far(p), p) for p in z if p != q)[:k]
            assert [got[q][i + 1][0] for i in range(k)] == [p for _, p in want]
            assert np.allclose([got[q][i + 1][1] for i in range(k)], [np.sqrt(s) for s, _ in want])
    assert knn_mixed(df.where("false"), "id", nominal, numeric).count() == 0
    assert {r["rank"] for r in knn_mixed(df.where("id < 3"), "id", nominal, numeric[:1], 5).collect()} == {1, 2}


def test_oversampling_only_adds(spark, small_dir):
    from prospect.operators.features import labelled
    from prospect.operators.smote import oversampled
    rows = labelled(_split(spark, small_dir)["train"], CONTACTS).select("label", "contact_id", *CONTACTS.categorical, *CONTACTS.numeric)
    out = oversampled(rows, CONTACTS)
    n = {r["label"]: r["n"] for r in out.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert n[0.0] == n[1.0] == rows.where("label = 0").count()
    ids = rows.select("contact_id")
    assert out.join(ids, "contact_id", "left_semi").count() == rows.count()
    new = out.join(ids, "contact_id", "left_anti").collect()
    assert {r["label"] for r in new} == {1.0} and len({r["contact_id"] for r in new}) == len(new)
    seen = {c: {r[c] for r in rows.where("label = 1").select(c).collect()} for c in CONTACTS.categorical}
    assert all(r[c] in seen[c] for r in new for c in CONTACTS.categorical)
    again = {tuple(r) for r in oversampled(rows.repartition(3), CONTACTS).collect()}
    assert again == {tuple(r) for r in out.collect()}


def test_stream_scoring_equals_batch(spark, small_dir):
    from prospect.streaming import score_stream as SS
    c = cts(spark, small_dir)
    model = MD.train_pipeline(_split(spark, small_dir)["train"], CONTACTS, "lr")
    src = scratch_path(spark, "arrivals-test")
    c.write.parquet(src)
    stream = SS.scored_stream(spark, src, c.schema, model, "contact_id", max_files_per_trigger=1)
    sink = scratch_path(spark, "stream-test")
    SS.run_to_files(stream, sink, scratch_path(spark, "stream-test-ckpt"))
    got = _preds(spark.read.parquet(sink))
    assert got == _preds(MD.score(c, model, "contact_id"))
    assert len(got) == c.count()


def test_lone_classifier_scores_like_the_pipeline(spark, small_dir):
    from pyspark.ml import PipelineModel
    p = _split(spark, small_dir)
    model = MD.train_pipeline(p["train"], CONTACTS, "gbt", maxIter=5)
    path = scratch_path(spark, "lone")
    model.stages[-1].write().overwrite().save(path)
    clf = MD.load_classifier(path)
    out = clf.transform(PipelineModel(stages=model.stages[:-1]).transform(p["test"]))
    got = _preds(out.select("contact_id", "prediction", vector_to_array("probability")[1].alias("p1")))
    assert got == _preds(MD.score(p["test"], model, "contact_id"))


def test_fit_does_not_depend_on_layout_and_scores_unlabelled_rows(spark, small_dir):
    p = _split(spark, small_dir)
    a = MD.train_pipeline(p["train"].repartition(2), CONTACTS, "gbt", maxIter=4)
    b = MD.train_pipeline(p["train"].repartition(9, "job"), CONTACTS, "gbt", maxIter=4)
    assert _preds(MD.score(p["test"], a, "contact_id")) == _preds(MD.score(p["test"].drop("y"), b, "contact_id"))
    assert dict(MD.score(p["test"], a).dtypes)["label"] == "double"
    assert "label" not in MD.score(p["test"].drop("y"), a).columns


def test_train_and_score_jobs(spark, small_dir):
    from prospect import jobs
    c = cts(spark, small_dir)
    base = scratch_path(spark, "jobs")
    c.write.parquet(f"{base}/in")
    c.drop("y").write.parquet(f"{base}/new")
    jobs.main(["train", "--input", f"{base}/in", "--model", f"{base}/model"])
    for source, day in (("in", "2018-08-03"), ("new", "2018-08-04"), ("new", "2018-08-04")):
        jobs.main(["score", "--input", f"{base}/{source}", "--model", f"{base}/model", "--output", f"{base}/out", "--run-date", day])
    got = spark.read.parquet(f"{base}/out/scores")
    assert {str(r["run_date"]): r["n"] for r in got.groupBy("run_date").agg(F.count(F.lit(1)).alias("n")).collect()} == {
        "2018-08-03": c.count(), "2018-08-04": c.count()}
    m = spark.read.parquet(f"{base}/out/metrics").collect()
    assert len(m) == 1 and str(m[0]["run_date"]) == "2018-08-03" and 0 <= m[0]["accuracy"] <= 1
