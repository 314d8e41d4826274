"""Property tests of the operators on small fixtures (brute force where SQL does not apply)."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from prospect.functions.ordered import dense_index, keyed_sequence, running_sums
from prospect.operators import metrics as M
from prospect.operators import prep as P
from prospect.operators import sampling as SA
from prospect.operators import stats as S


def test_hash_split_disjoint_complete_and_layout_free(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    a = SA.hash_split(df, "k", {"train": 0.7, "test": 0.3}, seed=3)
    b = SA.hash_split(df.repartition(7), "k", {"train": 0.7, "test": 0.3}, seed=3)
    ra = {r["k"]: r["split"] for r in a.collect()}
    rb = {r["k"]: r["split"] for r in b.collect()}
    assert ra == rb and len(ra) == 5000
    share = sum(v == "train" for v in ra.values()) / 5000
    assert 0.66 < share < 0.74


def test_degenerate_split_keeps_everything(spark):
    df = spark.range(0, 100).withColumnRenamed("id", "k")
    s = SA.split_frames(df, "k", {"train": 1.0, "test": 0.0})
    assert s["train"].count() == 100 and s["test"].count() == 0


def test_stratified_sample_keeps_all_of_fraction_one(spark):
    df = spark.range(0, 2000).select(F.col("id").alias("k"), F.when(F.col("id") % 10 == 0, "yes").otherwise("no").alias("y"))
    s = SA.hash_sample_by(df, "k", "y", {"yes": 1.0, "no": 0.2}, seed=1)
    got = dict(s.groupBy("y").count().collect())
    assert got["yes"] == 200 and 250 < got["no"] < 470


def test_running_sums_equal_single_window(spark):
    rng = np.random.default_rng(0)
    rows = [(float(v), int(p), int(n)) for v, p, n in zip(rng.normal(size=3000).round(3), rng.integers(0, 5, 3000),
                                                          rng.integers(0, 5, 3000))]
    df = spark.createDataFrame(rows, "score double, pos long, neg long").groupBy("score").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    got = {r["score"]: (r["cum_pos"], r["cum_neg"]) for r in running_sums(df, "score", ["pos", "neg"], n_buckets=16).collect()}
    pdf = df.toPandas().sort_values("score")
    exp = dict(zip(pdf.score, zip(pdf.pos.cumsum(), pdf.neg.cumsum())))
    assert got == exp
    got_d = {r["score"]: r["cum_pos"] for r in running_sums(df, "score", ["pos"], descending=True, n_buckets=8).collect()}
    pdf = pdf.sort_values("score", ascending=False)
    assert got_d == dict(zip(pdf.score, pdf.pos.cumsum()))


def test_dense_index_is_dense_and_unique(spark):
    df = spark.range(0, 3000).select((F.col("id") % 777).cast("string").alias("u"))
    ix = dense_index(df, "u", "ui", n_buckets=8).collect()
    ids = sorted(r["ui"] for r in ix)
    assert ids == list(range(777))
    again = {r["u"]: r["ui"] for r in dense_index(df.repartition(5), "u", "ui", n_buckets=8).collect()}
    assert again == {r["u"]: r["ui"] for r in ix}


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.exponential(size=2000), np.full(500, 0.25)])
    rows = [("a", float(v)) for v in vals] + [("b", float(v)) for v in rng.integers(0, 9, 301)]
    df = spark.createDataFrame(rows, "feature string, value double")
    # A hot value (a third of "c") and a far outlier, as the 999 sentinel makes.
    rows += [("c", 7.0)] * 700 + [("c", float(v)) for v in rng.normal(size=1400)] + [("c", 1e9)]
    df = spark.createDataFrame(rows, "feature string, value double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    for acc in (20, 100_000):  # a coarse sketch gives real brackets; a fine one is exact
        got = {(r["feature"], r["p"]): r["q"]
               for r in S.exact_quantiles(df, "feature", "value", probs, accuracy=acc).collect()}
        for f in ("a", "b", "c"):
            x = np.array([v for g, v in rows if g == f])
            for p in probs:
                assert got[(f, p)] == pytest.approx(np.quantile(x, p), abs=1e-9)


def test_auc_equals_brute_force_and_mllib(spark):
    import pandas as pd
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.linalg import Vectors, VectorUDT
    rng = np.random.default_rng(2)
    lab = rng.integers(0, 2, 2000)
    # With ties: midrank (Mann-Whitney) formula by brute force.
    tied = np.round(rng.normal(size=2000) + lab * 0.7, 2)
    df = spark.createDataFrame([(float(l), float(s)) for l, s in zip(lab, tied)], "label double, score double")
    r = pd.Series(tied).rank()
    pos, neg = lab.sum(), len(lab) - lab.sum()
    brute = (r[lab == 1].sum() - pos * (pos + 1) / 2) / (pos * neg)
    assert M.auc_exact(df, digits=12).first()["auc"] == pytest.approx(brute, abs=1e-12)
    # Without ties: MLlib's exact mode (numBins=0) agrees.
    distinct = rng.normal(size=2000) + lab * 0.7
    df2 = spark.createDataFrame([(float(l), float(s)) for l, s in zip(lab, distinct)], "label double, score double")
    raw = df2.withColumn("raw", F.udf(lambda s: Vectors.dense([-s, s]), VectorUDT())("score"))
    ml = BinaryClassificationEvaluator(rawPredictionCol="raw", numBins=0).evaluate(raw)
    assert M.auc_exact(df2, digits=12).first()["auc"] == pytest.approx(ml, abs=1e-9)


def test_metrics_on_edge_inputs(spark):
    empty = spark.createDataFrame([], "label double, prediction double, score double")
    r = M.binary_metrics(empty).first()
    assert r["accuracy"] is None and r["precision"] is None
    one_class = spark.createDataFrame([(0.0, 0.0, 0.1)] * 5, "label double, prediction double, score double")
    r = M.binary_metrics(one_class).first()
    assert r["accuracy"] == 1.0 and r["precision"] is None and r["recall"] is None
    assert M.auc_exact(one_class).first()["auc"] is None


def test_sanitize_rejects_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, a_b int")
    with pytest.raises(ValueError):
        P.sanitize_columns(df)


def test_unknown_policies(spark):
    df = spark.createDataFrame([("x", 1), ("unknown", 2), ("y", 3), ("y", 4), (None, 5)], "c string, k int")
    assert P.unknown_policy(df, ["c"], how="drop").count() == 4
    got = {r["k"]: r["c"] for r in P.unknown_policy(df, ["c"], how="mode").collect()}
    assert got[2] == "y" and got[5] is None


def test_try_cast_bad_text_is_null(spark):
    df = spark.createDataFrame([("1.5",), ("oops",), (None,)], "x string")
    assert [r["x"] for r in P.cast_columns(df, ["x"]).collect()] == [1.5, None, None]


def test_histogram_counts_every_value_once(spark):
    rng = np.random.default_rng(3)
    vals = rng.normal(size=999).tolist() + [None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    h = S.histogram(df, ["x"], bins=30).collect()
    assert len(h) == 30 and sum(r["n"] for r in h) == 999
    counts, _ = np.histogram([v for v in vals if v is not None], bins=30)
    assert [r["n"] for r in sorted(h, key=lambda r: r["bin"])] == counts.tolist()


def test_keyed_sequence_equals_window_with_hot_key(spark):
    from pyspark.sql import Window
    rng = np.random.default_rng(5)
    n = 4000
    # Key 0 owns a third of the rows; many rows share a day, so the tie-breaker matters.
    keys = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 200, n))
    rows = [(int(i), int(k), int(d), str(rng.integers(0, 3))) for i, k, d in
            zip(rng.permutation(n), keys, rng.integers(0, 40, n))]
    df = spark.createDataFrame(rows, "id long, k long, day int, v string")
    got = keyed_sequence(df, "k", ["day", "id"], {"prev_v": "v", "prev_day": "day"}, number="rn")
    w = Window.partitionBy("k").orderBy("day", "id")
    ref = df.select("*", F.lag("v").over(w).alias("prev_v"), F.lag("day").over(w).alias("prev_day"),
                    (F.row_number().over(w) - 1).cast("bigint").alias("rn"))
    assert got.count() == n
    assert got.exceptAll(ref.select(got.columns)).count() == 0


def test_cv_folds_balanced_on_train_split(spark):
    df = spark.range(0, 6000).withColumnRenamed("id", "k")
    train = SA.split_frames(df, "k", {"train": 0.8, "test": 0.2}, seed=420)["train"]
    sizes = [r["n"] for r in train.groupBy(SA.fold_index("k", 3, 4201).alias("f"))
             .agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 3 and min(sizes) / max(sizes) > 0.9


def _brute_knn(pts: np.ndarray, ids: np.ndarray, k: int) -> set:
    lo, hi = pts.min(0), pts.max(0)
    span = np.where(hi > lo, hi - lo, 1.0)
    z = np.where(hi > lo, (pts - lo) / span, 0.0)
    out = set()
    for a in range(len(ids)):
        d = np.sqrt(((z - z[a]) ** 2).sum(1))
        order = sorted((round(float(d[b]), 9), int(ids[b])) for b in range(len(ids)) if b != a)[:k]
        out |= {(int(ids[a]), nid, r + 1, dist) for r, (dist, nid) in enumerate(order)}
    return out


def test_knn_exact_in_five_dims_with_duplicates(spark):
    from prospect.operators.smote import knn
    rng = np.random.default_rng(11)
    n, d = 300, 5
    pts = rng.normal(size=(n, d)) * np.array([1, 5, 0.1, 2, 3])
    pts[:40] = pts[0]                 # a block of identical points
    pts[:, 2] = np.round(pts[:, 2], 1)  # a coarse dimension
    ids = rng.permutation(n) + 1000
    cols = [f"x{i}" for i in range(d)]
    df = spark.createDataFrame([(int(i), *map(float, p)) for i, p in zip(ids, pts)],
                               "id long, " + ", ".join(f"{c} double" for c in cols))
    got = {(r["qid"], r["nid"], r["rank"], round(r["dist"], 9)) for r in knn(df, "id", cols, k=5).collect()}
    assert got == _brute_knn(pts, ids, 5)


def test_knn_constant_features(spark):
    from prospect.operators.smote import knn
    df = spark.createDataFrame([(i, 1.0, 2.0) for i in range(20)], "id long, a double, b double")
    got = {(r["qid"], r["nid"], r["rank"]) for r in knn(df, "id", ["a", "b"], k=3).collect()}
    want = {(q, n, r + 1) for q in range(20) for r, n in enumerate([x for x in range(20) if x != q][:3])}
    assert got == want


def test_contacts_history_equals_plain_window(spark, small_dir):
    from pyspark.sql import Window
    from prospect.sources.contacts import contacts
    from prospect.sources.tables import Tables
    t = Tables(spark, small_dir)
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    plain = t.orders.select(F.col("o_orderkey").alias("contact_id"),
                            (F.row_number().over(w) - 1).cast("bigint").alias("previous"),
                            F.when(F.lag("o_orderdate").over(w).isNull(), 999).otherwise(
                                F.least(F.datediff("o_orderdate", F.lag("o_orderdate").over(w)), F.lit(998)))
                            .cast("bigint").alias("pdays"))
    got = contacts(t).select("contact_id", "previous", "pdays")
    assert got.count() == plain.count() and got.exceptAll(plain).count() == 0


def test_auc_and_roc_leave_out_missing_scores(spark):
    rows = [(1.0, 0.5), (0.0, 0.5), (0.0, None), (1.0, None), (0.0, float("nan")), (None, 0.9)]
    df = spark.createDataFrame(rows, "label double, score double")
    assert M.auc_exact(df).first()["auc"] == 0.5
    assert [(r["threshold"], r["tpr"], r["fpr"]) for r in M.roc_curve(df).collect()] == [(0.5, 1.0, 1.0)]


def test_histogram_by_many_classes(spark):
    from prospect.operators.stats import histogram
    df = spark.range(2400).select((F.col("id") % 1200).cast("string").alias("c"), F.col("id").cast("double").alias("v"))
    h = histogram(df, ["v"], bins=2, by="c")
    assert h.count() == 2400 and h.agg(F.sum("n")).first()[0] == 2400


@pytest.mark.parametrize("shape", ["outlier", "dense cluster"])
def test_knn_exact_where_points_are_unevenly_spread(spark, shape):
    from prospect.operators.smote import knn
    rng = np.random.default_rng(8)
    x = rng.uniform(size=(700, 3))
    if shape == "outlier":
        x[0] = 100.0
    else:
        x[:400] = 0.5 + 1e-5 * rng.normal(size=(400, 3))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")
    got = {(r["qid"], r["nid"], r["rank"], round(r["dist"], 9)) for r in knn(df, "id", ["a", "b", "c"], k=4).collect()}
    assert got == _brute_knn(x, np.arange(len(x)), 4)


def test_auc_many_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    n = 700
    lab = rng.integers(0, 2, n)
    cols = {"a": rng.normal(size=n) + lab, "ties": rng.integers(0, 4, n) * 1.0, "one": np.full(n, 3.0), "gaps": rng.normal(size=n),
            "far": np.where(rng.random(n) < 0.1, np.inf, rng.normal(size=n))}
    rows = [(float(lab[i]) if i % 41 else None, *[float(v[i]) if k != "gaps" or i % 3 else (None if i % 2 else float("nan")) for k, v in cols.items()])
            for i in range(n)]
    df = spark.createDataFrame(rows, "label double, " + ", ".join(f"`{k}` double" for k in cols)).withColumn("none", F.lit(None).cast("double"))
    for buckets in (1, 2, 16):
        got = {r["score"]: r["auc"] for r in M.auc_many(df, [*cols, "none"], n_buckets=buckets, digits=9).collect()}
        for j, k in enumerate(cols):
            x = [(r[0], r[1 + j]) for r in rows if r[0] is not None and r[1 + j] is not None and not np.isnan(r[1 + j])]
            pos, neg = [s for y, s in x if y == 1], [s for y, s in x if y != 1]
            want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
            assert got[k] == pytest.approx(want, abs=1e-9)
        assert got["none"] is None


def test_roc_corners_keep_the_curve(spark):
    rng = np.random.default_rng(9)
    rows = [(float(y), float(s)) for y, s in zip(rng.integers(0, 2, 900), rng.integers(0, 300, 900))]
    rows += [(1.0, 400.0)] * 40 + [(1.0, 400.0 + i) for i in range(40)]
    df = spark.createDataFrame(rows, "label double, score double").repartition(5)
    full = sorted((r["fpr"], r["tpr"]) for r in M.roc_curve(df, digits=12).collect())
    corners = sorted((r["fpr"], r["tpr"]) for r in M.roc_corners(df, digits=12).collect())
    assert set(corners) < set(full) and corners[-1] == (1.0, 1.0) and len(corners) < len(full) - 35
    xs, ys = zip(*([(0.0, 0.0)] + corners))
    pts = [p for p in full if p[0] > 0]
    assert np.allclose(np.interp([p[0] for p in pts], xs, ys), [p[1] for p in pts], atol=1e-9) or len({p[0] for p in pts}) < len(pts)
    area = lambda c: sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip([(0.0, 0.0)] + c, c))
    assert area(corners) == pytest.approx(area(full), abs=1e-9)
    assert M.roc_corners(df.where("false")).count() == 0
