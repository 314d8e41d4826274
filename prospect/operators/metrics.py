"""Evaluation of scored rows.

Every metric is one aggregate over ``(label, prediction[, score])`` rows, partially aggregated
before its single small shuffle. Divisions use ``try_divide`` so an empty class gives NULL, as
the original Spark 2 jobs did, instead of an ANSI error.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prospect.functions.ordered import BUCKET, add_range_bucket, default_buckets, running_sums


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row ``tn, tp, fn, fp`` (C14)."""
    lab, pred = F.col(label), F.col(prediction)
    return df.agg(
        F.count_if((lab == 0) & (pred == 0)).alias("tn"),
        F.count_if((lab == 1) & (pred == 1)).alias("tp"),
        F.count_if((lab == 1) & (pred == 0)).alias("fn"),
        F.count_if((lab == 0) & (pred == 1)).alias("fp"),
    )


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                   digits: int = 4) -> DataFrame:
    """One row ``accuracy, precision, recall`` rounded to ``digits``."""
    c = confusion_counts(df, label, prediction)
    tn, tp, fn, fp = (F.col(x) for x in ("tn", "tp", "fn", "fp"))
    return c.select(
        F.round(_div(tp + tn, tp + tn + fp + fn), digits).alias("accuracy"),
        F.round(_div(tp, tp + fp), digits).alias("precision"),
        F.round(_div(tp, tp + fn), digits).alias("recall"),
    )


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     normalise: bool = False, digits: int = 6) -> DataFrame:
    """``(label, prediction, n)`` and, normalised by true class, ``share``."""
    m = df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))
    if normalise:
        # The grouped table has at most (#classes)^2 rows; the window runs on that.
        m = m.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("label")), digits))
    return m


def accuracy_by_split(df: DataFrame, split: str = "split", label: str = "label",
                      prediction: str = "prediction", digits: int = 6) -> DataFrame:
    """Accuracy of train and test side by side in one pass (H7)."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg((F.col(label) == F.col(prediction)).cast("double")), digits).alias("accuracy"),
    )


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                          digits: int = 6) -> DataFrame:
    """Per-class precision, recall, F1 and support for a binary task."""
    c = confusion_counts(df, label, prediction)
    rows = []
    for cls, hit, wrong_pred, missed in ((0.0, "tn", "fn", "fp"), (1.0, "tp", "fp", "fn")):
        h, wp, m = F.col(hit), F.col(wrong_pred), F.col(missed)
        p = _div(h, h + wp)
        r = _div(h, h + m)
        rows.append(F.struct(F.lit(cls).alias("class"), p.alias("p"), r.alias("r"), (h + m).alias("support")))
    e = c.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
    return e.select(
        "class",
        F.round("p", digits).alias("precision"),
        F.round("r", digits).alias("recall"),
        F.round(_div(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), digits).alias("f1"),
        F.col("support").cast("bigint").alias("support"),
    )


def _score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct score with its positive and negative counts.

    Rows whose score is NULL or NaN, or whose label is NULL, have no place in a ranking and are left
    out together with their label, as if the table did not hold them.
    """
    s = F.col(score).cast("double")
    df = df.where(s.isNotNull() & ~F.isnan(s) & F.col(label).isNotNull())
    return df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) != 1).alias("neg"),
    )


def auc_exact(df: DataFrame, label: str = "label", score: str = "score", digits: int = 6) -> DataFrame:
    """Exact area under ROC (H8), ties counted one half: the Mann-Whitney rank formula.

    Rows are reduced to distinct scores first; the running count of negatives below each score
    comes from a range-partitioned prefix sum, never a single-partition window.
    """
    s = running_sums(_score_counts(df, label, score), "score", ["neg"])
    below = F.col("cum_neg") - F.col("neg")
    a = s.agg(
        F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))).alias("u"),
        F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return a.select(F.round(_div(F.col("u"), F.col("p") * F.col("n")), digits).alias("auc"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", digits: int = 6) -> DataFrame:
    """ROC points (H9): for each distinct score as threshold, TPR and FPR of ``score >= t``."""
    counts = _score_counts(df, label, score)
    tot = counts.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    s = running_sums(counts, "score", ["pos", "neg"], descending=True)
    return s.select(
        F.col("score").alias("threshold"),
        F.round(_div(F.col("cum_pos"), F.lit(tot["P"])), digits).alias("tpr"),
        F.round(_div(F.col("cum_neg"), F.lit(tot["N"])), digits).alias("fpr"),
    )


def auc_many(df: DataFrame, scores: list[str], label: str = "label", digits: int = 6,
             n_buckets: int | None = None) -> DataFrame:
    """Exact area under ROC of any number of score columns (H8, G12): ``(score, auc)``.

    Every column is cut into ranges by its own approximate quantiles (one aggregate over all columns),
    the rows are unpivoted to (column, range, score) in the scan and reduced to distinct scores, ranks
    are added up inside a range, and the negatives of lower ranges come from a table of one row per column
    and range. So all columns share one shuffle of distinct scores, and no column is ranked in one task.
    A missing score (NULL or NaN) leaves the row out of that column only; a column without both
    classes has no area (NULL).
    """
    n_buckets = n_buckets or default_buckets(df)
    names = [f"_s{i}" for i in range(len(scores))]
    value = lambda c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double"))
    wide = df.where(F.col(label).isNotNull()).select((F.col(label) == 1).alias("_pos"), *[
        value(c).alias(n) for c, n in zip(scores, names, strict=True)])
    probs = [i / n_buckets for i in range(1, n_buckets)]
    row = wide.agg(*[F.percentile_approx(n, probs, 10_000).alias(n) for n in names]).first()
    inner = [sorted({q for q in row[n] or [] if abs(q) != float("inf")}) or [0.0] for n in names]
    splits = [[float("-inf"), *x, float("inf")] for x in inner]
    cut = Bucketizer(splitsArray=splits, inputCols=names, outputCols=[f"{n}_b" for n in names], handleInvalid="keep").transform(wide)
    long = cut.select("_pos", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(n).alias("value"), F.col(f"{n}_b").alias("range"))
        for c, n in zip(scores, names, strict=True)])).alias("s")).select("_pos", "s.*").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "range", "value").agg(
        F.count_if("_pos").alias("pos"), F.count_if(~F.col("_pos")).alias("neg"))
    w = Window.partitionBy("column", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("below", F.sum("neg").over(w) - F.col("neg"))
    ranges = ranked.groupBy("column", "range").agg(
        F.sum(F.col("pos") * (F.col("below") + 0.5 * F.col("neg"))).alias("u"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    wr = Window.partitionBy("column").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # n_buckets rows
    total = (ranges.withColumn("lower", F.coalesce(F.sum("n").over(wr), F.lit(0))).groupBy("column")
             .agg(F.sum(F.col("u") + F.col("p") * F.col("lower")).alias("u"), F.sum("p").alias("p"), F.sum("n").alias("n")))
    every = df.sparkSession.createDataFrame([(c,) for c in scores], "score string")
    return every.join(total, F.col("score") == F.col("column"), "left").select(
        "score", F.round(_div(F.col("u"), F.col("p") * F.col("n")), digits).alias("auc"))


def roc_corners(df: DataFrame, label: str = "label", score: str = "score", digits: int = 6) -> DataFrame:
    """The corner points of the ROC curve (H9): ``(threshold, tpr, fpr)`` without the points that lie on
    the line between their neighbours, which a drawn curve doesn't need.

    A point stays if the step to it and the step after it differ in direction (the counts' cross product
    isn't zero), and the last one does. The step after the last score of a range is the first step of
    the next range that has scores, taken from the table of one row per range.
    """
    b = add_range_bucket(_score_counts(df, label, score), "score").withColumn(BUCKET, -F.col(BUCKET))
    step = F.struct(F.col("pos").cast("decimal(19,0)").alias("p"), F.col("neg").cast("decimal(19,0)").alias("n"))
    ranges = b.groupBy(F.col(BUCKET).alias("_range")).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"), F.max_by(step, "score").alias("_first"))
    wr = Window.orderBy("_range")  # one row a range
    before = wr.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_range", F.coalesce(F.sum("_p").over(before), F.lit(0)).alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"),
                           F.sum("_p").over(Window.partitionBy()).alias("_all_p"), F.sum("_n").over(Window.partitionBy()).alias("_all_n"),
                           F.lead("_first").over(wr).alias("_first"))
    w = Window.partitionBy(BUCKET).orderBy(F.col("score").desc())
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    at = b.join(F.broadcast(ranges), F.col(BUCKET) == F.col("_range")).select(
        "score", step.alias("here"), F.coalesce(F.lead(step).over(w), "_first").alias("next"), "_all_p", "_all_n",
        (F.sum("pos").over(upto) + F.col("_p")).alias("pos"), (F.sum("neg").over(upto) + F.col("_n")).alias("neg"))
    corner = F.col("next").isNull() | (F.col("here.p") * F.col("next.n") != F.col("next.p") * F.col("here.n"))
    return at.where(corner).select(F.col("score").alias("threshold"), F.round(_div(F.col("pos"), F.col("_all_p")), digits).alias("tpr"),
                                   F.round(_div(F.col("neg"), F.col("_all_n")), digits).alias("fpr"))


def rmse(df: DataFrame, label: str, prediction: str, digits: int = 6) -> DataFrame:
    """Root mean square error."""
    return df.agg(F.round(F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2))), digits).alias("rmse"))


def threshold_curve(df: DataFrame, label: str = "label", score: str = "score", steps: int = 50,
                    digits: int = 6) -> DataFrame:
    """Precision / recall / F1 for ``steps`` thresholds spread over the score range, best marked.

    Threshold ``i`` is ``min + i * (max - min) / steps``; a row is predicted positive at
    threshold ``i`` when its step index ``floor((s - min) * steps / (max - min))`` is ``>= i``.
    Only ``steps x 2`` counts are shuffled, then a running sum over those ``steps`` rows
    (C23, H13). Ties for the best F1 go to the smallest step.
    """
    rng = df.agg(F.min(score).alias("lo"), F.max(score).alias("hi")).first()
    lo, hi = rng["lo"], rng["hi"]
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "step bigint, threshold double, precision double, "
                                         "recall double, f1 double, is_best boolean")
    width = hi - lo
    k = (F.least(F.floor((F.col(score) - F.lit(lo)) * steps / F.lit(width)), F.lit(steps - 1))
         if width > 0 else F.lit(0)).cast("bigint")
    binned = df.groupBy(k.alias("step")).agg(F.count_if(F.col(label) == 1).alias("pos"),
                                              F.count_if(F.col(label) != 1).alias("neg"))
    grid = spark.range(0, steps).withColumnRenamed("id", "step")
    # ``steps`` rows: a window without partition is bounded here.
    w = Window.orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, 0)
    c = (grid.join(F.broadcast(binned), "step", "left").na.fill(0, ["pos", "neg"])
         .select("step", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"),
                 F.sum("pos").over(Window.partitionBy()).alias("P")))
    prec = _div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _div(F.col("tp"), F.col("P"))
    c = c.select("step", F.round(F.lit(lo) + F.col("step") * F.lit(width) / steps, digits).alias("threshold"),
                 prec.alias("p"), rec.alias("r"))
    c = c.withColumn("f1", F.coalesce(_div(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0)))
    wb = Window.partitionBy()
    best = F.min(F.struct(-F.col("f1"), F.col("step"))).over(wb)["step"]
    return c.select(
        "step", "threshold",
        F.round("p", digits).alias("precision"), F.round("r", digits).alias("recall"),
        F.round("f1", digits).alias("f1"),
        (F.col("step") == best).alias("is_best"))
