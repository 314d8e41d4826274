"""Registered metric queries over the rule-scored contacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from prospect.functions.hashing import hash_unit
from prospect.operators import metrics as M
from prospect.plans.oracle import md5_unit, with_ctes
from prospect.plans.registry import register
from prospect.sources.contacts import contacts, ratings, rule_scored
from prospect.sources.tables import Tables


def scored(spark, d):
    return rule_scored(contacts(Tables(spark, d)))


@register("binary_metrics", with_ctes("""
SELECT round(try_divide_acc, 4) AS accuracy, round(prec, 4) AS precision, round(rec, 4) AS recall FROM (
  SELECT (tp + tn) / nullif(tp + tn + fp + fn, 0) AS try_divide_acc,
         tp / nullif(tp + fp, 0) AS prec, tp / nullif(tp + fn, 0) AS rec
  FROM (SELECT
      sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END)::DOUBLE AS tn,
      sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END)::DOUBLE AS tp,
      sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END)::DOUBLE AS fn,
      sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END)::DOUBLE AS fp
    FROM scored))
"""))
def q_binary_metrics(spark, d):
    return M.binary_metrics(scored(spark, d))


@register("confusion_counts", with_ctes("""
SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
       count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
       count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
       count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp
FROM scored
"""))
def q_confusion_counts(spark, d):
    return M.confusion_counts(scored(spark, d))


@register("confusion_matrix", with_ctes("""
SELECT label, prediction, count(*) AS n FROM scored GROUP BY label, prediction
"""))
def q_confusion_matrix(spark, d):
    return M.confusion_matrix(scored(spark, d))


@register("confusion_matrix_norm", with_ctes("""
SELECT label, prediction, n, round(n / sum(n) OVER (PARTITION BY label), 6) AS share
FROM (SELECT label, prediction, count(*) AS n FROM scored GROUP BY label, prediction)
"""))
def q_confusion_matrix_norm(spark, d):
    return M.confusion_matrix(scored(spark, d), normalise=True)


@register("classification_report", with_ctes("""
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall,
       round(2 * p * r / nullif(p + r, 0), 6) AS f1, support
FROM (
  SELECT 0.0::DOUBLE AS class, tn / nullif(tn + fn, 0) AS p, tn / nullif(tn + fp, 0) AS r,
         CAST(tn + fp AS BIGINT) AS support FROM cc
  UNION ALL
  SELECT 1.0::DOUBLE, tp / nullif(tp + fp, 0), tp / nullif(tp + fn, 0), CAST(tp + fn AS BIGINT) FROM cc)
""", extra="""
cc AS (SELECT
  count(*) FILTER (WHERE label = 0 AND prediction = 0)::DOUBLE AS tn,
  count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE AS tp,
  count(*) FILTER (WHERE label = 1 AND prediction = 0)::DOUBLE AS fn,
  count(*) FILTER (WHERE label = 0 AND prediction = 1)::DOUBLE AS fp
  FROM scored)
"""))
def q_classification_report(spark, d):
    return M.classification_report(scored(spark, d))


@register("accuracy_by_split", with_ctes(f"""
SELECT CASE WHEN {md5_unit('contact_id', 420)} < 0.8 THEN 'train' ELSE 'test' END AS split,
       count(*) AS n, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM scored GROUP BY 1
"""))
def q_accuracy_by_split(spark, d):
    s = scored(spark, d).withColumn(
        "split", F.when(hash_unit("contact_id", 420) < 0.8, "train").otherwise("test"))
    return M.accuracy_by_split(s)


@register("auc_exact", with_ctes("""
SELECT round(sum(pos * (cum_neg - neg + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc
FROM (SELECT score, pos, neg,
             sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
      FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
            FROM scored GROUP BY score))
"""))
def q_auc_exact(spark, d):
    return M.auc_exact(scored(spark, d))


@register("roc_curve", with_ctes("""
SELECT score AS threshold,
       round(sum(pos) OVER w / sum(pos) OVER (), 6) AS tpr,
       round(sum(neg) OVER w / sum(neg) OVER (), 6) AS fpr
FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
      FROM scored GROUP BY score)
WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""))
def q_roc_curve(spark, d):
    return M.roc_curve(scored(spark, d))


@register("roc_corners", with_ctes("""
SELECT threshold, tpr, fpr FROM (
  SELECT score AS threshold, round(sum(pos) OVER w / sum(pos) OVER (), 6) AS tpr, round(sum(neg) OVER w / sum(neg) OVER (), 6) AS fpr,
         pos, neg, lead(pos) OVER (ORDER BY score DESC) AS next_pos, lead(neg) OVER (ORDER BY score DESC) AS next_neg
  FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg FROM scored GROUP BY score)
  WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
WHERE next_pos IS NULL OR pos * next_neg <> next_pos * neg
"""))
def q_roc_corners(spark, d):
    """H9: the drawn curve, without the points between its corners."""
    return M.roc_corners(scored(spark, d))


AUC_SCORES = ["nr_employed", "pdays", "duration", "emp_var_rate", "cons_conf_idx", "previous"]


@register("auc_many", with_ctes("SELECT score, round(sum(pos * (cum_neg - neg + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc FROM ("
                                "SELECT *, sum(neg) OVER (PARTITION BY score ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM ("
                                "SELECT score, value, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg FROM ("
                                + " UNION ALL ".join(f"SELECT CASE WHEN y = 'yes' THEN 1 ELSE 0 END AS label, '{c}' AS score, CAST({c} AS DOUBLE) AS value FROM contacts"
                                                     for c in AUC_SCORES)
                                + ") WHERE value IS NOT NULL GROUP BY score, value)) GROUP BY score"))
def q_auc_many(spark, d):
    """The areas of several score columns (some with missing values and heavy ties) in one pass."""
    return M.auc_many(contacts(Tables(spark, d)).withColumn("label", F.when(F.col("y") == "yes", 1.0).otherwise(0.0)), AUC_SCORES)


@register("best_param", with_ctes("""
SELECT step, threshold, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1,
       step = min(step) FILTER (WHERE f1 = mf) OVER () AS is_best
FROM (
  SELECT *, max(f1) OVER () AS mf FROM (
    SELECT step, threshold, p, r, coalesce(2 * p * r / nullif(p + r, 0), 0.0) AS f1 FROM (
      SELECT g.step, round(lo + g.step * (hi - lo) / 50, 6) AS threshold,
             tp / nullif(tp + fp, 0) AS p, tp / nullif(P, 0) AS r
      FROM (
        SELECT g.step, lo, hi,
          sum(coalesce(bn.pos, 0)) OVER (ORDER BY g.step DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE AS tp,
          sum(coalesce(bn.neg, 0)) OVER (ORDER BY g.step DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE AS fp,
          sum(coalesce(bn.pos, 0)) OVER ()::DOUBLE AS P
        FROM (SELECT range AS step FROM range(0, 50)) g
        CROSS JOIN rng
        LEFT JOIN bn ON bn.step = g.step) g)))
""", extra="""
rng AS (SELECT min(score) AS lo, max(score) AS hi FROM scored),
bn AS (
  SELECT CASE WHEN hi > lo THEN least(floor((score - lo) * 50 / (hi - lo)), 49) ELSE 0 END::BIGINT AS step,
         count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
  FROM scored, rng GROUP BY 1)
"""))
def q_best_param(spark, d):
    return M.threshold_curve(scored(spark, d), steps=50)


@register("rmse", with_ctes("""
SELECT round(sqrt(avg(pow(rating - item_mean, 2))), 6) AS rmse
FROM (SELECT rating, avg(rating) OVER (PARTITION BY itemId) AS item_mean FROM ratings)
"""))
def q_rmse(spark, d):
    r = ratings(Tables(spark, d))
    means = r.groupBy("itemId").agg(F.avg("rating").alias("item_mean"))
    return M.rmse(r.join(means, "itemId"), "rating", "item_mean")
