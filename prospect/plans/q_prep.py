"""Registered projection / cast / missing-data queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from prospect.operators import prep as P
from prospect.plans.oracle import with_ctes
from prospect.plans.registry import register
from prospect.plans.q_stats import NUMERICS, Y_NUM, cts, with_target
from prospect.sources.contacts import dotted

IMPUTE = ["duration", "euribor3m", "emp_var_rate"]
UNKNOWN_COLS = ["job", "marital", "poutcome"]
UNKNOWN = "nonexistent"


@register("sanitize_columns", with_ctes("SELECT * FROM contacts"))
def q_sanitize_columns(spark, d):
    return P.sanitize_columns(dotted(cts(spark, d)))


@register("drop_leaky", with_ctes("SELECT * EXCLUDE (duration) FROM contacts"))
def q_drop_leaky(spark, d):
    return P.drop_columns(cts(spark, d), ["duration"])


@register("label_map", with_ctes("SELECT contact_id, y, y_numeric FROM contacts_t", extra=Y_NUM))
def q_label_map(spark, d):
    return with_target(spark, d).select("contact_id", "y", "y_numeric")


_CATS = ["job", "marital", "education", "nation", "month", "day_of_week", "poutcome", "y"]
_NUMS = ["contact_id", "duration", "campaign", "pdays", "previous", "emp_var_rate", "cons_conf_idx",
         "euribor3m", "nr_employed"]


@register("categorical_fields", with_ctes(f"SELECT {', '.join(_CATS)}, y_numeric FROM contacts_t", extra=Y_NUM))
def q_categorical_fields(spark, d):
    return P.select_by_kind(with_target(spark, d), "categorical", "y_numeric")


@register("numeric_fields", with_ctes(f"SELECT {', '.join(_NUMS)} FROM contacts"))
def q_numeric_fields(spark, d):
    return P.select_by_kind(cts(spark, d), "numeric")


@register("sentinel_to_null", with_ctes("SELECT contact_id, nullif(pdays, 999) AS pdays FROM contacts"))
def q_sentinel_to_null(spark, d):
    return cts(spark, d).select("contact_id", P.sentinel_to_null("pdays", 999).alias("pdays"))


@register("unknown_drop", with_ctes(f"""
SELECT contact_id, {', '.join(UNKNOWN_COLS)} FROM contacts
WHERE {' AND '.join(f"coalesce({c} <> '{UNKNOWN}', true)" for c in UNKNOWN_COLS)}
"""))
def q_unknown_drop(spark, d):
    return P.unknown_policy(cts(spark, d), UNKNOWN_COLS, UNKNOWN, "drop").select("contact_id", *UNKNOWN_COLS)


def _mode_sql(c):
    return (f"(SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM contacts WHERE {c} IS NOT NULL AND {c} <> "
            f"'{UNKNOWN}' GROUP BY {c}) ORDER BY n DESC, v LIMIT 1)")


@register("unknown_mode", with_ctes(f"""
SELECT contact_id, {', '.join(f"CASE WHEN {c} = '{UNKNOWN}' THEN {_mode_sql(c)} ELSE {c} END AS {c}"
                              for c in UNKNOWN_COLS)}
FROM contacts
"""))
def q_unknown_mode(spark, d):
    return P.unknown_policy(cts(spark, d), UNKNOWN_COLS, UNKNOWN, "mode").select("contact_id", *UNKNOWN_COLS)


@register("impute_mean", with_ctes(f"""
SELECT contact_id, {', '.join(f"round(coalesce({c}, avg({c}) OVER ()), 6) AS {c}" for c in IMPUTE)}
FROM contacts
"""))
def q_impute_mean(spark, d):
    c = cts(spark, d)
    m = P.fit_imputer(c, IMPUTE, "mean")
    return m.transform(c).select("contact_id", *[F.round(x, 6).alias(x) for x in IMPUTE])


_LS = 11


@register("linspace_grid", with_ctes(f"""
SELECT feature, CAST(g.range AS INTEGER) AS i, round(lo + g.range * (hi - lo) / {_LS - 1}, 6) AS x
FROM ({' UNION ALL '.join(f"SELECT '{c}' AS feature, CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM contacts" for c in NUMERICS)}) r,
     range(0, {_LS}) g
"""))
def q_linspace_grid(spark, d):
    c = cts(spark, d)
    r = c.agg(*[F.struct(F.lit(x).alias("feature"), F.min(x).cast("double").alias("lo"),
                         F.max(x).cast("double").alias("hi")) for x in NUMERICS])
    long = r.select(F.explode(F.array(*[F.col(f"`{n}`") for n in r.columns])).alias("s")).select("s.*")
    g = long.select("feature", F.posexplode(P.linspace(F.col("lo"), F.col("hi"), _LS)).alias("i", "x"))
    return g.select("feature", "i", F.round("x", 6).alias("x"))
