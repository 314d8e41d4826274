"""Registered descriptive-statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from prospect.functions.hashing import hash_unit
from prospect.operators import prep as P
from prospect.operators import stats as S
from prospect.plans.oracle import md5_unit, with_ctes
from prospect.plans.registry import register
from prospect.sources.contacts import contacts, rule_scored
from prospect.sources.tables import Tables
from prospect.spec import CONTACTS, MONTHS, WEEKDAYS

NUMERICS = ["duration", "campaign", "pdays", "previous", "emp_var_rate", "cons_conf_idx", "euribor3m",
            "nr_employed"]
CATEGORICALS = list(CONTACTS.categorical) + ["y"]
PLAIN_CATS = list(CONTACTS.plain_categorical)
WITH_NULLS = ["job", "marital", "poutcome", "duration", "euribor3m"]
KDE_COLS = NUMERICS
PAIR_COLS = NUMERICS
SQRT_2PI = 2.5066282746310002


def cts(spark, d):
    return contacts(Tables(spark, d))


def with_target(spark, d):
    return cts(spark, d).withColumn("y_numeric", P.map_values("y", {"no": 0, "yes": 1}))


def sql_long(cols, cast, keep=(), src="contacts", where=""):
    k = "".join(f"{c}, " for c in keep)
    w = f" WHERE {where}" if where else ""
    return "\nUNION ALL ".join(f"SELECT {k}'{c}' AS feature, CAST({c} AS {cast}) AS value FROM {src}{w}"
                               for c in cols)


Y_NUM = "contacts_t AS (SELECT *, CASE WHEN y = 'no' THEN 0 WHEN y = 'yes' THEN 1 END AS y_numeric FROM contacts)"


@register("global_avg", with_ctes("SELECT round(avg(duration), 6) AS avg_duration FROM contacts"))
def q_global_avg(spark, d):
    return S.global_avg(cts(spark, d), "duration")


@register("table_shape", with_ctes("SELECT count(*) AS n_rows, CAST(17 AS BIGINT) AS n_cols FROM contacts"))
def q_table_shape(spark, d):
    c = cts(spark, d)
    return c.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(c.columns)).cast("bigint").alias("n_cols"))


@register("split_counts", with_ctes(f"""
SELECT CASE WHEN {md5_unit('contact_id', 420)} < 0.8 THEN 'train' ELSE 'test' END AS split, count(*) AS n
FROM contacts GROUP BY 1
"""))
def q_split_counts(spark, d):
    from prospect.operators.sampling import hash_split
    return hash_split(cts(spark, d), "contact_id", {"train": 0.8, "test": 0.2}, seed=420) \
        .groupBy("split").agg(F.count(F.lit(1)).alias("n"))


_ALL_COLS = ["contact_id", "job", "marital", "education", "nation", "month", "day_of_week", "poutcome",
             "duration", "campaign", "pdays", "previous", "emp_var_rate", "cons_conf_idx", "euribor3m",
             "nr_employed", "y"]


@register("null_counts", with_ctes("\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM contacts" for c in _ALL_COLS)))
def q_null_counts(spark, d):
    return S.null_counts(cts(spark, d))


@register("cardinality", with_ctes(f"""
SELECT feature, count(DISTINCT value) AS cardinality FROM ({sql_long(CATEGORICALS, 'VARCHAR')}) GROUP BY feature
"""))
def q_cardinality(spark, d):
    return S.cardinality(cts(spark, d), CATEGORICALS)


@register("cardinality_with_null", with_ctes(f"""
SELECT feature, count(DISTINCT value) + max(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS cardinality
FROM ({sql_long(WITH_NULLS, 'VARCHAR')}) GROUP BY feature
"""))
def q_cardinality_with_null(spark, d):
    return S.cardinality(cts(spark, d), WITH_NULLS, count_null=True)


@register("class_counts", with_ctes("SELECT y, count(*) AS n FROM contacts GROUP BY y"))
def q_class_counts(spark, d):
    return S.group_counts(cts(spark, d), "y")


@register("class_shares", with_ctes(
    "SELECT y, n, round(n / sum(n) OVER (), 6) AS share FROM (SELECT y, count(*) AS n FROM contacts GROUP BY y)"))
def q_class_shares(spark, d):
    return S.class_shares(cts(spark, d), "y")


@register("target_rate", with_ctes("""
SELECT round((1 - m) * 100, 6) AS no_pct, round(m * 100, 6) AS yes_pct FROM (SELECT avg(y_numeric) AS m FROM contacts_t)
""", extra=Y_NUM))
def q_target_rate(spark, d):
    return S.target_rate(with_target(spark, d), "y_numeric")


@register("cat_prevalence", with_ctes("""
SELECT job AS category, count(*) AS n, round(avg(y_numeric) * 100, 6) AS yes_pct,
       round(count(*) / sum(count(*)) OVER () * 100, 6) AS freq_pct
FROM contacts_t GROUP BY job
""", extra=Y_NUM))
def q_cat_prevalence(spark, d):
    return S.cat_prevalence(with_target(spark, d), "job", "y_numeric")


@register("cats_prevalence", with_ctes(f"""
SELECT feature, category, n, round(s / n * 100, 6) AS yes_pct,
       round(n / sum(n) OVER (PARTITION BY feature) * 100, 6) AS freq_pct,
       round((s / n) / (sum(s) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature)), 6) AS lift
FROM (SELECT feature, value AS category, sum(y_numeric) AS s, count(*) AS n
      FROM ({sql_long(PLAIN_CATS, 'VARCHAR', keep=['y_numeric'], src='contacts_t')}) GROUP BY feature, value)
""", extra=Y_NUM))
def q_cats_prevalence(spark, d):
    return S.cats_prevalence(with_target(spark, d), PLAIN_CATS, "y_numeric")


@register("conditional_rate", with_ctes("""
SELECT round(avg(y_numeric), 6) AS rate, count(*) AS n FROM contacts_t WHERE poutcome = 'success'
""", extra=Y_NUM))
def q_conditional_rate(spark, d):
    return S.conditional_rate(with_target(spark, d), "poutcome", "success", "y_numeric")


_MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in MONTHS) + "]"
_DAYS_SQL = "[" + ", ".join(f"'{x}'" for x in WEEKDAYS) + "]"


@register("temporal_profile", with_ctes(f"""
SELECT month, day_of_week, CAST(list_position({_MONTHS_SQL}, month) AS INTEGER) AS month_no,
       CAST(list_position({_DAYS_SQL}, day_of_week) AS INTEGER) AS dow_no,
       count(*) AS n, round(avg(y_numeric) * 100, 6) AS yes_pct
FROM contacts_t GROUP BY month, day_of_week
""", extra=Y_NUM))
def q_temporal_profile(spark, d):
    return S.temporal_profile(with_target(spark, d), "y_numeric")


def _hist_sql(cols, src, bins, by=None):
    keep = [by] if by else []
    k = f"{by}, " if by else ""
    rng = "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM {src}"
        for c in cols)
    long = sql_long(cols, "DOUBLE", keep=keep, src=src)
    classes = f", (SELECT DISTINCT {by} FROM {src}) cls" if by else ""
    on_by = f" AND cn.{by} = g.{by}" if by else ""
    return f"""
WITH_RNG AS ({rng}),
binned AS (
  SELECT l.feature, {''.join(f'l.{x}, ' for x in keep)}
    CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor((l.value - r.lo) * {bins} / (r.hi - r.lo)), {bins - 1}) END
         AS BIGINT) AS bin
  FROM ({long}) l JOIN WITH_RNG r ON l.feature = r.feature WHERE l.value IS NOT NULL),
cn AS (SELECT feature, {k}bin, count(*) AS n FROM binned GROUP BY ALL),
g AS (SELECT r.feature, r.lo, r.hi, {''.join(f'cls.{x}, ' for x in keep)}CAST(b.range AS BIGINT) AS bin
      FROM WITH_RNG r, range(0, {bins}) b{classes} WHERE r.lo IS NOT NULL)
""", f"""
SELECT g.feature, {''.join(f'g.{x}, ' for x in keep)}g.bin,
  round(g.lo + g.bin * ((g.hi - g.lo) / {bins}), 6) AS lo,
  round(g.lo + (g.bin + 1) * ((g.hi - g.lo) / {bins}), 6) AS hi,
  CAST(coalesce(cn.n, 0) AS BIGINT) AS n
FROM g LEFT JOIN cn ON cn.feature = g.feature AND cn.bin = g.bin{on_by}
"""


_h_ctes, _h_sel = _hist_sql(NUMERICS, "contacts", 30)


@register("histogram30", with_ctes(_h_sel, extra=_h_ctes))
def q_histogram30(spark, d):
    return S.histogram(cts(spark, d), NUMERICS, bins=30)


_sh_ctes, _sh_sel = _hist_sql(["score"], "scored", 30, by="label")


@register("score_histogram", with_ctes(_sh_sel, extra=_sh_ctes))
def q_score_histogram(spark, d):
    return S.histogram(rule_scored(cts(spark, d)), ["score"], bins=30, by="label")


@register("kde_by_class", with_ctes(f"""
SELECT feature, y, gi, round(lo + gi * (hi - lo) / 99, 6) AS x,
       round(s / (n_c * h * {SQRT_2PI}) * (hi - lo), 6) AS density_x_span
FROM (
  SELECT dv.feature, dv.y, CAST(g.range AS BIGINT) AS gi, st.n_c, st.h, st.lo, st.hi,
         sum(dv.cnt * exp(-0.5 * ((st.lo + g.range * (st.hi - st.lo) / 99 - dv.value) / st.h)
                                * ((st.lo + g.range * (st.hi - st.lo) / 99 - dv.value) / st.h))) AS s
  FROM dv JOIN st ON dv.feature = st.feature AND dv.y = st.y, range(0, 100) g
  WHERE st.h > 0
  GROUP BY ALL)
""", extra=f"""
kl AS (SELECT * FROM ({sql_long(KDE_COLS, 'DOUBLE', keep=['y'])}) WHERE value IS NOT NULL),
st AS (SELECT s.feature, s.y, s.n_c, s.sd * pow(s.n_c, -0.2) AS h, r.lo, r.hi
       FROM (SELECT feature, y, count(*) AS n_c, stddev_samp(value) AS sd FROM kl GROUP BY feature, y) s
       JOIN (SELECT feature, min(value) AS lo, max(value) AS hi FROM kl GROUP BY feature) r ON s.feature = r.feature),
dv AS (SELECT feature, y, value, count(*) AS cnt FROM kl GROUP BY feature, y, value)
"""))
def q_kde_by_class(spark, d):
    return S.kde_by_class(cts(spark, d), KDE_COLS, "y", points=100)


def _pair_sql():
    samp = f"{md5_unit('contact_id', 7)} < 0.2"
    rng = ", ".join(f"min({c})::DOUBLE AS lo_{c}, max({c})::DOUBLE AS hi_{c}" for c in PAIR_COLS)

    def b(c):
        return (f"CAST(CASE WHEN hi_{c} = lo_{c} THEN 0 ELSE least(floor(({c} - lo_{c}) * 10 / (hi_{c} - lo_{c})), 9)"
                f" END AS BIGINT)")
    pairs = [(a, c) for i, a in enumerate(PAIR_COLS) for c in PAIR_COLS[i + 1:]]
    sel = "\nUNION ALL ".join(
        f"SELECT '{a}' AS f1, '{c}' AS f2, {b(a)} AS b1, {b(c)} AS b2, y FROM sm, pr "
        f"WHERE {a} IS NOT NULL AND {c} IS NOT NULL" for a, c in pairs)
    extra = f"sm AS (SELECT * FROM contacts WHERE {samp}), pr AS (SELECT {rng} FROM sm)"
    return with_ctes(f"SELECT f1, f2, b1, b2, y, count(*) AS n FROM ({sel}) GROUP BY ALL", extra=extra)


@register("pair_bins", _pair_sql())
def q_pair_bins(spark, d):
    return S.pair_bins(cts(spark, d), PAIR_COLS, "y", hash_unit("contact_id", 7) < 0.2, bins=10)


def _pearson_sql():
    pairs = [(a, c) for i, a in enumerate(NUMERICS) for c in NUMERICS[i + 1:]]
    return with_ctes("\nUNION ALL ".join(
        f"SELECT '{a}' AS f1, '{c}' AS f2, round(corr(CAST({a} AS DOUBLE), CAST({c} AS DOUBLE)), 6) AS r "
        f"FROM contacts" for a, c in pairs))


@register("pearson_matrix", _pearson_sql())
def q_pearson_matrix(spark, d):
    return S.pearson_matrix(cts(spark, d), NUMERICS)


@register("profile_numeric", with_ctes(f"""
SELECT feature, count(value) AS n, count(*) FILTER (WHERE value IS NULL) AS n_null,
  count(DISTINCT value) AS n_distinct, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75,
  round(max(value), 6) AS max, count(*) FILTER (WHERE value = 0) AS n_zero
FROM ({sql_long(NUMERICS, 'DOUBLE')}) GROUP BY feature
"""))
def q_profile_numeric(spark, d):
    return S.profile_numeric(cts(spark, d), NUMERICS)


@register("profile_categorical", with_ctes(f"""
SELECT t.feature, t.n, t.n_null, t.n_distinct, v.value AS top, v.c AS top_freq
FROM (SELECT feature, count(value) AS n, count(*) FILTER (WHERE value IS NULL) AS n_null,
             count(DISTINCT value) AS n_distinct FROM lc GROUP BY feature) t
LEFT JOIN (SELECT feature, value, c, row_number() OVER (PARTITION BY feature ORDER BY c DESC, value) AS rk
           FROM (SELECT feature, value, count(*) AS c FROM lc WHERE value IS NOT NULL GROUP BY ALL)) v
  ON v.feature = t.feature AND v.rk = 1
""", extra=f"lc AS ({sql_long(CATEGORICALS, 'VARCHAR')})"))
def q_profile_categorical(spark, d):
    return S.profile_categorical(cts(spark, d), CATEGORICALS)


_NO_ID = [c for c in _ALL_COLS if c != "contact_id"]


@register("duplicate_rows", with_ctes(f"""
SELECT CAST(coalesce(sum(k - 1), 0) AS BIGINT) AS n_duplicates, count(*) AS n_distinct_rows
FROM (SELECT count(*) AS k FROM contacts GROUP BY {', '.join(_NO_ID)})
"""))
def q_duplicate_rows(spark, d):
    return S.duplicate_rows(cts(spark, d), _NO_ID)


DAILY = ["o_totalprice", "o_custkey", "o_orderstatus", "o_orderpriority"]
DAILY_NUMERIC = DAILY[:2]
MONTHS_OF = ("1996-01-01", "1998-06-01")


def _daily_sql():
    rows = "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, {f'CAST({c} AS DOUBLE)' if c in DAILY_NUMERIC else 'CAST(NULL AS DOUBLE)'} AS number "
        f"FROM orders WHERE date_trunc('month', o_orderdate) BETWEEN '{MONTHS_OF[0]}' AND '{MONTHS_OF[1]}'" for c in DAILY)
    return f"""
SELECT feature, count(value) AS n, count(*) - count(value) AS n_null, round(avg(number), 4) AS mean, round(stddev_samp(number), 4) AS std,
       min(number) AS min, max(number) AS max, true AS distinct_near, CASE WHEN count(number) > 0 THEN true END AS median_near
FROM ({rows}) GROUP BY feature
"""


@register("daily_union", _daily_sql())
def q_daily_union(spark, d):
    """Stored daily sketches (here of months) united over a range; counts, mean and extremes are exact, the
    distinct counts lie within 5 % and the medians' ranks within 1 % of the rows that a full pass finds."""
    from prospect.operators import daily as D
    from prospect.session import scratch_path
    orders = Tables(spark, d).orders.withColumn("month", F.date_trunc("month", "o_orderdate"))
    base = scratch_path(spark, "daily-profiles")
    D.store_days(D.daily_profile(orders, "month", DAILY), base)
    got = D.united(D.stored_days(spark, base, *MONTHS_OF))
    inside = orders.where(F.col("month").cast("date").cast("string").between(*MONTHS_OF))
    exact = S.cardinality(inside, DAILY).withColumnRenamed("feature", "f")
    medians = got.select(F.col("feature").alias("f"), "p50")
    ranks = (inside.select(*[F.col(c).cast("double").alias(c) for c in DAILY_NUMERIC]).unpivot([], DAILY_NUMERIC, "f", "value").join(medians, "f")
             .groupBy("f").agg((F.count_if(F.col("value") < F.col("p50")) / F.count("value")).alias("below"),
                               (F.count_if(F.col("value") <= F.col("p50")) / F.count("value")).alias("upto")))
    j = got.join(exact, F.col("feature") == exact["f"]).drop("f").join(ranks, F.col("feature") == F.col("f"), "left")
    return j.select("feature", "n", "n_null", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min", "max",
                    (F.abs(F.col("n_distinct") - F.col("cardinality")) <= 0.05 * F.col("cardinality") + 1).alias("distinct_near"),
                    ((F.col("below") <= 0.5 + D.RANK_ERROR) & (F.col("upto") >= 0.5 - D.RANK_ERROR)).alias("median_near"))


@register("cardinality_approx", with_ctes("SELECT feature, n AS exact, true AS near FROM (SELECT feature, count(DISTINCT value) AS n FROM ("
                                          + sql_long(CATEGORICALS + NUMERICS, "VARCHAR") + ") GROUP BY feature)"))
def q_cardinality_approx(spark, d):
    """C4: the approximate count of distinct values beside the exact one, within 10 %."""
    c = cts(spark, d)
    cols = CATEGORICALS + NUMERICS
    exact = S.cardinality(c, cols).withColumnRenamed("cardinality", "exact")
    near = S.cardinality(c, cols, approx=True).withColumnRenamed("cardinality", "approx")
    return exact.join(near, "feature").select("feature", "exact", (F.abs(F.col("approx") - F.col("exact")) <= 0.1 * F.col("exact") + 1).alias("near"))
