"""Descriptive statistics and target profiles.

Multi-column statistics are one pass: the table is unpivoted to ``(feature, value)`` rows inside
the scan stage (``Expand``), partially aggregated, and shuffled once as small partial states.
Grouped outputs are bounded by (#features x #categories) or (#features x #bins), so the windows
that compute shares run on those small tables only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prospect.session import stored
from prospect.spec import MONTHS, WEEKDAYS


def _long(df: DataFrame, cols: list[str], cast: str, keep: list[str] = ()) -> DataFrame:
    wide = df.select(*keep, *[F.col(c).cast(cast).alias(c) for c in cols])
    return wide.unpivot(list(keep), list(cols), "feature", "value")


def global_avg(df: DataFrame, col: str, digits: int = 6) -> DataFrame:
    """Average of one column."""
    return df.agg(F.round(F.avg(col), digits).alias(f"avg_{col}"))


def null_counts(df: DataFrame) -> DataFrame:
    """NULL count of every column in one pass (C3): ``(column, n_null)``."""
    one = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column", "n_null")


def cardinality(df: DataFrame, cols: list[str], count_null: bool = False, approx: bool = False) -> DataFrame:
    """Distinct values per column (C4); ``count_null`` counts a missing value as one more.

    Exact: distinct (feature, value) pairs are found by one partially-aggregated shuffle, then
    counted per feature. ``approx`` uses HyperLogLog++ instead (bounded state per feature).
    """
    long = _long(df, cols, "string")
    if approx:
        out = long.groupBy("feature").agg(
            F.approx_count_distinct("value").alias("n"), F.max(F.col("value").isNull()).alias("has_null"))
    else:
        pairs = long.groupBy("feature", "value").agg(F.lit(1).alias("one"))
        out = pairs.groupBy("feature").agg(
            F.count("value").alias("n"), F.max(F.col("value").isNull()).alias("has_null"))
    extra = F.when(F.lit(count_null) & F.col("has_null"), 1).otherwise(0)
    return out.select("feature", (F.col("n") + extra).cast("bigint").alias("cardinality"))


def group_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def class_shares(df: DataFrame, col: str, digits: int = 6) -> DataFrame:
    """Rows and share per value (C7); the total is a window over the grouped rows, not a second scan."""
    g = group_counts(df, col)
    return g.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), digits))


def target_rate(df: DataFrame, target: str, digits: int = 6) -> DataFrame:
    """``no_pct, yes_pct`` of a 0/1 target."""
    m = df.agg(F.avg(target).alias("m"))
    return m.select(F.round((1 - F.col("m")) * 100, digits).alias("no_pct"),
                    F.round(F.col("m") * 100, digits).alias("yes_pct"))


def cat_prevalence(df: DataFrame, col: str, target: str, digits: int = 6) -> DataFrame:
    """Per category: target mean % and row share % (C9), for plotting in ascending share."""
    g = df.groupBy(F.col(col).alias("category")).agg(
        F.avg(target).alias("m"), F.count(F.lit(1)).alias("n"))
    return g.select(
        "category", "n",
        F.round(F.col("m") * 100, digits).alias("yes_pct"),
        F.round(F.col("n") / F.sum("n").over(Window.partitionBy()) * 100, digits).alias("freq_pct"))


def cats_prevalence(df: DataFrame, cols: list[str], target: str, digits: int = 6) -> DataFrame:
    """C9 for many categoricals in one pass (C10) with the overall rate and lift (C11).

    ``(feature, category, n, yes_pct, freq_pct, lift)``. The unpivot happens inside the scan
    stage and is partially aggregated before the one shuffle; windows run on the grouped rows.
    """
    long = _long(df, cols, "string", keep=[target])
    g = long.groupBy("feature", F.col("value").alias("category")).agg(
        F.sum(target).alias("s"), F.count(F.lit(1)).alias("n"))
    per_f = Window.partitionBy("feature")
    total_n = F.sum("n").over(per_f)
    overall = F.sum("s").over(per_f) / total_n
    rate = F.col("s") / F.col("n")
    return g.select(
        "feature", "category", "n",
        F.round(rate * 100, digits).alias("yes_pct"),
        F.round(F.col("n") / total_n * 100, digits).alias("freq_pct"),
        F.round(rate / overall, digits).alias("lift"))


def conditional_rate(df: DataFrame, col: str, value, target: str, digits: int = 6) -> DataFrame:
    """Target mean where ``col = value``."""
    return df.where(F.col(col) == value).agg(F.round(F.avg(target), digits).alias("rate"),
                                               F.count(F.lit(1)).alias("n"))


def temporal_profile(df: DataFrame, target: str, month: str = "month", dow: str = "day_of_week",
                     digits: int = 6) -> DataFrame:
    """Month x weekday grid with calendar positions, rows and target rate."""
    g = df.groupBy(month, dow).agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("m"))
    months = F.array(*[F.lit(m) for m in MONTHS])
    days = F.array(*[F.lit(d) for d in WEEKDAYS])
    return g.select(
        F.col(month).alias("month"), F.col(dow).alias("day_of_week"),
        F.array_position(months, F.col(month)).alias("month_no"),
        F.array_position(days, F.col(dow)).alias("dow_no"),
        "n", F.round(F.col("m") * 100, digits).alias("yes_pct"))


def column_ranges(df: DataFrame, cols: list[str]) -> dict:
    """min/max of each column: one pass, one bounded row to the driver."""
    r = df.agg(*[F.min(c).cast("double").alias(f"lo_{c}") for c in cols],
               *[F.max(c).cast("double").alias(f"hi_{c}") for c in cols]).first()
    return {c: (r[f"lo_{c}"], r[f"hi_{c}"]) for c in cols}


def _bin(c: str, lo: float, hi: float, bins: int) -> Column:
    if lo is None:
        return F.lit(None).cast("bigint")
    if hi == lo:
        return F.when(F.col(c).isNotNull(), F.lit(0)).cast("bigint")
    # Equal-width bins, the last one closed on the right. ``least`` skips NULLs, so guard them.
    b = F.least(F.floor((F.col(c).cast("double") - F.lit(lo)) * bins / F.lit(hi - lo)), F.lit(bins - 1))
    return F.when(F.col(c).isNotNull(), b).cast("bigint")


def histogram(df: DataFrame, cols: list[str], bins: int = 30, by: str | None = None,
              digits: int = 6) -> DataFrame:
    """Equal-width histogram per numeric column (C17), optionally per class.

    ``(feature, [by,] bin, lo, hi, n)`` with every bin present (zero counts included).
    """
    keep = [by] if by else []
    df = stored(df.select(*keep, *cols), "histogram-columns")
    rng = column_ranges(df, cols)
    binned = df.select(*keep, *[_bin(c, *rng[c], bins).alias(c) for c in cols])
    long = binned.unpivot(keep, cols, "feature", "bin")
    counts = long.groupBy("feature", *keep, "bin").agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    grid_rows = [(c, float(rng[c][0]), float(rng[c][1])) for c in cols if rng[c][0] is not None]
    grid = spark.createDataFrame(grid_rows, "feature string, lo double, hi double").select(
        "feature", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    ).withColumn("bin", F.col("bin").cast("bigint"))
    if by:
        # Every bin of every class: one explode per (feature, class) of the counts, where a class
        # without a value of the feature still has its row of nulls.
        at = F.map_from_entries(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "n"))))
        filled = counts.groupBy("feature", by).agg(at.alias("at")).select(
            "feature", by, "at", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("b")).select(
            F.col("feature").alias("f"), by, F.col("b").cast("bigint").alias("bin"), F.try_element_at("at", F.col("b").cast("bigint")).alias("n"))
        ranges = spark.createDataFrame(grid_rows, "feature string, lo double, hi double")
        out = filled.join(ranges, F.col("f") == F.col("feature"))
    else:
        out = grid.join(counts, ["feature", "bin"], "left")
    w = (F.col("hi") - F.col("lo")) / bins
    return out.select(
        "feature", *keep, "bin",
        F.round(F.col("lo") + F.col("bin") * w, digits).alias("lo"),
        F.round(F.col("lo") + (F.col("bin") + 1) * w, digits).alias("hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


#: Terms of the density's expansion. With rows at most half a scale from their cell's centre a row's error
#: is below the sum over n >= 20 of 1.09 * 2**(-n/2) / sqrt(n!), that is 1e-12 of its kernel's height.
KDE_TERMS = 20
#: Kernels end where they are below e**-100.
KDE_REACH = 10.0


def kde_by_class(df: DataFrame, cols: list[str], by: str, points: int = 100, digits: int = 6) -> DataFrame:
    """Gaussian kernel density per class on a grid of ``points`` from min to max.

    Bandwidth per (feature, class) by Scott's rule ``h = sd * n^(-1/5)``. A fast Gauss transform: with
    the scale ``sqrt(2) h`` as width, rows fall into cells, and a cell keeps ``KDE_TERMS`` moments of
    its rows about its centre, the coefficients of a Hermite expansion of the sum of their kernels.
    Rows add to the moments where they are read (one partial aggregate of rows x terms, whatever the
    number of points), and every cell's expansion is then evaluated at the grid points in reach. The
    columns are written once. The density is reported times the feature's span (``density_x_span``), a
    dimensionless value of order one, rounded.
    """
    long = _long(stored(df.select(by, *cols), "density-columns"), cols, "double", keep=[by]).where(F.col("value").isNotNull())
    stats = long.groupBy("feature", by).agg(
        F.count(F.lit(1)).alias("n_c"), F.stddev_samp("value").alias("sd"), F.min("value").alias("mn"), F.max("value").alias("mx"))
    per_f = Window.partitionBy("feature")  # a row a class
    stats = stored(stats.select("feature", by, "n_c", F.min("mn").over(per_f).alias("lo"), F.max("mx").over(per_f).alias("hi"),
                                (F.col("sd") * F.pow("n_c", F.lit(-0.2))).alias("h")).where(F.col("h") > 0), "density-stats")
    scale = F.col("h") * math.sqrt(2)
    inside = (long.join(stats, ["feature", by]).withColumn("cell", F.floor((F.col("value") - F.col("lo")) / scale))
              .withColumn("u", (F.col("value") - F.col("lo")) / scale - F.col("cell") - 0.5))
    term, moments = F.lit(1.0), []
    for n in range(KDE_TERMS):
        moments.append(F.sum(term))
        term = term * F.col("u") / (n + 1)
    cells = inside.groupBy("feature", by, "cell").agg(F.array(*moments).alias("moments")).join(stats, ["feature", by])
    step = (F.col("hi") - F.col("lo")) / (points - 1)
    centre = (F.col("cell") + 0.5) * scale
    near = cells.withColumn("gi", F.explode(F.sequence(
        F.greatest(F.ceil((centre - KDE_REACH * scale) / step), F.lit(0)), F.least(F.floor((centre + KDE_REACH * scale) / step), F.lit(points - 1)))))
    # Hermite functions by their recurrence: h(n+1) = 2 x h(n) - 2 n h(n-1).
    near = near.withColumn("x", (F.col("gi") * step - centre) / scale)
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("before"), F.exp(-F.col("x") * F.col("x")).alias("now"), F.lit(0.0).alias("total"))
    total = F.aggregate("moments", start, lambda a, m: F.struct(
        (a["n"] + 1.0).alias("n"), a["now"].alias("before"), (2.0 * F.col("x") * a["now"] - 2.0 * a["n"] * a["before"]).alias("now"),
        (a["total"] + m * a["now"]).alias("total")), lambda a: a["total"])
    sums = near.groupBy("feature", by, "gi").agg(F.sum(total).alias("s"))
    grid = stats.withColumn("gi", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(points - 1).cast("bigint"))))
    d = F.coalesce("s", F.lit(0.0)) / (F.col("n_c") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))
    return grid.join(sums, ["feature", by, "gi"], "left").select(
        "feature", by, "gi", F.round(F.col("lo") + F.col("gi") * (F.col("hi") - F.col("lo")) / F.lit(points - 1), digits).alias("x"),
        F.round(d * (F.col("hi") - F.col("lo")), digits).alias("density_x_span"))


def pair_bins(df: DataFrame, cols: list[str], by: str, keep: Column, bins: int = 10) -> DataFrame:
    """2-D bin counts for every pair of numeric columns on the rows where ``keep`` holds (C20).

    Column pairs are bounded by the schema (k(k-1)/2); each row emits one binned point per pair
    and the counts aggregate partially before the shuffle.
    """
    s = df.where(keep)
    rng = column_ranges(s, cols)
    binned = s.select(by, *[_bin(c, *rng[c], bins).alias(c) for c in cols])
    pairs = [F.struct(F.lit(a).alias("f1"), F.lit(b).alias("f2"), F.col(a).alias("b1"), F.col(b).alias("b2"))
             for i, a in enumerate(cols) for b in cols[i + 1:]]
    e = binned.select(by, F.explode(F.array(*pairs)).alias("p")).select(by, "p.*")
    e = e.where(F.col("b1").isNotNull() & F.col("b2").isNotNull())
    return e.groupBy("f1", "f2", "b1", "b2", by).agg(F.count(F.lit(1)).alias("n"))


def pearson_matrix(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every column pair in one aggregate (C21): ``(f1, f2, r)``."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    st = one.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("f1"), F.lit(b).alias("f2"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs
    ])).alias("s")).select("s.*")
    return st.select("f1", "f2", F.round("r", digits).alias("r"))


def _edges(probs: list[float], accuracy: int) -> list[float]:
    eps = 2.0 / accuracy
    return [max(0.0, p - eps) for p in probs] + [min(1.0, p + eps) for p in probs]


def quantile_sketch(value: str, probs: list[float], accuracy: int = 100_000) -> list[Column]:
    """The aggregate columns ``exact_quantiles`` needs per key (``n, mn, mx, qs``), so a caller can
    compute them inside its own aggregate pass and hand the rows over as ``sketch``."""
    v = F.col(value).cast("double")
    return [F.count(v).alias("n"), F.min(v).alias("mn"), F.max(v).alias("mx"),
            F.percentile_approx(v, _edges([float(p) for p in probs], accuracy), accuracy).alias("qs")]


def exact_quantiles(long: DataFrame, key: str, value: str, probs: list[float],
                    accuracy: int = 100_000, sketch: DataFrame | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles per key, without holding a key's values in one task.

    1. One pass builds a mergeable ``percentile_approx`` sketch per key (or ``sketch``, a frame with the
       key and the columns of ``quantile_sketch``). Its answer for ``p -/+ 2 / accuracy``
       brackets the exact ranks ``floor(p(n-1))`` and ``ceil(p(n-1))``: the sketch's rank error
       is at most ``n / accuracy``.
    2. One counting pass gives, per (key, p), the rows below the bracket and inside it.
    3. Only rows inside the bracket (about ``4 n / accuracy``) are reduced to distinct values with
       counts, so a hot value is one row, and a running count inside the bracket finds the two
       ranks.
    If a bracket ever misses its ranks, that (key, p) is redone with the key's whole range, so the
    answer is exact either way. Brackets and answers are tables in the shared folder, any number of
    keys: few keys are broadcast by the planner, so rows aren't shuffled by key; many are joined by
    shuffle. Returns ``(key, p, q)``.
    """
    v = long.where(F.col(value).isNotNull()).select(key, F.col(value).cast("double").alias("_v"))
    probs = [float(p) for p in probs]
    k = len(probs)
    if sketch is None:
        sketch = long.groupBy(key).agg(*quantile_sketch(value, probs, accuracy))
    t = sketch.where(F.col("n") > 0).select(key, "n", "mn", "mx", F.explode(F.array(*[
        F.struct(F.lit(p).alias("p"), F.col("qs")[i].alias("lo"), F.col("qs")[k + i].alias("hi"))
        for i, p in enumerate(probs)])).alias("s")).select(key, "n", "mn", "mx", "s.*")
    pos = F.col("p") * (F.col("n") - 1)
    t = stored(t.select(key, "p", "mn", "mx", "lo", "hi", pos.alias("pos"),
                        F.floor(pos).cast("bigint").alias("r_lo"), F.ceil(pos).cast("bigint").alias("r_hi")), "quantile-brackets")

    def answer(t: DataFrame) -> DataFrame:
        # One aggregate: rows below the bracket collapse to one NULL-valued row per (key, p), rows
        # inside to one row per distinct value; rows above are dropped. NULLs sort first, so the
        # running count over that small table gives the rank range of every value.
        j = v.join(t.select(key, "p", "lo", "hi"), key).where(F.col("_v") <= F.col("hi"))
        d = j.groupBy(key, "p", F.when(F.col("_v") >= F.col("lo"), F.col("_v")).alias("vv")).agg(
            F.count(F.lit(1)).alias("c"))
        w = Window.partitionBy(key, "p").orderBy(F.col("vv").asc_nulls_first()).rowsBetween(
            Window.unboundedPreceding, 0)
        d = d.withColumn("cum", F.sum("c").over(w))
        d = d.join(t.select(key, "p", "pos", "r_lo", "r_hi"), [key, "p"])
        hit = lambda r: F.col("vv").isNotNull() & (F.col("cum") - F.col("c") <= F.col(r)) & (F.col(r) < F.col("cum"))
        g = d.groupBy(key, "p", "pos", "r_lo", "r_hi").agg(
            F.coalesce(F.max(F.when(F.col("vv").isNull(), F.col("c"))), F.lit(0)).alias("below"),
            F.coalesce(F.sum(F.when(F.col("vv").isNotNull(), F.col("c"))), F.lit(0)).alias("inside"),
            F.max(F.when(hit("r_lo"), F.col("vv"))).alias("v_lo"),
            F.max(F.when(hit("r_hi"), F.col("vv"))).alias("v_hi"))
        ok = (F.col("below") <= F.col("r_lo")) & (F.col("r_hi") < F.col("below") + F.col("inside"))
        # A (key, p) with no row at or below ``hi`` is absent from ``g``: a miss as well.
        out = t.select(key, "p").join(g, [key, "p"], "left")
        return out.select(key, "p", F.coalesce(ok, F.lit(False)).alias("ok"),
                          (F.col("v_lo") + (F.col("pos") - F.col("r_lo")) * (F.col("v_hi") - F.col("v_lo"))).alias("q"))

    first = stored(answer(t), "quantile-answers")
    good = first.where("ok").select(key, "p", "q")
    missed = first.where("not ok").select(key, "p")
    if missed.isEmpty():
        return good
    redo = stored(t.join(missed, [key, "p"]).withColumn("lo", F.col("mn")).withColumn("hi", F.col("mx")), "quantile-redo")
    return good.unionByName(answer(redo).select(key, "p", "q"))


def profile_numeric(df: DataFrame, cols: list[str], probs=(0.25, 0.5, 0.75), digits: int = 6,
                    accuracy: int = 100_000) -> DataFrame:
    """Per numeric column: count, NULLs, distinct, mean, std, min, quartiles, max, zeros.

    The columns are written once. Three passes read them: one aggregate gives the moments and the
    quantile sketch, one the exact distinct counts, and ``exact_quantiles`` the ranks. The result has
    one row per column.
    """
    probs = [float(p) for p in probs]
    long = _long(stored(df.select(*cols), "profile-columns"), cols, "double")
    sums = stored(long.groupBy("feature").agg(
        F.count_if(F.col("value").isNull()).alias("n_null"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.count_if(F.col("value") == 0).alias("n_zero"),
        *quantile_sketch("value", probs, accuracy)), "profile-sums")
    stats = sums.collect()  # one row per column
    # Distinct values in their own aggregate: next to a distinct aggregate Spark would evaluate
    # the sketch per (column, value) group.
    distinct = {r["feature"]: r["n_distinct"] for r in long.where(F.col("value").isNotNull())
                .select("feature", "value").distinct().groupBy("feature")
                .agg(F.count(F.lit(1)).alias("n_distinct")).collect()}
    q = {(r["feature"], r["p"]): r["q"]
         for r in exact_quantiles(long, "feature", "value", probs, accuracy, sketch=sums).collect()}
    names = [f"p{int(round(p * 100))}" for p in probs]
    rows = [(r["feature"], r["n"], r["n_null"], distinct.get(r["feature"], 0), r["mean"], r["std"], r["mn"],
             *[q.get((r["feature"], p)) for p in probs], r["mx"], r["n_zero"]) for r in stats]
    schema = ("feature string, n bigint, n_null bigint, n_distinct bigint, mean double, std double, min double, "
              + ", ".join(f"{n} double" for n in names) + ", max double, n_zero bigint")
    out = df.sparkSession.createDataFrame(rows, schema)
    return out.select("feature", "n", "n_null", "n_distinct",
                      *[F.round(c, digits).alias(c) for c in ("mean", "std", "min", *names, "max")], "n_zero")


def profile_categorical(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per categorical column: count, NULLs, distinct, most frequent value and its count.

    The top value is ``min((-count, value))``, an aggregate that merges partially, so no window
    holds all categories of a column.
    """
    long = _long(df, cols, "string")
    nulls = long.groupBy("feature").agg(F.count("value").alias("n"),
                                        F.count_if(F.col("value").isNull()).alias("n_null"))
    vc = long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("c"))
    top = vc.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_distinct"),
        F.min(F.struct((-F.col("c")).alias("k"), F.col("value").alias("v"))).alias("t"))
    return nulls.join(top, "feature", "left").select(
        "feature", "n", "n_null", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
        F.col("t.v").alias("top"), (-F.col("t.k")).alias("top_freq"))


def duplicate_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row on ``cols`` (all columns by default)."""
    cols = cols or df.columns
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("k"))
    return g.agg(F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"),
                 F.count(F.lit(1)).alias("n_distinct_rows"))
