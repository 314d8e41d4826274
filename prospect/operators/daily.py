"""Mergeable daily profiles (C3-C5, C22 over any range of days).

``daily_profile`` reduces a day's rows, once, to a row per (day, column): counts, sums, extremes, and
two sketches (HyperLogLog for distinct values, KLL for quantiles). ``united`` answers for any range of days
by merging those rows, without reading the data again. Counts, mean, deviation and extremes are
exact (up to rounding); distinct counts and quantiles carry the sketches' errors, about 1.04 / sqrt(2**LG_K) and
``RANK_ERROR`` of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K = 12
KLL_K = 400
RANK_ERROR = 0.01


def daily_profile(df: DataFrame, day: str, cols: list[str]) -> DataFrame:
    """``(run_date, feature, n, n_null, total, squares, min, max, distinct_sketch, rank_sketch)``; ``cols`` are
    numeric (as doubles) or anything else (as text, without sums and ranks). Rows without a day are left out."""
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")}
    pair = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("value"),
                              (F.col(f"`{c}`").cast("double") if c in numeric else F.lit(None).cast("double")).alias("number")) for c in cols])
    long = df.where(F.col(f"`{day}`").isNotNull()).select(F.col(f"`{day}`").cast("date").cast("string").alias("run_date"),
                                                          F.explode(pair).alias("p")).select("run_date", "p.*")
    x = F.col("number")
    return long.groupBy("run_date", "feature").agg(
        F.count("value").alias("n"), F.count_if(F.col("value").isNull()).alias("n_null"), F.sum(x).alias("total"), F.sum(x * x).alias("squares"),
        F.min(x).alias("min"), F.max(x).alias("max"), F.hll_sketch_agg("value", F.lit(LG_K)).alias("distinct_sketch"),
        F.kll_sketch_agg_double(x, F.lit(KLL_K)).alias("rank_sketch"))


def store_days(profile: DataFrame, base: str) -> None:
    """Write the days of ``profile`` under ``base``; days that are there already are replaced, others stay."""
    (profile.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(base))


def stored_days(spark: SparkSession, base: str, first: str, last: str) -> DataFrame:
    """The stored rows of a range of days; the filter prunes the other folders."""
    d = spark.read.option("basePath", base).parquet(base).withColumn("run_date", F.col("run_date").cast("string"))
    return d.where(F.col("run_date").between(first, last))


def united(profile: DataFrame, probs: list[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``(feature, n, n_null, n_distinct, mean, std, min, p25, .., max)`` over all days of ``profile``."""
    names = [f"p{int(round(p * 100))}" for p in probs]
    g = profile.groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.sum("total").alias("total"), F.sum("squares").alias("squares"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.hll_union_agg("distinct_sketch").alias("d"),
        F.kll_merge_agg_double("rank_sketch").alias("r"))
    numeric = F.col("total").isNotNull()
    spread = F.col("squares") - F.col("total") * F.col("total") / F.col("n")
    return g.select(
        "feature", "n", "n_null", F.hll_sketch_estimate("d").alias("n_distinct"), F.try_divide("total", F.col("n")).alias("mean"),
        F.when(numeric, F.sqrt(F.greatest(F.try_divide(spread, F.col("n") - 1), F.lit(0.0)))).alias("std"), "min",
        *[F.when(numeric, F.kll_sketch_get_quantile_double("r", F.lit(float(p)))).alias(c) for p, c in zip(probs, names, strict=True)], "max")
