"""Projections, casts and missing-data handling.

All of it is one narrow projection per call (no shuffle), except the fits that need a table
statistic (mode, mean), which are a single partially-aggregated pass returning a bounded row.
"""

from __future__ import annotations

from pyspark.ml.feature import Imputer, ImputerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sanitize_columns(df: DataFrame, old: str = ".", new: str = "_") -> DataFrame:
    """Rename every column replacing ``old`` by ``new`` in one projection (B1); fail on collisions."""
    names = [c.replace(old, new) for c in df.columns]
    dup = {n for n in names if names.count(n) > 1}
    if dup:
        raise ValueError(f"renaming would collide: {sorted(dup)}")
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names)])


def cast_columns(df: DataFrame, cols: list[str], to: str = "double") -> DataFrame:
    """Cast a column list in one projection (B3, B4). ``try_cast``: bad text becomes NULL, not an error."""
    return df.withColumns({c: F.col(c).try_cast(to) for c in cols})


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop columns by name."""
    return df.drop(*cols)


def map_values(col: str, mapping: dict, otherwise=None) -> Column:
    """``CASE`` chain value -> number (B7); unmapped values become NULL unless ``otherwise`` is set."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(F.col(col) == k, F.lit(v)) if expr is None else expr.when(F.col(col) == k, F.lit(v))
    if otherwise is not None:
        expr = expr.otherwise(F.lit(otherwise))
    return expr


def fields_by_kind(df: DataFrame, kind: str, *extra: str) -> list[str]:
    """Column names whose type is categorical (string) or numeric, plus ``extra``."""
    if kind == "categorical":
        names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    elif kind == "numeric":
        names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    else:
        raise ValueError(kind)
    return names + [e for e in extra if e not in names]


def select_by_kind(df: DataFrame, kind: str, *extra: str) -> DataFrame:
    return df.select(*fields_by_kind(df, kind, *extra))


def sentinel_to_null(col: str, sentinel) -> Column:
    """Sentinel value -> NULL (B16), e.g. ``pdays = 999``."""
    return F.nullif(F.col(col), F.lit(sentinel))


def column_modes(df: DataFrame, cols: list[str], ignore: str | None = None) -> dict:
    """Most frequent value per column (ties -> smallest value), NULL and ``ignore`` skipped.

    One pass: unpivot to (feature, value), count per pair (partial aggregation map-side), then
    one ``min`` of (-count, value) per feature, which also aggregates partially. The result is
    one value per column, a bounded row brought back to the driver.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "feature", "value").where(F.col("value").isNotNull())
    if ignore is not None:
        long = long.where(F.col("value") != ignore)
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("k"), "value")).alias("m"))
    return {r["feature"]: r["m"]["value"] for r in best.collect()}


def unknown_policy(df: DataFrame, cols: list[str], token: str = "unknown", how: str = "keep") -> DataFrame:
    """Treat ``token`` in categoricals as a class (``keep``), drop such rows (``drop``) or impute the
    column mode (``mode``) (B17)."""
    if how == "keep":
        return df
    if how == "drop":
        cond = None
        for c in cols:
            e = F.coalesce(F.col(c) != token, F.lit(True))
            cond = e if cond is None else cond & e
        return df.where(cond)
    if how == "mode":
        modes = column_modes(df, cols, ignore=token)
        return df.withColumns({c: F.when(F.col(c) == token, F.lit(modes.get(c))).otherwise(F.col(c))
                               for c in cols})
    raise ValueError(how)


def fit_imputer(df: DataFrame, cols: list[str], strategy: str = "mean",
                suffix: str = "") -> ImputerModel:
    """Fill NULL/NaN with a fitted column statistic (B18); the model keeps it for scoring."""
    return Imputer(strategy=strategy, inputCols=cols, outputCols=[c + suffix for c in cols]).fit(df)


def linspace(lo: Column, hi: Column, n: int) -> Column:
    """Array of ``n`` evenly spaced values from ``lo`` to ``hi`` inclusive (B19), built in the JVM."""
    i = F.sequence(F.lit(0), F.lit(n - 1))
    return F.transform(i, lambda k: lo + k * (hi - lo) / F.lit(n - 1))


def columns_at(df: DataFrame, start: int, stop: int) -> DataFrame:
    """The columns at positions ``start`` to ``stop`` (exclusive), as a slice."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns[start:stop]])


def rows_with_null(df: DataFrame, col: str) -> DataFrame:
    """The rows whose value is missing."""
    return df.where(F.col(f"`{col}`").isNull())
