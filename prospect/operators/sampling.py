"""Repeatable splits and samples.

Every row's fate depends on a hash of its key and the seed only, so the same rows come out on
any cluster layout, after a retry, and in the DuckDB oracle. No shuffle is involved: these are
narrow filters / projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prospect.functions.hashing import hash_unit


def hash_split(df: DataFrame, key: str, weights: dict[str, float], seed: int = 0,
               out: str = "split") -> DataFrame:
    """Label each row with a split name by cumulative weight of ``hash_unit(key, seed)`` (F1, F2).

    ``{"train": 0.8, "test": 0.2}``; weights are normalised, a zero weight gives an empty split.
    """
    total = float(sum(weights.values()))
    if total <= 0:
        raise ValueError("weights must sum to a positive number")
    u = hash_unit(key, seed)
    expr, acc = None, 0.0
    names = list(weights)
    for name in names[:-1]:
        acc += weights[name] / total
        expr = F.when(u < acc, name) if expr is None else expr.when(u < acc, name)
    last = F.lit(names[-1])
    return df.withColumn(out, last if expr is None else expr.otherwise(last))


def split_frames(df: DataFrame, key: str, weights: dict[str, float], seed: int = 0) -> dict[str, DataFrame]:
    """The splits of ``hash_split`` as separate lazy frames (one filter each)."""
    s = hash_split(df, key, weights, seed, out="_split")
    return {name: s.where(F.col("_split") == name).drop("_split") for name in weights}


def fold_index(key: str, folds: int, seed: int = 0) -> Column:
    """Fold number in ``[0, folds)`` from ``hash_unit(key, seed)``.

    Use a seed different from the one that made the train split: train rows share a hash range,
    so folds made with the split seed would cover unequal slices of it.
    """
    return F.least(F.floor(hash_unit(key, seed) * folds), F.lit(folds - 1)).cast("int")


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """Plain fraction sample."""
    return df.where(hash_unit(key, seed) < F.lit(float(fraction)))


def hash_sample_by(df: DataFrame, key: str, strata: str, fractions: dict, seed: int = 0) -> DataFrame:
    """Stratified sample: keep a row of class ``c`` when its hash is below ``fractions[c]``.

    Classes missing from ``fractions`` are dropped, as in ``sampleBy``.
    """
    frac = None
    for c, f in fractions.items():
        frac = F.when(F.col(strata) == c, F.lit(float(f))) if frac is None else frac.when(
            F.col(strata) == c, F.lit(float(f)))
    return df.where(hash_unit(key, seed) < F.coalesce(frac, F.lit(0.0)))


def holdout_then_balance(df: DataFrame, key: str, strata: str, fractions: dict, holdout: float = 0.2,
                         seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Split a hold-out first, then rebalance the training part only."""
    parts = split_frames(df, key, {"train": 1.0 - holdout, "holdout": holdout}, seed)
    balanced = hash_sample_by(parts["train"], key, strata, fractions, seed + 1)
    return balanced, parts["holdout"]
