"""Feature encoding as MLlib pipeline stages.

One multi-column ``StringIndexer`` (a single counting pass for all categoricals, labels bounded
by category cardinality), one multi-column ``OneHotEncoder``, mean ``Imputer`` for numerics that
can be missing, and ``VectorAssembler`` with one-hot blocks first, numerics last. The label is
an explicit map (no -> 0, yes -> 1) made before the stages, so rebalancing can never flip it and a
saved pipeline scores rows that have none.
Every stage is fitted on training rows only and saved with the model.

``handle_invalid="keep"`` (the default for training) reserves the all-zero one-hot vector for
values unseen at fit time, so every seen category keeps a slot; ``"error"`` reproduces the
original layout where ``dropLast`` removes the last seen category (n - 1 slots per column).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import Bucketizer, Imputer, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prospect.operators.stats import exact_quantiles
from prospect.spec import TableSpec


def labelled(df: DataFrame, spec: TableSpec, out: str = "label") -> DataFrame:
    """The label as a double (1.0 positive, 0.0 negative, NULL for another value)."""
    y = F.col(f"`{spec.label}`")
    return df.withColumn(out, F.when(y == F.lit(spec.positive), F.lit(1.0)).when(y == F.lit(spec.negative), F.lit(0.0)))


#: Values that a binned numeric has at most.
BINS = 32


def bin_borders(df: DataFrame, cols: list[str], bins: int = BINS) -> dict[str, list[float]]:
    """Borders that cut each numeric into at most ``bins`` bins of about equal counts: exact quantiles, without
    those that leave less than a quarter of an even share on a side. Tree learners draw their split
    candidates from a sample of rows taken partition by partition; of a column of so few and so frequent
    values every sample sees all, so the candidates, and the trees, don't depend on the partitions."""
    wide = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    long = wide.unpivot([], cols, "feature", "value")
    found: dict[str, set[float]] = {c: set() for c in cols}
    for r in exact_quantiles(long, "feature", "value", [i / bins for i in range(1, bins)]).collect():  # bins rows a column
        found[r["feature"]].add(r["q"])
    at = {c: [float("-inf"), *(sorted(v) or [0.0]), float("inf")] for c, v in found.items()}
    cut = Bucketizer(splitsArray=[at[c] for c in cols], inputCols=cols, outputCols=[f"{c}_bin" for c in cols], handleInvalid="keep").transform(wide)
    counts = cut.select(*[F.when(F.col(c).isNotNull(), F.col(f"{c}_bin")).alias(c) for c in cols]).unpivot([], cols, "feature", "bin")
    sizes = {(r["feature"], int(r["bin"])): r["n"] for r in counts.where("bin is not null").groupBy("feature", "bin")
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    out = {}
    for c in cols:
        inner = at[c][1:-1]
        share = [sizes.get((c, i), 0) for i in range(len(inner) + 1)]
        least = sum(share) / (4 * bins)
        kept, left = [], 0
        for i, border in enumerate(inner):
            left += share[i]
            if left >= least and sum(share[i + 1:]) >= least:
                kept.append(border)
                left = 0
        out[c] = kept or inner[:1]
    return out


def encoding_stages(spec: TableSpec, drop_last: bool = True, handle_invalid: str = "keep",
                    impute: bool = True, borders: dict[str, list[float]] | None = None) -> list:
    """The stages of E1-E5; with ``borders`` (see ``bin_borders``) numerics enter as the number of their bin."""
    cats = list(spec.categorical)
    nums = list(spec.numeric)
    stages = []
    num_cols = nums
    if impute and nums:
        num_cols = [f"{c}_imp" for c in nums]
        stages.append(Imputer(strategy="mean", inputCols=nums, outputCols=num_cols))
    if borders and nums:
        cut = [f"{c}_cut" for c in nums]
        stages.append(Bucketizer(splitsArray=[[float("-inf"), *borders[c], float("inf")] for c in nums], inputCols=num_cols,
                                 outputCols=cut, handleInvalid="keep"))
        # Plain numbers: with the bins as categories a tree would regroup them freely.
        stages.append(SQLTransformer(statement="SELECT *, " + ", ".join(f"`{c}` + 0D AS `{c[:-4]}_bin`" for c in cut) + " FROM __THIS__"))
        num_cols = [f"{c}_bin" for c in nums]
    stages.append(StringIndexer(inputCols=cats, outputCols=[f"{c}_index" for c in cats],
                                handleInvalid=handle_invalid, stringOrderType="frequencyDesc"))
    stages.append(OneHotEncoder(inputCols=[f"{c}_index" for c in cats], outputCols=[f"{c}_vec" for c in cats],
                                dropLast=drop_last, handleInvalid=handle_invalid))
    stages.append(VectorAssembler(inputCols=[f"{c}_vec" for c in cats] + num_cols, outputCol="features",
                                  handleInvalid="keep"))
    return stages


def feature_pipeline(spec: TableSpec, **kw) -> Pipeline:
    return Pipeline(stages=encoding_stages(spec, **kw))


def feature_count(df: DataFrame, col: str = "features") -> int:
    """Width of an assembled vector from the column metadata (E8); no data is read."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    return sum(len(v) for v in meta.get("attrs", {}).values())


def vector_long(df: DataFrame, id_col: str, vec: str, nonzero: bool = True) -> DataFrame:
    """``(id, slot, value)`` rows of a vector column, the comparable form of a vector."""
    e = df.select(id_col, F.posexplode(vector_to_array(F.col(vec))).alias("slot", "value"))
    return e.where(F.col("value") != 0) if nonzero else e

