"""Sinks for scored rows and metric reports.

Outputs are partitioned by ``run_date`` with dynamic partition overwrite, so re-running a day
replaces that day only (the original wrote into a dated folder and failed on a second run).
Vector columns are turned into arrays or text first: CSV cannot hold them.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.ml.linalg import VectorUDT


def vectors_to_arrays(df: DataFrame) -> DataFrame:
    """Every ML vector column becomes ``array<double>`` (typed sinks, SQL, comparisons)."""
    return df.withColumns({f.name: vector_to_array(F.col(f.name)) for f in df.schema.fields
                           if isinstance(f.dataType, VectorUDT)})


def vectors_to_text(df: DataFrame) -> DataFrame:
    """Every ML vector column becomes its text form (CSV sinks)."""
    return df.withColumns({f.name: F.col(f.name).cast("string") for f in df.schema.fields
                           if isinstance(f.dataType, VectorUDT)})


def write_dated(df: DataFrame, base: str, run_date: str, fmt: str = "parquet", header: bool = True) -> None:
    """Write ``df`` under ``base/run_date=<run_date>/`` replacing only that partition."""
    out = vectors_to_text(df) if fmt == "csv" else vectors_to_arrays(df)
    w = (out.withColumn("run_date", F.lit(run_date)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("run_date").format(fmt))
    if fmt == "csv":
        w = w.option("header", header)
    w.save(base)


def read_dated(spark: SparkSession, base: str, run_date: str, fmt: str = "parquet",
               schema: T.StructType | None = None, header: bool = True) -> DataFrame:
    """Read one day back; the ``run_date`` filter prunes the other partitions."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", header)
    if schema is not None:
        r = r.schema(T.StructType([*schema.fields, T.StructField("run_date", T.StringType())]))
    df = r.load(base)
    return df.where(F.col("run_date").cast("string") == run_date).withColumn(
        "run_date", F.col("run_date").cast("string"))


def write_single_csv(df: DataFrame, path: str) -> None:
    """One CSV file (A13), written by one task: for results that the caller knows to be small."""
    vectors_to_text(df).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
