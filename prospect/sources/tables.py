"""Scans of the given tables and of delimited files (A1-A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prospect.session import stored

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Tables:
    """Lazy parquet tables of one scale-factor folder: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   sep: str = ";", header: bool = True, infer: bool = False) -> DataFrame:
    """Delimited scan (A1). An explicit schema is the default; inference is an extra pass, opt-in."""
    r = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


CORRUPT = "_rejected"


def read_quarantined(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";",
                     header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Delimited scan that keeps malformed rows apart (A1): ``(typed rows, rejected rows)``.

    A row is rejected if a field doesn't parse as its type or the number of fields differs; the rejected
    frame has the whole line as ``record``. The file is parsed once, both frames read the parsed rows.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = (spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).schema(wide).csv(path))
    rows = stored(parsed, "parsed")
    good = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, rows.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("record"))


def read_all_string(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with header where every column stays a string (A2)."""
    return spark.read.option("header", True).option("sep", sep).csv(path)


def read_positional(spark: SparkSession, path: str, names: list[str], sep: str = "\t") -> DataFrame:
    """Headerless delimited file; columns named by position (A3, B2)."""
    return spark.read.option("header", False).option("sep", sep).csv(path).toDF(*names)
