"""Small helpers shared by the operators: tables written to the shared folder, row tests on
columns, and connected components over an edge table of any size."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import reduce

import prospect
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prospect.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (once per application), as
    ``--py-files`` does, so that functions of its modules can be run there."""
    sc = spark.sparkContext
    if getattr(sc, "_prospect_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(prospect.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="prospect-ship-"), "prospect.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    f = os.path.join(folder, n)
                    z.write(f, os.path.join("prospect", os.path.relpath(f, root)))
    sc.addPyFile(path)
    sc._prospect_shipped = True


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the session's shared folder and read back: the lineage
    is cut, and an executor lost later costs nothing but a reread."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession, floor: int = 1) -> int:
    return max(floor, int(spark.conf.get("spark.sql.shuffle.partitions")))


def temp_name(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def _ranked(name: str, turn: int) -> Column:
    return F.struct(F.xxhash64(F.col(name), F.lit(turn)).alias("r"), F.col(name).alias("n"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an undirected edge table; nodes of one component get
    the same ``root``, one of them. Nodes without an edge to another node are not returned.

    Each round maps every node to the neighbour (or itself) that comes first in an order drawn
    anew for the round, then contracts the edges along that map and drops loops and repeats. A
    node survives only if it comes first among its neighbours, so the graph shrinks by a constant
    factor whatever its shape (a fixed order would lose one node a round on a sorted chain). The
    maps are written to the shared folder and joined backwards at the end. A hub's neighbours are
    combined map-side by ``min``, and joins on a hub are left to the skew-join rule; no node's
    neighbours meet in one task.
    """
    e = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
                .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
                .distinct(), "cc-edges")
    kind = e.schema["a"].dataType
    maps: list[DataFrame] = []
    while not e.isEmpty():
        turn = len(maps)
        near = (e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
                .groupBy("a").agg(F.min(_ranked("b", turn)).alias("m"))
                .select(F.col("a").alias("node"), F.least(F.col("m"), _ranked("a", turn))["n"].alias("to")))
        near = written(near, "cc-map")
        maps.append(near)
        e = written(e.join(near.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a")
                    .join(near.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
                    .where("ta <> tb")
                    .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
                    .distinct(), "cc-edges")
    if not maps:
        return e.select(F.col("a").cast(kind).alias("node"), F.col("b").cast(kind).alias("root"))

    def through(later: DataFrame, earlier: DataFrame) -> DataFrame:
        return (earlier.join(later.select(F.col("node").alias("to"), F.col("root")), "to", "left")
                .select("node", F.coalesce("root", "to").alias("root")))

    last = maps[-1].select("node", F.col("to").alias("root"))
    return reduce(through, reversed(maps[:-1]), last)
