"""Session construction and the shared scratch folder.

On a cluster the scratch folder is the shared one named by ``spark.checkpoint.dir``; a local
folder is only chosen when that setting is unset (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "prospect", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every job here expects.

    AQE stays on so shuffle partition counts, skewed joins and join strategies are re-planned
    from runtime sizes; the UI is off (no port).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    cpus = os.cpu_count() or 8
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or cpus),
        "spark.driver.memory": "16g",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a local one only when none is configured."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not d:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            # Unset on one machine: local runs and tests only.
            d = tempfile.mkdtemp(prefix="prospect-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder for one job's output."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: work that is read several times runs once,
    a lost executor costs a reread, and the planner knows the size of what it joins."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
