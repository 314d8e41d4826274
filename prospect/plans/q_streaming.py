"""Registered streaming queries.

The contacts are written as several parquet files (the "arrivals"), then consumed by a
streaming query with ``availableNow``; the result is read back from the sink.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from prospect.operators import models as MD
from prospect.operators import sampling as SA
from prospect.plans.oracle import with_ctes
from prospect.plans.q_stats import cts
from prospect.plans.registry import register
from prospect.session import scratch_path
from prospect.sources.contacts import rule_scored
from prospect.spec import CONTACTS
from prospect.streaming import score_stream as SS


def _arrivals(spark, df, name, batches=4):
    """Write ``df`` with its own parallelism (one file per task) and return the folder and the
    files per trigger that replay it as about ``batches`` micro-batches."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    n_files = len(spark.read.parquet(path).inputFiles())
    return path, max(1, -(-n_files // batches))


@register("stream_score")
def q_stream_score(spark, d):
    """A pipeline fitted on the train split scores the arriving contact files (rows-only check;
    equality with batch scoring is a property test)."""
    c = cts(spark, d)
    parts = SA.split_frames(c, "contact_id", {"train": 0.8, "test": 0.2}, seed=420)
    model = MD.train_pipeline(parts["train"], CONTACTS, "lr")
    src, per_trigger = _arrivals(spark, c, "arrivals")
    stream = SS.scored_stream(spark, src, c.schema, model, "contact_id", max_files_per_trigger=per_trigger)
    sink = scratch_path(spark, "stream-sink")
    SS.run_to_files(stream, sink, scratch_path(spark, "stream-ckpt"))
    return spark.read.parquet(sink)


@register("stream_confusion", with_ctes(
    "SELECT label, prediction, count(*) AS n FROM scored GROUP BY label, prediction"))
def q_stream_confusion(spark, d):
    """Running confusion counts over arriving scored rows; equals the batch C15 counts."""
    s = rule_scored(cts(spark, d))
    src, per_trigger = _arrivals(spark, s, "scored-arrivals")
    stream = spark.readStream.schema(s.schema).option("maxFilesPerTrigger", per_trigger).parquet(src)
    sink = scratch_path(spark, "confusion")
    SS.run_complete_to_table(SS.running_confusion(stream), sink, scratch_path(spark, "confusion-ckpt"))
    return spark.read.parquet(sink).select("label", "prediction", F.col("n").cast("bigint").alias("n"))


@register("stream_batch_diff", with_ctes("SELECT count(*) AS n_rows, 0 AS n_differ FROM contacts"))
def q_stream_batch_diff(spark, d):
    """Arriving files scored by a linear SVM into the dated sink equal the batch scores."""
    c = cts(spark, d)
    src, per_trigger = _arrivals(spark, c, "svc-arrivals")
    c = spark.read.schema(c.schema).parquet(src)  # the joins run once
    parts = SA.split_frames(c, "contact_id", {"train": 0.8, "test": 0.2}, seed=420)
    model = MD.train_pipeline(parts["train"], CONTACTS, "svc", maxIter=10)
    base = scratch_path(spark, "svc-dated")
    SS.run_to_dated(SS.scored_stream(spark, src, c.schema, model, "contact_id", per_trigger), base,
                    scratch_path(spark, "svc-ckpt"), "2018-08-03")
    got = spark.read.parquet(base).where("run_date = date'2018-08-03'").select("contact_id", F.col("prediction").alias("p"), F.round("p1", 9).alias("s"))
    want = MD.score(c, model, "contact_id").select("contact_id", "prediction", F.round("p1", 9).alias("p1"))
    return got.join(want, "contact_id", "full").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~(F.col("p").eqNullSafe(F.col("prediction")) & F.col("s").eqNullSafe(F.col("p1")))).alias("n_differ"))
