"""Batch jobs: train a pipeline on a contact table, score a new one into dated folders.

    python -m prospect.jobs train --input DIR --model DIR [--test-share 0.2] [--partitions 8]
    python -m prospect.jobs score --input DIR --model DIR --output DIR --run-date YYYY-MM-DD

Inputs are Parquet folders or delimited files with a header (``--sep``). ``train`` saves the fitted
pipeline under ``model/fitted`` and the unfitted one under ``model/unfitted``, and prints the metrics
of the hash test split. ``score`` writes ``output/scores/run_date=...``; if the input has the label,
also the metrics row under ``output/metrics/run_date=...``. Running a day again replaces that day.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from prospect.operators import metrics as M
from prospect.operators import models as MD
from prospect.operators.prep import sanitize_columns
from prospect.operators.sampling import split_frames
from prospect.sources.sinks import write_dated
from prospect.sources.tables import read_delimited
from prospect.spec import CONTACTS, TableSpec


def read_input(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    if sep is None:
        return spark.read.parquet(path)
    return sanitize_columns(read_delimited(spark, path, sep=sep, infer=True))


def train(rows: DataFrame, model_path: str, spec: TableSpec = CONTACTS, name: str = "gbt", test_share: float = 0.2,
          seed: int = 420, partitions: int | None = None, **params) -> DataFrame:
    """Fit on the train split, save both pipelines, and return the metrics of the test split."""
    parts = split_frames(rows, spec.id, {"train": 1.0 - test_share, "test": test_share}, seed)
    MD.save(MD.unfitted_pipeline(spec, name, **params), f"{model_path}/unfitted")
    model = MD.train_pipeline(parts["train"], spec, name, partitions, **params)
    MD.save(model, f"{model_path}/fitted")
    return M.binary_metrics(MD.score(parts["test"], model, spec.id, spec))


def score(rows: DataFrame, model_path: str, output: str, run_date: str, spec: TableSpec = CONTACTS) -> None:
    """Score ``rows`` (labelled or not) with a saved pipeline into the dated folders."""
    scored = MD.score(rows, MD.load(f"{model_path}/fitted"), spec.id, spec)
    write_dated(scored, f"{output}/scores", run_date)
    if "label" in scored.columns:
        write_dated(M.binary_metrics(scored), f"{output}/metrics", run_date)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="prospect.jobs")
    p.add_argument("job", choices=["train", "score"])
    for name in ("input", "model"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--output")
    p.add_argument("--run-date")
    p.add_argument("--sep")
    p.add_argument("--test-share", type=float, default=0.2)
    p.add_argument("--partitions", type=int, help="of the training rows; by default their number decides")
    a = p.parse_args(argv)
    if a.job == "score" and not (a.output and a.run_date):
        p.error("score needs --output and --run-date")
    spark = SparkSession.builder.appName(f"prospect-{a.job}").getOrCreate()
    rows = read_input(spark, a.input, a.sep)
    if a.job == "train":
        train(rows, a.model, test_share=a.test_share, partitions=a.partitions).show()
    else:
        score(rows, a.model, a.output, a.run_date)


if __name__ == "__main__":
    main()
