"""Training-text pipeline over ``documents``: five stages, each written as Parquet and read again.

1. ``language``: documents whose language can't be told go, ``lang`` is the prediction;
2. ``near_duplicates``: one document of each SimHash group stays;
3. ``secrets``: found secrets are replaced in the texts, all documents stay;
4. ``mixture``: documents appear as often as the temperature mix of their sources has them;
5. ``tokens``: ids of every row's text, and the round trip back to text, as digests.

Each stage works on all rows its predecessor kept. A table without rows passes through; nulls, empty
texts, repeated rows and further columns are handled by the operators as their modules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prospect.llm.common import table, written
from prospect.llm.langid import language_stage
from prospect.llm.mixing import mixing_stage
from prospect.llm.secret_scan import secret_stage
from prospect.llm.sentencepiece_codec import sentencepiece_stage
from prospect.llm.simhash import simhash_stage

STAGES = [
    ("language", language_stage),
    ("near_duplicates", simhash_stage),
    ("secrets", secret_stage),
    ("mixture", mixing_stage),
    ("tokens", sentencepiece_stage),
]

#: Compression, fingerprints of words and tokenizers are beyond SQL; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
