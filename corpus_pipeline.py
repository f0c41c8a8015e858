"""A corpus pipeline of five operators; each stage is written as Parquet and read as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import decontamination, packing, simhash, substring_dedup, toxicity
from quire.llm.common import Table

STAGES = [
    ("toxicity", toxicity.stage),
    ("simhash_near_dedup", simhash.stage),
    ("substring_dedup", substring_dedup.stage),
    ("benchmark_decontamination", decontamination.stage),
    ("packing", packing.stage),
]

#: Classifier, shingle sets and tokeniser are outside SQL; tests compare run() with plain versions of the stages, one after the other.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's table goes once the next one is written."""
    docs, held = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        written = Table(spark, stage(spark, docs, sf_dir))
        if held:
            held.drop()
        docs, held = written.df, written
    return STAGES[-1][1](spark, docs, sf_dir)
