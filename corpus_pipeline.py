"""From raw documents to a training mixture: each stage is one corpus operator, written out before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewloom.llm import line_runs, near_copies, ordinal_toxicity, poisson_mix, winnowing
from viewloom.llm.common import scratch, stored, table

STAGES = [
    ("toxicity", ordinal_toxicity.stage),
    ("line dedup", line_runs.stage),
    ("simhash near-dedup", near_copies.stage),
    ("benchmark decontamination", winnowing.stage),
    ("mixing to target weights", poisson_mix.stage),
]

#: Scores of a trained model can't be had in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that all stages leave, repeated to the target weights, with `copy`."""
    folder = scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/stage{number}")
    return docs
