"""Corpus pipeline: toxicity, line dedup, near-dedup, mixing and packing, one stage after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marginalia.llm.common import stored, table
from marginalia.llm.linededup import line_dedup_stage
from marginalia.llm.mixing import mixing_stage
from marginalia.llm.packing import packing_stage
from marginalia.llm.simhash import simhash_stage
from marginalia.llm.toxicity import toxicity_stage

#: In the order they run; each takes (spark, docs, sf_dir).
STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash", simhash_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The classifier, the clustering and the packing can't be put in SQL; tests/llm holds each stage against a plain
#: version: scores, lines, similar sets, the sorted mix, and the tokens and places of all pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents; what each returns is stored as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
