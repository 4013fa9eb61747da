"""A training corpus from raw documents: the stages in order, and all of them at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanwright.llm import stages
from spanwright.llm.common import cut

STAGES = [
    ("language", stages.language),
    ("near_duplicates", stages.near_duplicate),
    ("decontamination", stages.decontamination),
    ("personal_data", stages.personal_data),
    ("packing", stages.packing),
]

#: The language model, the near-duplicate search and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to table documents, each to all that the one before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
