"""The corpus pipeline: language ID, near-duplicates, decontamination, personal data, segmentation.

Each stage reads what the one before kept, as a stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obsweave.llm import decontam, langid, neardup, pieces, pii
from obsweave.session import work_path

STAGES = [
    ("language_id", langid.stage),
    ("near_duplicates", neardup.stage),
    ("decontamination", decontam.stage),
    ("personal_data", pii.stage),
    ("segmentation", pieces.stage),
]
#: Trained models decide in several stages, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet in the work folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
