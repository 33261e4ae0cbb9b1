"""A corpus pipeline of training-data operators over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillmill.llm.bpe import stage_bpe
from quillmill.llm.common import materialise
from quillmill.llm.decontaminate import stage_decontaminate
from quillmill.llm.neardup import stage_neardup
from quillmill.llm.secrets import stage_secrets
from quillmill.llm.toxicity import stage_toxicity

#: (name, function of (spark, docs, sf_dir)) in order.
STAGES = [
    ("toxicity", stage_toxicity),
    ("near_duplicates", stage_neardup),
    ("decontamination", stage_decontaminate),
    ("secrets", stage_secrets),
    ("bpe", stage_bpe),
]

#: Trained models and tokenisation have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialise(docs)
    return docs
