"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

The first four stages keep the columns of ``documents``; the last returns the encoded texts. No stage
but the secret scan could be stated in SQL, so ``ORACLE_SQL`` is None; tests/llm holds each stage
against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from constella.llm.bpe import stage_bpe
from constella.llm.common import staged, table
from constella.llm.decontaminate import stage_decontaminate
from constella.llm.language import stage_language
from constella.llm.near import stage_near_duplicates
from constella.llm.secrets import stage_secrets

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language", stage_language),
    ("near_duplicates", stage_near_duplicates),
    ("decontaminate", stage_decontaminate),
    ("secrets", stage_secrets),
    ("bpe", stage_bpe),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, every earlier stage staged in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
