"""The registered queries of the text operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from constella.llm.bpe import op1_bpe
from constella.llm.centroids import OP12_SQL, op12_centroids
from constella.llm.chat import OP4_SQL, op4_chat
from constella.llm.decontaminate import OP7_SQL, op7_decontaminate
from constella.llm.language import op3_language
from constella.llm.near import op6_near_duplicates
from constella.llm.quality import op2_quality
from constella.llm.repair import OP11_SQL, op11_repair
from constella.llm.rules import OP10_SQL, op10_quality_rules
from constella.llm.secrets import OP8_SQL, op8_secrets
from constella.llm.shards import op9_shards
from constella.llm.topk import OP13_SQL, op13_top_products
from constella.llm.toxicity import op5_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_quality": op2_quality,
    "op3_language": op3_language,
    "op4_chat": op4_chat,
    "op5_toxicity": op5_toxicity,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_decontaminate": op7_decontaminate,
    "op8_secrets": op8_secrets,
    "op9_shards": op9_shards,
    "op10_quality_rules": op10_quality_rules,
    "op11_repair": op11_repair,
    "op12_centroids": op12_centroids,
    "op13_top_products": op13_top_products,
}

ORACLE: dict[str, str] = {
    "op4_chat": OP4_SQL,
    "op7_decontaminate": OP7_SQL,
    "op8_secrets": OP8_SQL,
    "op10_quality_rules": OP10_SQL,
    "op11_repair": OP11_SQL,
    "op12_centroids": OP12_SQL,
    "op13_top_products": OP13_SQL,
}
