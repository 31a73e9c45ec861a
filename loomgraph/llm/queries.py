"""Queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomgraph.llm import mixing
from loomgraph.llm.embedding_dedup import op7_embedding_dedup
from loomgraph.llm.fingerprints import op4_fingerprints
from loomgraph.llm.language_id import op6_language_id
from loomgraph.llm.lm_scoring import op8_lm_scoring
from loomgraph.llm.near_dedup import op2_minhash_dedup
from loomgraph.llm.packing import op1_packing
from loomgraph.llm.pii import op5_pii
from loomgraph.llm.suffix_dedup import op9_suffix_dedup
from loomgraph.llm.window_dedup import op10_window_dedup


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query for each of the ten operators, over its whole table."""
    every = (op1_packing, op2_minhash_dedup, mixing.op3_mixing, op4_fingerprints, op5_pii, op6_language_id, op7_embedding_dedup, op8_lm_scoring, op9_suffix_dedup, op10_window_dedup)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": mixing.ORACLE}
