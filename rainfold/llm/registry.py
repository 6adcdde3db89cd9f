"""The queries of this subpackage and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rainfold.llm.chat import OP3_SQL, op3_chat
from rainfold.llm.clusters import OP13_SQL, op13_clusters
from rainfold.llm.decontamination import op1_decontamination
from rainfold.llm.licenses import op6_licenses
from rainfold.llm.mixing import OP12_SQL, op12_mixing
from rainfold.llm.packing import op2_packing
from rainfold.llm.phrases import OP10_SQL, op10_phrases
from rainfold.llm.quality_model import op5_quality_model
from rainfold.llm.quality_rules import op8_quality_rules
from rainfold.llm.secrets import op7_secrets
from rainfold.llm.simhash import op4_simhash
from rainfold.llm.suffixes import op9_suffixes
from rainfold.llm.turns import op11_turns

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_packing": op2_packing,
    "op3_chat": op3_chat,
    "op4_simhash": op4_simhash,
    "op5_quality_model": op5_quality_model,
    "op6_licenses": op6_licenses,
    "op7_secrets": op7_secrets,
    "op8_quality_rules": op8_quality_rules,
    "op9_suffixes": op9_suffixes,
    "op10_phrases": op10_phrases,
    "op11_turns": op11_turns,
    "op12_mixing": op12_mixing,
    "op13_clusters": op13_clusters,
}

ORACLE_SQL: dict[str, str] = {"op3_chat": OP3_SQL, "op10_phrases": OP10_SQL, "op12_mixing": OP12_SQL, "op13_clusters": OP13_SQL}
