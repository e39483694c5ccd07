"""Queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.context_mixing import op10_context_mixing
from corpusloom.llm.decontaminate import op6_decontaminate
from corpusloom.llm.fuzzy_lines import op4_fuzzy_lines
from corpusloom.llm.langid import op5_language_id
from corpusloom.llm.mixing import OP3_SQL, op3_pareto_mix
from corpusloom.llm.pii import op2_pii_spans
from corpusloom.llm.progressive_jpeg import op1_progressive_jpeg
from corpusloom.llm.simhash import op9_simhash_components
from corpusloom.llm.sstable import op8_token_shards
from corpusloom.llm.suffix_dedup import op7_suffix_dedup


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_progressive_jpeg": op1_progressive_jpeg,
        "op2_pii_spans": op2_pii_spans,
        "op3_pareto_mix": op3_pareto_mix,
        "op4_fuzzy_lines": op4_fuzzy_lines,
        "op5_language_id": op5_language_id,
        "op6_decontaminate": op6_decontaminate,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_token_shards": op8_token_shards,
        "op9_simhash_components": op9_simhash_components,
        "op10_context_mixing": op10_context_mixing,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_pareto_mix": OP3_SQL}
