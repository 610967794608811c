"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faultsift.llm.chat import OP9_SQL, op9_chat
from faultsift.llm.exact import OP11_SQL, op11_exact_dedup
from faultsift.llm.extract import op3_html
from faultsift.llm.leaks import op8_decontamination
from faultsift.llm.linedup import OP1_SQL, op1_line_dedup
from faultsift.llm.lm import op5_lm_scoring
from faultsift.llm.mixture import op6_mixing
from faultsift.llm.quality import OP10_SQL, op10_quality
from faultsift.llm.repair import OP13_SQL, op13_repair
from faultsift.llm.runs import op12_runs
from faultsift.llm.simhash import op2_simhash
from faultsift.llm.tokens import op4_tokens
from faultsift.llm.toxicity import op7_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_simhash": op2_simhash,
    "op3_html": op3_html,
    "op4_tokens": op4_tokens,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_mixing": op6_mixing,
    "op7_toxicity": op7_toxicity,
    "op8_decontamination": op8_decontamination,
    "op9_chat": op9_chat,
    "op10_quality": op10_quality,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_runs": op12_runs,
    "op13_repair": op13_repair,
}

SQL: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op9_chat": OP9_SQL,
    "op10_quality": OP10_SQL,
    "op11_exact_dedup": OP11_SQL,
    "op13_repair": OP13_SQL,
}
