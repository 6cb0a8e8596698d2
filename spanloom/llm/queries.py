"""The registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm import decontamination
from spanloom.llm.ann import op8_multi_index_hashing
from spanloom.llm.decontamination import op2_decontamination
from spanloom.llm.language import op4_language
from spanloom.llm.lm import op10_suffix_tree
from spanloom.llm.materialise import op5_materialise
from spanloom.llm.neardup import op6_near_duplicates
from spanloom.llm.pii import op3_pii
from spanloom.llm.pieces import op9_sentencepiece
from spanloom.llm.secrets import op1_secrets
from spanloom.llm.toxicity import op7_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_decontamination": op2_decontamination,
    "op3_pii": op3_pii,
    "op4_language": op4_language,
    "op5_materialise": op5_materialise,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_toxicity": op7_toxicity,
    "op8_multi_index_hashing": op8_multi_index_hashing,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_suffix_tree": op10_suffix_tree,
}

ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": decontamination.ORACLE_SQL,
}
