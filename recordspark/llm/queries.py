"""The queries of this subpackage, one for each operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recordspark.llm.conversation_repair import op12_conversation_repair
from recordspark.llm.jaccard_join import op4_jaccard_join
from recordspark.llm.language_id import op10_language_id
from recordspark.llm.maxent_lm import op1_lm_score
from recordspark.llm.mixing import op6_mixing
from recordspark.llm.nearest import op7_nearest
from recordspark.llm.quality_model import op9_quality_model
from recordspark.llm.quality_rules import op5_quality_rules
from recordspark.llm.secret_scan import op3_secret_scan
from recordspark.llm.segmentation import op8_segmentation
from recordspark.llm.sharding import op11_sharding
from recordspark.llm.substring_dedup import op2_substring_dedup
from recordspark.llm.vector_codes import op13_vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": op1_lm_score,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_quality_rules": op5_quality_rules,
    "op6_mixing": op6_mixing,
    "op7_nearest": op7_nearest,
    "op8_segmentation": op8_segmentation,
    "op9_quality_model": op9_quality_model,
    "op10_language_id": op10_language_id,
    "op11_sharding": op11_sharding,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE_SQL: dict[str, str] = {}
