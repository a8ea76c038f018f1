"""The queries of this package: key -> (Spark query, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from snapstar.llm import (
    alignment, chat, class_model, decontaminate, jaccard, language, line_rules, periodic, pieces,
    quality, sharding, toxicity, warc,
)

ENTRIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_chat_formatting": (chat.op1_chat_formatting, chat.OP1_SQL),
    "op8_sharding": (sharding.op8_sharding, sharding.OP8_SQL),
    "op10_quality_rules": (line_rules.op10_quality_rules, line_rules.OP10_SQL),
    "op9_warc": (warc.op9_warc, warc.OP9_SQL),
    "op2_toxicity": (toxicity.op2_toxicity, None),
    "op7_quality_classifier": (quality.op7_quality_classifier, None),
    "op6_sentencepiece": (pieces.op6_sentencepiece, None),
    "op3_decontamination": (decontaminate.op3_decontamination, None),
    "op4_lm_scoring": (class_model.op4_lm_scoring, None),
    "op5_jaccard_join": (jaccard.op5_jaccard_join, jaccard.OP5_SQL),
    "op11_periodic_runs": (periodic.op11_periodic_runs, None),
    "op12_language_id": (language.op12_language_id, None),
    "op13_tokenizer_alignment": (alignment.op13_tokenizer_alignment, None),
}
