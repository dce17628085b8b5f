"""Queries of the operators in this subpackage, and their DuckDB SQL."""

from __future__ import annotations

from nbsieve.llm import (chat, decontaminate, exact_dedup, filter_audit, langid, near_dedup, packing,
                         ppm, quality, sharding, suffix_dedup, toxicity, vector_codes)
from nbsieve.llm.common import table


def _docs(fn):
    return lambda spark, sf: fn(table(spark, sf, "documents"))


QUERIES = {
    "op1_near_dedup": _docs(near_dedup.op1_near_dedup),
    "op2_suffix_dedup": _docs(suffix_dedup.op2_suffix_dedup),
    "op3_toxicity": lambda spark, sf: toxicity.op3_toxicity(
        table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op4_chat_format": lambda spark, sf: chat.op4_chat_format(table(spark, sf, "conversations")),
    "op5_quality_rules": _docs(quality.op5_quality_rules),
    "op6_language_id": _docs(langid.op6_language_id),
    "op7_ppm": _docs(ppm.op7_ppm),
    "op8_packing": _docs(packing.op8_packing),
    "op9_byte_shards": _docs(sharding.op9_byte_shards),
    "op10_decontamination": lambda spark, sf: decontaminate.op10_decontamination(
        table(spark, sf, "documents"), table(spark, sf, "benchmark")),
    "op11_filter_audit": lambda spark, sf: filter_audit.op11_filter_audit(
        table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op12_vector_codes": lambda spark, sf: vector_codes.op12_vector_codes(
        table(spark, sf, "embeddings")),
    "op13_exact_dedup": _docs(exact_dedup.op13_exact_dedup),
}

ORACLE = {
    "op1_near_dedup": near_dedup.ORACLE,
    "op4_chat_format": chat.ORACLE,
    "op5_quality_rules": quality.ORACLE,
    "op10_decontamination": decontaminate.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op12_vector_codes": vector_codes.ORACLE,
    "op13_exact_dedup": exact_dedup.ORACLE,
}
