"""Queries of this subpackage, by name."""

from __future__ import annotations

from . import bpe_codec, chat_format, decontaminate, near_duplicates, oracles, personal_data, quality_classifier, quality_rules, repeated_passages, token_counts, toxicity


def queries() -> dict:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_quality_rules": quality_rules.op2_quality_rules,
        "op3_token_counts": token_counts.op3_token_counts,
        "op4_bpe_codec": bpe_codec.op4_bpe_codec,
        "op5_chat_format": chat_format.op5_chat_format,
        "op6_quality_classifier": quality_classifier.op6_quality_classifier,
        "op7_personal_data": personal_data.op7_personal_data,
        "op8_decontaminate": decontaminate.op8_decontaminate,
        "op9_near_duplicates": near_duplicates.op9_near_duplicates,
        "op10_repeated_passages": repeated_passages.op10_repeated_passages,
    }


def oracle_sql() -> dict:
    return oracles.ORACLES
