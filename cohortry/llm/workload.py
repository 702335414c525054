"""Registered queries of the text operators and their SQL."""

from __future__ import annotations

from . import (chat, decontamination, divergence, extraction, language, mixing, neardup, quality, repair, sharding,
               substrings, toxicity, urls)
from .common import read

QUERIES = {
    "op1_kd_sharding": lambda spark, d: sharding.op1(read(spark, d, "documents")),
    "op2_language": lambda spark, d: language.op2(read(spark, d, "documents")),
    "op3_suffix_array": lambda spark, d: extraction.op3(read(spark, d, "pages")),
    "op4_relative_lz": lambda spark, d: substrings.op4(read(spark, d, "documents")),
    "op5_odd_sketches": lambda spark, d: neardup.op5(read(spark, d, "documents")),
    "op6_chat": lambda spark, d: chat.op6(read(spark, d, "conversations")),
    "op7_toxicity": lambda spark, d: toxicity.op7(
        read(spark, d, "documents"), read(spark, d, "labels")),
    "op8_decontamination": lambda spark, d: decontamination.op8(
        read(spark, d, "documents"), read(spark, d, "benchmark")),
    "op9_quality_rules": lambda spark, d: quality.op9(read(spark, d, "documents")),
    "op10_mixing": lambda spark, d: mixing.op10(read(spark, d, "documents")),
    "op11_fp_tree": lambda spark, d: divergence.op11(read(spark, d, "documents")),
    "op12_dawg": lambda spark, d: repair.op12(read(spark, d, "conversations")),
    "op13_url_models": lambda spark, d: urls.op13(read(spark, d, "pages")),
}

ORACLES = {"op6_chat": chat.SQL, "op4_relative_lz": substrings.SQL, "op8_decontamination": decontamination.SQL, "op9_quality_rules": quality.SQL, "op10_mixing": mixing.SQL,
           "op12_dawg": lambda spark, d: repair.op12(read(spark, d, "conversations")),
    "op11_fp_tree": divergence.SQL, "op12_dawg": repair.SQL,
           "op13_url_models": urls.SQL}
