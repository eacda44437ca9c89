"""The operators' queries and, where SQL can express one, its equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontamination,
    filter_audit,
    license_scan,
    line_dedup,
    mixing,
    near_duplicates,
    pitman_yor,
    quality_rules,
    sharding,
    spelling_variants,
    suffix_dedup,
    tool_calls,
    weak_labels,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": decontamination.op1_decontamination,
        "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
        "op3_mixing": mixing.op3_mixing,
        "op4_line_dedup": line_dedup.op4_line_dedup,
        "op5_sharding": sharding.op5_sharding,
        "op6_minhash": near_duplicates.op6_minhash,
        "op7_tool_calls": tool_calls.op7_tool_calls,
        "op8_pitman_yor": pitman_yor.op8_pitman_yor,
        "op9_quality_classifier": weak_labels.op9_quality_classifier,
        "op10_quality_rules": quality_rules.op10_quality_rules,
        "op11_spelling_variants": spelling_variants.op11_spelling_variants,
        "op12_license_scan": license_scan.op12_license_scan,
        "op13_filter_audit": filter_audit.op13_filter_audit,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": decontamination.SQL,
        "op3_mixing": mixing.SQL,
        "op4_line_dedup": line_dedup.SQL,
        "op5_sharding": sharding.SQL,
        "op7_tool_calls": tool_calls.SQL,
        "op10_quality_rules": quality_rules.SQL,
        "op11_spelling_variants": spelling_variants.SQL,
        "op12_license_scan": license_scan.SQL,
        "op13_filter_audit": filter_audit.SQL,
    }
