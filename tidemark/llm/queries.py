"""Registered queries of this subpackage: each module's ``QUERIES`` and ``ORACLES``."""

from tidemark.llm import (op10_order, op11_suffix, op12_divergence, op13_fim, op1_jaccard, op2_html, op3_quality, op4_substring, op5_packing, op6_urls,
                          op7_decontaminate, op8_preference, op9_rules)

_MODULES = [op1_jaccard, op2_html, op3_quality, op4_substring, op5_packing, op6_urls, op7_decontaminate, op8_preference, op9_rules, op10_order, op11_suffix, op12_divergence, op13_fim]


def queries() -> dict:
    return {name: build for m in _MODULES for name, build in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
