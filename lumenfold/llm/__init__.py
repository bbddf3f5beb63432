"""Operators for training-data pipelines, one module each, and the queries that apply them to the standard tables."""

from importlib import import_module

MODULES = ["op1_language", "op2_quality", "op3_mixing", "op4_sharding", "op5_chat", "op6_neardup", "op7_decontaminate", "op8_tokens", "op9_substrings", "op10_pii",
           "op11_negatives", "op12_spelling", "op13_bpe"]


def load_all():
    """(queries, oracle SQL) of every module."""
    queries, oracles = {}, {}
    for name in MODULES:
        module = import_module(f"lumenfold.llm.{name}")
        queries.update(module.QUERIES)
        oracles.update(getattr(module, "ORACLES", {}))
    return queries, oracles
