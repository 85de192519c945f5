"""The registered queries of this package, and their oracle SQL where SQL can express them."""

from __future__ import annotations

import importlib

MODULES = [
    "op1_html",
    "op2_lines",
    "op3_bpe",
    "op4_hmm",
    "op5_decontaminate",
    "op6_simhash",
    "op7_language",
    "op8_toxicity",
    "op9_embeddings",
    "op10_substrings",
    "op11_search",
    "op12_mix",
    "op13_collocations",
]

QUERIES: dict = {}
ORACLES: dict = {}
for _name in MODULES:
    _module = importlib.import_module(f"llm.{_name}")
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)
