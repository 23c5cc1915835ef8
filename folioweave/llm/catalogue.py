"""Queries and SQL of the thirteen operators and the pipeline."""

from __future__ import annotations

import importlib

import corpus_pipeline

MODULES = ("piece_lattice gear_chunks line_windows token_store decontaminate interpolated_lm sharding "
           "quality vector_lsh chosen_path divergence secret_scan block_max").split()

QUERIES: dict = {"pipeline": corpus_pipeline.run}
ORACLES: dict[str, str] = {}
for _name in MODULES:
    _module = importlib.import_module(f"folioweave.llm.{_name}")
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
