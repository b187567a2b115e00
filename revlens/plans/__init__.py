"""Registered queries (one per operator of the inventory) and their SQL oracles."""

from __future__ import annotations

import importlib

_MODULES = ("q_profile", "q_text", "q_corpus", "q_eval", "q_models")


def load_all():
    for m in _MODULES:
        importlib.import_module(f"revlens.plans.{m}")
    from revlens.plans.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
