"""Imports every operator module, which registers its query; see ``registry``."""

from __future__ import annotations

from revlens.llm import (  # noqa: F401
    covertree,
    html,
    katz,
    language,
    licenses,
    lines,
    mixing,
    nearjoin,
    nndescent,
    packing,
    periodic,
    reversed_search,
    sharding,
)
from revlens.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
