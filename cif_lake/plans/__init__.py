"""Queries over corpora that Spark derives from tables."""

from __future__ import annotations

import importlib

MODULES = ["scans", "relational", "structural", "editing", "dictionaries"]


def load():
    """All registered queries and their SQL."""
    for name in MODULES:
        importlib.import_module(f"cif_lake.plans.{name}")
    from cif_lake.plans.registry import ORACLES, QUERIES

    return dict(QUERIES), dict(ORACLES)
