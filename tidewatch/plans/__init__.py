"""Canned queries: compositions of the operators over the given tables."""

from __future__ import annotations

import importlib
import pkgutil


def load():
    """Import every module of this package and return its queries and their SQL."""
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
    from tidewatch.plans.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
