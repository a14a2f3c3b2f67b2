"""Registered queries and their SQL oracles."""

from __future__ import annotations

import importlib
import pkgutil


def load_all() -> None:
    """Import every query module of this package, which registers its queries."""
    for module in pkgutil.iter_modules(__path__):
        if module.name.endswith("_queries"):
            importlib.import_module(f"{__name__}.{module.name}")
