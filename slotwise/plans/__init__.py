"""Queries over the driver tables, one module per operator family."""

import importlib
import pkgutil

from slotwise.plans.bindings import Tables
from slotwise.plans.registry import QUERIES, SQL

for _module in sorted(m.name for m in pkgutil.iter_modules(__path__) if m.name.endswith("_queries")):
    importlib.import_module(f"{__name__}.{_module}")

__all__ = ["QUERIES", "SQL", "Tables"]
