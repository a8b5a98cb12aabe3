"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import importlib
import pkgutil

import docsift.llm as package


def _modules():
    for info in pkgutil.iter_modules(package.__path__):
        if info.name.startswith("op"):
            yield importlib.import_module(f"docsift.llm.{info.name}")


def queries():
    return {name: function for module in _modules() for name, function in module.QUERIES.items()}


def oracle_sql():
    return {name: text for module in _modules() for name, text in getattr(module, "ORACLES", {}).items()}
