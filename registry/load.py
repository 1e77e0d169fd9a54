"""Imports every module that registers queries."""

import importlib
import pkgutil

import registry

for _module in sorted(m.name for m in pkgutil.iter_modules(registry.__path__)):
    if _module != "load":
        importlib.import_module(f"registry.{_module}")
