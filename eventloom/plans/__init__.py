"""Named queries over the tables of a data folder, by kind of work."""

from importlib import import_module
from pkgutil import iter_modules

from eventloom.plans.registry import ORACLES, QUERIES

for _module in iter_modules(__path__):
    import_module(f"{__name__}.{_module.name}")

__all__ = ["ORACLES", "QUERIES"]
