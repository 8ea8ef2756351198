"""The library's queries over the driver's tables."""

from __future__ import annotations

import importlib
from typing import NamedTuple

MODULES = ("tables", "similarity", "texts", "evaluation", "learning")


class Registered(NamedTuple):
    queries: dict
    oracles: dict


def registered() -> Registered:
    """All queries, after importing every module that registers some."""
    from marlstone.workload import registry

    for module in MODULES:
        importlib.import_module(f"marlstone.workload.{module}")
    return Registered(registry.QUERIES, registry.ORACLES)
