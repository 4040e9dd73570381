"""Import every catalog module and expose the registry."""

from __future__ import annotations

import functools

from ..session import prepare
from . import catalog, catalog_rules, catalog_streams  # noqa: F401  (registration side effects)
from .catalog import REGISTRY


def _prepared(fn):
    """Every builder runs on a prepared session (UTC zone, checkpoint folder),
    whatever session the caller brings."""
    @functools.wraps(fn)
    def run(spark, sf_dir):
        prepare(spark)
        return fn(spark, sf_dir)
    return run


def queries() -> dict:
    return {k: _prepared(fn) for k, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict:
    return {k: sql for k, (_, sql) in REGISTRY.items() if sql is not None}
