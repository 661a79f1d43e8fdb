"""Registry of the training-data queries: name -> builder, name -> DuckDB SQL."""

from __future__ import annotations

import importlib

from panelspark.llm.common import prepare

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
_MODULES = ["q_tables", "q_texts", "q_units"]


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with its SQL if SQL can say it."""
    def deco(fn):
        def run(spark, sf_dir):
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"panelspark.llm.{m}")


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLE)
