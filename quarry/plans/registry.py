"""Registry of named queries and their SQL oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables;
the oracle (when the question can be asked in SQL) is a DuckDB SQL string
over the same tables, with identical column names.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def load_all_plans() -> None:
    """Import every plan module so its queries register themselves."""
    from quarry.plans import basics, capacity, maintenance, matching, models, relational, retrieval, star, streams, text  # noqa: F401
