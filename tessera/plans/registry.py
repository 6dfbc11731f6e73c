"""Registry of named queries over the driver tables.

Each entry pairs a Spark query (spark, sf_dir) -> DataFrame with the ANSI
SQL a second engine runs over the same parquet tables (None when the
operator is iterative or otherwise not expressible in SQL).  Floating
outputs are rounded identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    # importing the modules registers their queries
    from . import (q_cluster, q_dense, q_linear, q_logistic, q_prepare,  # noqa: F401
                   q_recommend, q_relational, q_sequence, q_tree)
