"""Registry of named queries over the driver tables, each with its DuckDB SQL.

A query is ``fn(spark, data_dir) -> DataFrame``; its SQL (a string, or a
callable returning one) computes the same rows in DuckDB over views named
after the tables.  Queries without SQL get a rows-only check plus pytest goldens.
"""

from __future__ import annotations

from typing import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, object] = {}


def query(name: str, sql=None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def sql_text(name: str) -> str:
    s = SQL[name]
    return s() if callable(s) else s


def dbl(x: float) -> str:
    """A DOUBLE literal for DuckDB (plain decimals there are DECIMAL)."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def rnd(expr: str, places: int = 4) -> str:
    """Rounded value; a result of zero is always +0.0 (never -0.0)."""
    r = f"round({expr}, {places})"
    return f"(CASE WHEN {r} = 0 THEN {dbl(0.0)} ELSE {r} END)"


def r4(c, places: int = 4):
    """Spark side of ``rnd``: round, and turn -0.0 into +0.0 so both engines agree."""
    from pyspark.sql import functions as F

    col = F.col(c) if isinstance(c, str) else c
    r = F.round(col, places)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)
