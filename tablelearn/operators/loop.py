"""Shared driver loop for iterative fits.

Each iteration is one aggregation job over a persisted projection of the
input, with the current model folded into the plan as literals; only
model-sized numbers come back.  Plans therefore stay flat: iteration i never
builds on iteration i-1's DataFrame, so lineage does not grow with the loop.
If an executor is lost, the persisted blocks are rebuilt from the short
lineage (scan + projection).
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def numeric_base(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Projection used by a fit: kept columns + features as doubles, complete rows only."""
    cols = [F.col(c) for c in keep] + [F.col(c).cast("double").alias(c) for c in features]
    out = df.select(*cols)
    cond = None
    for c in list(features) + list(keep):
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return out.where(cond) if cond is not None else out


def history_df(spark, rows: list[dict], schema: str) -> DataFrame:
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
