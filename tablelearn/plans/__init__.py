"""Named queries over the driver tables (Spark) and their DuckDB SQL."""

from . import dist_queries, model_queries, prep_queries, sequence_queries, source_queries  # noqa: F401  (registers queries)
from .registry import QUERIES, SQL, sql_text

__all__ = ["QUERIES", "SQL", "sql_text"]
