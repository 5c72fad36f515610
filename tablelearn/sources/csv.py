"""CSV scans.

Three forms: header + inferred types, the same through ``format("csv")``, and
header with every column a string (categorical tables).  Inference costs one
extra pass over the file; pass ``schema=`` on large inputs to skip it.  A UTF-8
byte-order mark before the header is dropped by Spark's reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             sep: str = ",") -> DataFrame:
    """Header line, typed columns (inferred unless a schema is given)."""
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def read_csv_format(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """The generic ``format("csv").load`` route with inferred types."""
    return (spark.read.format("csv").option("header", "true").option("inferSchema", "true")
            .option("sep", sep).load(path))


def read_csv_strings(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Header line, every column a string (no inference pass)."""
    return spark.read.option("header", True).option("sep", sep).csv(path)
