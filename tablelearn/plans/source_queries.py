"""Registered queries: the CSV scans (§2.1).

Each query writes a driver table as CSV (header line) into the shared
scratch folder and scans it back with one of the three readers, so the scan
itself is what is checked: inferred types, the ``format("csv")`` route, and
all-string columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import read_csv, read_csv_format, read_csv_strings
from ..sources.tables import read_table
from .registry import query


def _as_csv(spark, df, name: str) -> str:
    path = scratch_path(spark, f"csv-{name}")
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


@query("src_csv_infer", """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part""")
def src_csv_infer(spark, d):
    path = _as_csv(spark, read_table(spark, d, "part"), "part")
    return read_csv(spark, path)


@query("src_csv_format", """
SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey,
       CAST(l_suppkey AS INTEGER) AS l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, CAST(l_shipdate AS TIMESTAMP) AS l_shipdate
FROM lineitem""")
def src_csv_format(spark, d):
    out = read_csv_format(spark, _as_csv(spark, read_table(spark, d, "lineitem"), "lineitem"))
    return out.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))  # the table's own type, without a zone


@query("src_csv_string", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer""")
def src_csv_string(spark, d):
    return read_csv_strings(spark, _as_csv(spark, read_table(spark, d, "customer"), "customer"))
