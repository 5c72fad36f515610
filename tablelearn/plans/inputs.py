"""Derived inputs shared by the registered queries, in both engines.

Each input is a Spark function and the SQL text of the same relation, so a
query and its oracle start from identical rows.  Doubles are scaled by
constants to order 1; keys are the unique keys of each table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .registry import dbl

EMB_DIM = 64


def part_points(spark: SparkSession, d: str) -> DataFrame:
    """p_partkey, x1 = p_size/50, x2 = (p_retailprice-900)/100, ±1 labels."""
    p = read_table(spark, d, "part")
    x1 = F.col("p_size") / F.lit(50.0)
    x2 = (F.col("p_retailprice") - F.lit(900.0)) / F.lit(100.0)
    return p.select(
        "p_partkey", x1.alias("x1"), x2.alias("x2"),
        F.when(F.col("p_size") >= 26, F.lit(1)).otherwise(F.lit(-1)).alias("y_sep"),
        F.when(F.col("p_type").isin("LARGE", "PROMO", "SMALL"), F.lit(1)).otherwise(F.lit(-1)).alias("y_mix"),
    )


PART_POINTS_SQL = f"""
SELECT p_partkey,
       p_size / {dbl(50.0)} AS x1,
       (p_retailprice - {dbl(900.0)}) / {dbl(100.0)} AS x2,
       CASE WHEN p_size >= 26 THEN 1 ELSE -1 END AS y_sep,
       CASE WHEN p_type IN ('LARGE', 'PROMO', 'SMALL') THEN 1 ELSE -1 END AS y_mix
FROM part"""


def docs_labeled(spark: SparkSession, d: str) -> DataFrame:
    """labels ⋈ documents with categorical and numeric features."""
    docs = read_table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = read_table(spark, d, "labels")
    j = lab.join(docs, "doc_id")
    n = F.col("n_chars")
    return j.select(
        "doc_id", "quality", "toxic", "lang", "source",
        F.when(n < 1000, F.lit("short")).when(n < 3000, F.lit("medium")).otherwise(F.lit("long")).alias("len_bucket"),
        (F.log(F.col("n_chars").cast("double") + F.lit(1.0)) / F.lit(10.0)).alias("x_len"),
        F.when(F.col("lang") == "en", F.lit(1.0)).otherwise(F.lit(0.0)).alias("x_en"),
    )


DOCS_LABELED_SQL = f"""
SELECT l.doc_id, l.quality, l.toxic, d.lang, d.source,
       CASE WHEN d.n_chars < 1000 THEN 'short' WHEN d.n_chars < 3000 THEN 'medium' ELSE 'long' END AS len_bucket,
       ln(CAST(d.n_chars AS DOUBLE) + {dbl(1.0)}) / {dbl(10.0)} AS x_len,
       CASE WHEN d.lang = 'en' THEN {dbl(1.0)} ELSE {dbl(0.0)} END AS x_en
FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""


def embeddings(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "embeddings")
    return e.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))


EMBEDDINGS_SQL = "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"


def customer_cats(spark: SparkSession, d: str) -> DataFrame:
    """customer with categorical features: nation key and balance band."""
    c = read_table(spark, d, "customer")
    bal = F.col("c_acctbal")
    return c.select(
        "c_custkey", "c_mktsegment",
        F.col("c_nationkey").cast("string").alias("nation"),
        F.when(bal < 0, F.lit("negative")).when(bal < 5000, F.lit("low")).otherwise(F.lit("high")).alias("balance"),
    )


CUSTOMER_CATS_SQL = """
SELECT c_custkey, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS nation,
       CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS balance
FROM customer"""


def cte(**parts: str) -> str:
    """WITH a AS MATERIALIZED (...), b AS MATERIALIZED (...)"""
    return "WITH " + ",\n".join(f"{k} AS MATERIALIZED ({v})" for k, v in parts.items())
