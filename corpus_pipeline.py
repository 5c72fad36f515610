"""The corpus pipeline: quality, line dedup, near duplicates, decontamination, packing.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a
DataFrame; ``run`` writes each result as Parquet below ``spark.checkpoint.dir`` and
reads it again as the next stage's documents.

1. quality classifier: documents that score below the threshold go.
2. line dedup: lines that are not blank and occur earlier go, equal (any length) or near by their length (see NEAR_CHARS, below
   which one edit makes another line, as "2018" and "2019"); a document that loses all its lines goes,
   ``n_chars`` of a shortened one is its new length.
3. n-gram Jaccard join (five-word shingles, similarity 0.8 or more): of each group the document that names it (the smallest id) stays;
   repeated rows count as copies; where all ids of a group are null, its rows of equal text become one.
4. benchmark decontamination: contaminated documents go.
5. packing: the token pieces of the documents that stayed.

Null and empty texts pass stages 1 to 4 (they repeat nothing) and become the closing id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelearn.llm.common import Scratch, read_table
from tablelearn.llm.decontaminate import contaminated, decontaminate
from tablelearn.llm.line_dedup import dedup_lines
from tablelearn.llm.ngram_join import ngram_components
from tablelearn.llm.packing import pack
from tablelearn.llm.queries import LABEL_FOLD, THRESHOLD
from tablelearn.llm.quality import fit, score


NEAR_CHARS, DOUBLE_FROM = 32, 64  # lines of 32 to 63 characters may differ in one edit, of 64 to 127 in two, and so on with each doubling
SHINGLE, NUM, DEN = 5, 80, 100  # near duplicates share NUM/DEN or more of their SHINGLE-word shingles


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(LABEL_FOLD)) != 0))
    return score(docs, model, out="_score").where(F.col("_score") >= THRESHOLD).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = dedup_lines(docs, out="_dropped", min_chars=NEAR_CHARS, copy_chars=1, double_from=DOUBLE_FROM)
    emptied = (F.size("_dropped") > 0) & (F.col("text") == "")
    chars = F.when(F.size("_dropped") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return left.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", chars).select(*docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = ngram_components(docs, k=SHINGLE, num=NUM, den=DEN)
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_th")).distinct()
    row = F.col("row")
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("th"), F.col("doc_id").alias("id"))
    return (rows.join(kept, F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left_semi")
            .dropDuplicates(["id", "th"]).select(*(row[c].alias(c) for c in docs.columns)))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = decontaminate(docs, read_table(spark, sf_dir, "benchmark"), out="_judged")
    return judged.where(~contaminated("_judged")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("quality classifier", quality), ("line dedup", line_dedup), ("n-gram Jaccard join", ngram_join),
          ("benchmark decontamination", decontamination), ("packing", packing)]

ORACLE_SQL = None  # the classifier and the tokenizer are beyond SQL; tests hold the rows that stages 1 to 4 keep against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    with Scratch(spark, "pipeline") as before:
        for _, stage in STAGES[:-2]:
            docs = before.save(stage(spark, docs, sf_dir))
        docs = before.save(STAGES[-2][1](spark, docs, sf_dir), keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
