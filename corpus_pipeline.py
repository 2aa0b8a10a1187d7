"""The corpus pipeline: documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept;
``run`` writes each result as Parquet below the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinepulse.llm import exact_dedup, near_dedup, packing, pii, quality
from cinepulse.llm.common import documents, small_side, staged


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score of at least 0.7)."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.with_score(spark, docs, model, score_col="__quality")
    return scored.filter(F.col("__quality") >= quality.THRESHOLD).select(*docs.columns) if model else docs


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the largest id."""
    return exact_dedup.drop_copies(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the smallest id."""
    found = near_dedup.near_duplicates(spark, docs).filter("not kept").select("doc_id")
    return docs.join(small_side(staged(spark, found, "near-copies")), "doc_id", "left_anti").select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text."""
    return pii.masked(spark, docs, pii.fit()).withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1,024 tokens."""
    return packing.pack(spark, docs)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]
#: Learned scores, hashes of shingles and token ids are not expressible in SQL; the
#: tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
