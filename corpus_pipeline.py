"""The corpus pipeline: documents through five of the training-data operators.

quality classifier -> exact dedup -> SimHash near-dedup -> benchmark
decontamination -> SentencePiece encoding and decoding.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the
stage before it kept.  All but the last return the columns of ``documents``.
Nulls, empty texts, repeated rows and extra columns are handled as the stage's
operator defines; an empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.llm import decontam, exact_dedup, quality, simhash, sp_codec
from gridlens.llm.common import documents, keep_rows, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id."""
    kept = exact_dedup.exact_dedup(*exact_dedup.arrivals(docs)).where("kept")
    return keep_rows(docs, kept.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the least id."""
    groups = simhash.near_duplicates(docs)
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("_id"), F.col("sha").alias("_sha"))
    return keep_rows(docs, groups.groupBy("component_id").agg(F.min(first).alias("k")).select("k._id", "k._sha"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item of the benchmark in them."""
    return decontam.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and whether the ids decode to the text."""
    out = sp_codec.encoded(docs)
    return out.withColumns(
        {"n_tokens": F.size("ids").cast("long"), "round_trip": F.col("decoded") == F.coalesce("text", F.lit(""))}
    ).drop("decoded")


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

# SQL can express neither the classifier nor the fingerprints; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
