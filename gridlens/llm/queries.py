"""The registered queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

from gridlens.llm import (
    decontam,
    exact_dedup,
    jaccard_join,
    licenses,
    mlm,
    quality,
    ranked_search,
    sharding,
    simhash,
    sp_codec,
    suffix_dedup,
    token_fst,
    whitening,
)
from gridlens.llm.common import documents

QUERIES = {
    "op1_suffix_dedup": lambda spark, d: suffix_dedup.query(documents(spark, d)),
    "op2_quality": lambda spark, d: quality.query(documents(spark, d), spark.read.parquet(f"{d.rstrip('/')}/labels.parquet")),
    "op3_decontamination": lambda spark, d: decontam.query(documents(spark, d), spark.read.parquet(f"{d.rstrip('/')}/benchmark.parquet")),
    "op4_simhash_near_dedup": lambda spark, d: simhash.query(documents(spark, d)),
    "op5_exact_dedup": lambda spark, d: exact_dedup.query(documents(spark, d)),
    "op6_license_scan": lambda spark, d: licenses.query(documents(spark, d)),
    "op7_pseudo_likelihood": lambda spark, d: mlm.query(documents(spark, d)),
    "op8_token_counts": lambda spark, d: token_fst.query(documents(spark, d)),
    "op9_uniform_shards": lambda spark, d: sharding.query(documents(spark, d)),
    "op10_sentencepiece": lambda spark, d: sp_codec.query(documents(spark, d)),
    "op11_whitening": lambda spark, d: whitening.query(spark.read.parquet(f"{d.rstrip('/')}/embeddings.parquet")),
    "op12_ranked_search": lambda spark, d: ranked_search.query(documents(spark, d), spark.read.parquet(f"{d.rstrip('/')}/benchmark.parquet")),
    "op13_jaccard_join": lambda spark, d: jaccard_join.query(documents(spark, d)),
}

ORACLE_SQL = {
    "op5_exact_dedup": exact_dedup.SQL,
    "op12_ranked_search": ranked_search.SQL,
}
