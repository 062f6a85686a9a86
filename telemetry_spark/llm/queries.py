"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from telemetry_spark.llm import (
    bpe,
    clustering,
    embedding_dedup,
    exact_dedup,
    langid,
    near_dedup,
    packing,
    permutation_index,
    pii,
    sharding,
    token_counts,
    url_filter,
    whitening,
)

QUERIES = {
    "op1_bpe": bpe.op1_bpe,
    "op2_language_id": langid.op2_language_id,
    "op3_personal_data": pii.op3_personal_data,
    "op4_near_dedup": near_dedup.op4_near_dedup,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_url_filter": url_filter.op6_url_filter,
    "op7_embedding_dedup": embedding_dedup.op7_embedding_dedup,
    "op8_minimax_shards": sharding.op8_minimax_shards,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_harmonic_packing": packing.op10_harmonic_packing,
    "op11_permutation_index": permutation_index.op11_permutation_index,
    "op12_sharded_lloyd": clustering.op12_sharded_lloyd,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE_SQL = {
    "op6_url_filter": url_filter.oracle(),
    "op9_exact_dedup": exact_dedup.ORACLE,
    "op12_sharded_lloyd": clustering.oracle(),
}
