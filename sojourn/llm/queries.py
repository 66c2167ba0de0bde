"""Every operator of this package as a named query over whole tables, and the SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import divergence_audit, mixing, near_dedup, ngram, packing, pieces, quality_model, quality_rules, sharding, substrings, toxicity, vantage, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_elias_fano_bigrams": ngram.op1_elias_fano_bigrams,
    "op2_nnls_packing": packing.op2_nnls_packing,
    "op3_hilbert_shards": sharding.op3_hilbert_shards,
    "op4_poisson_mix": mixing.op4_poisson_mix,
    "op5_attention_quality": quality_model.op5_attention_quality,
    "op6_divergence_rules": quality_rules.op6_divergence_rules,
    "op7_vantage_trees": vantage.op7_vantage_trees,
    "op8_subword_toxicity": toxicity.op8_subword_toxicity,
    "op9_suffix_trees": substrings.op9_suffix_trees,
    "op10_lsh_forest": near_dedup.op10_lsh_forest,
    "op11_piece_agenda": pieces.op11_piece_agenda,
    "op12_gustavson_audit": divergence_audit.op12_gustavson_audit,
    "op13_householder_whitening": whitening.op13_householder_whitening,
}


def statements() -> dict[str, str]:
    return {"op4_poisson_mix": mixing.oracle(), "op6_divergence_rules": quality_rules.oracle(), "op12_gustavson_audit": divergence_audit.oracle()}
