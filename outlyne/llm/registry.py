"""Queries of this folder and their SQL twins."""

from __future__ import annotations

from . import op1_jaccard_join, op2_language, op3_sharding, op4_language_model, op5_url_filter, op6_mixing, op7_toxicity, op8_fingerprints, op9_bpe, op10_exact_dedup, op11_license_scan, op12_fill_in_middle, op13_manifest

QUERIES = {
    "op1_jaccard_join": op1_jaccard_join.op1_jaccard_join,
    "op2_language": op2_language.op2_language,
    "op3_shard_documents": op3_sharding.op3_shard_documents,
    "op4_language_model": op4_language_model.op4_language_model,
    "op5_url_filter": op5_url_filter.op5_url_filter,
    "op6_mix_sources": op6_mixing.op6_mix_sources,
    "op7_toxicity": op7_toxicity.op7_toxicity,
    "op8_fingerprints": op8_fingerprints.op8_fingerprints,
    "op9_bpe_round_trip": op9_bpe.op9_bpe_round_trip,
    "op10_exact_dedup": op10_exact_dedup.op10_exact_dedup,
    "op11_license_scan": op11_license_scan.op11_license_scan,
    "op12_fill_in_middle": op12_fill_in_middle.op12_fill_in_middle,
    "op13_manifest": op13_manifest.op13_manifest,
}

ORACLES = {
    "op1_jaccard_join": op1_jaccard_join.ORACLE,
    "op3_shard_documents": op3_sharding.oracle(),
    "op6_mix_sources": op6_mixing.ORACLE,
    "op10_exact_dedup": op10_exact_dedup.ORACLE,
    "op12_fill_in_middle": op12_fill_in_middle.ORACLE,
    "op13_manifest": op13_manifest.ORACLE,
}
