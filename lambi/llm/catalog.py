"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from lambi.llm import decontaminate, idstore, licenses, merkle, minhash, mixing, packing, quality, spelling, substrings, suffix_tree_lm, urls, vectors

QUERIES = {
    "op1_near_vectors": vectors.query,
    "op2_near_documents": minhash.query,
    "op3_token_store": idstore.query,
    "op4_repetition": quality.query,
    "op5_repeated_substrings": substrings.query,
    "op6_source_mixing": mixing.query,
    "op7_suffix_tree_scores": suffix_tree_lm.query,
    "op8_packed_sequences": packing.query,
    "op9_license_scan": licenses.query,
    "op10_url_verdicts": urls.query,
    "op11_spelling_variants": spelling.query,
    "op12_benchmark_passages": decontaminate.query,
    "op13_merkle_manifest": merkle.query,
}
ORACLES = {
    "op4_repetition": quality.ORACLE,
    "op6_source_mixing": mixing.ORACLE,
    "op9_license_scan": licenses.ORACLE,
    "op11_spelling_variants": spelling.ORACLE,
    "op12_benchmark_passages": decontaminate.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}

