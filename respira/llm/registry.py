"""Queries of the subpackage with their SQL (None where SQL cannot express them)."""

from __future__ import annotations

from importlib import import_module

# query -> module that holds it
QUERIES = {
    "op1_license_scan": "license_scan",
    "op2_minhash_dedup": "minhash_dedup",
    "op3_secret_scan": "secret_scan",
    "op4_url_filter": "url_filter",
    "op5_source_mixing": "source_mixing",
    "op6_language_id": "language_id",
    "op7_vector_search": "vector_search",
    "op8_quality_model": "quality_model",
    "op9_packing": "packing",
    "op10_quality_rules": "quality_rules",
    "op11_merkle_manifest": "merkle_manifest",
    "op12_ngram_join": "ngram_join",
    "op13_collocations": "collocations",
}


def load() -> dict[str, tuple]:
    """``name -> (spark query, SQL or None)``."""
    out = {}
    for name, module in QUERIES.items():
        m = import_module(f"respira.llm.{module}")
        out[name] = (getattr(m, name), getattr(m, "SQL", None))
    return out
