"""The queries of this subpackage and their SQL, for the entry module."""

from __future__ import annotations

from collections.abc import Callable

from quire.llm import bpe, decontamination, divergence, hard_negatives, license_scan, minhash, ngram_jaccard, pieces, secret_scan, sharding, substring_dedup, suffix_dedup, toxicity
from quire.sources.shipping import shipped


def queries() -> dict[str, Callable]:
    ops = (toxicity.op1_toxicity, decontamination.op2_decontamination, suffix_dedup.op3_suffix_array_dedup, substring_dedup.op4_substring_dedup, ngram_jaccard.op5_ngram_jaccard, sharding.op6_sharding, minhash.op7_minhash, minhash.minhash_near_duplicates, license_scan.op8_license_scan, secret_scan.op9_secret_scan, bpe.op10_bpe, divergence.op11_divergence, pieces.op12_sentencepiece, hard_negatives.op13_hard_negatives)
    return {f.__name__: shipped(f) for f in ops}


def oracle_sql() -> dict[str, str]:
    return {"op8_license_scan": license_scan.oracle(), "op11_divergence": divergence.oracle(), "op13_hard_negatives": hard_negatives.oracle()}
