"""Queries of the operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

from . import ann, bpe, curve, fim, minhash, neardup_vectors, oracles, packing, periodic, quality, secrets, substring, token_store, toxicity

QUERIES = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_quality": quality.op2_quality,
    "op3_substring": substring.op3_substring,
    "op4_bpe": bpe.op4_bpe,
    "op5_packing": packing.op5_packing,
    "op6_vector_dedup": neardup_vectors.op6_vector_dedup,
    "op7_ann": ann.op7_ann,
    "op8_minhash": minhash.op8_minhash,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_token_store": token_store.op10_token_store,
    "op11_fim": fim.op11_fim,
    "op12_curve_packing": curve.op12_curve_packing,
    "op13_periodic": periodic.op13_periodic,
}
ORACLES: dict[str, str] = oracles.ORACLES
