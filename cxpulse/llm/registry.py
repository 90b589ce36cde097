"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from cxpulse.llm import exact_dedup, fingerprints, html_text, infill, licenses, minhash, mixing, packing, repeats, toxicity, url_rules, vafile, whitening

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_remove_repeats": repeats.op3_remove_repeats,
    "op4_url_rules": url_rules.op4_url_rules,
    "op5_html_text": html_text.op5_html_text,
    "op6_near_duplicates": minhash.op6_near_duplicates,
    "op7_pack": packing.op7_pack,
    "op8_vafile_topk": vafile.op8_vafile_topk,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_whiten_embeddings": whitening.op11_whiten_embeddings,
    "op12_infill": infill.op12_infill,
    "op13_fingerprints": fingerprints.op13_fingerprints,
}

ORACLES = {
    "op1_license_scan": licenses.SQL,
    "op2_mix_sources": mixing.SQL,
    "op3_remove_repeats": repeats.SQL,
    "op6_near_duplicates": minhash.SQL,
    "op8_vafile_topk": vafile.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
    "op12_infill": infill.SQL,
}
