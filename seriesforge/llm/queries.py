"""Registered queries of the training-data operators and their SQL checks."""

from __future__ import annotations

from seriesforge.llm import centroids, chat, compression, dualtree, fingerprints, jaccard, lines, mixing, packing, pages, rules, secrets, superminhash

QUERIES = {
    "op1_secret_scan": secrets.query,
    "op2_imatch_fingerprint": fingerprints.query,
    "op3_compression_quality": compression.query,
    "op4_line_dedup": lines.query,
    "op5_mix_sources": mixing.query,
    "op6_quality_rules": rules.query,
    "op7_pack_retrieval": packing.query,
    "op8_chat_format": chat.query,
    "op9_jaccard_join": jaccard.query,
    "op10_page_text": pages.query,
    "op11_superminhash_groups": superminhash.query,
    "op12_dual_tree_search": dualtree.query,
    "op13_mean_variance_clusters": centroids.query,
}

#: Where SQL can express the result; the others are held against brute force in tests/llm.
SQL = {
    "op5_mix_sources": mixing.SQL,
    "op8_chat_format": chat.SQL,
    "op9_jaccard_join": jaccard.SQL,
    "op11_superminhash_groups": superminhash.SQL,
    "op12_dual_tree_search": dualtree.SQL,
    "op13_mean_variance_clusters": centroids.SQL,
}
