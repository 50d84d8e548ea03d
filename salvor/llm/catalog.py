"""Registered queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from salvor.llm import dedup, infill, langid, minhash, mixing, packing, pii, quality, search, tokens, tokenstore, trie, warc

QUERIES = {
    "op1_mixing": mixing.query,
    "op2_token_counts": tokens.query,
    "op3_exact_topk": search.query,
    "op4_personal_data": pii.query,
    "op5_near_duplicates": minhash.query,
    "op6_quality": quality.query,
    "op7_language": langid.query,
    "op8_exact_duplicates": dedup.query,
    "op9_packing": packing.query,
    "op10_warc": warc.query,
    "op11_prefix_trie": trie.query,
    "op12_token_store": tokenstore.query,
    "op13_fill_in_middle": infill.query,
}

# Without a statement, and tested against brute force, the tokenizers or held-out labels instead:
# op2, op9 and op12 (tokenizers), op4 (trained spans), op5 (components), op6 and op7 (trained models).
ORACLES = {
    "op1_mixing": mixing.SQL,
    "op3_exact_topk": search.SQL,
    "op8_exact_duplicates": dedup.SQL,
    "op10_warc": warc.SQL,
    "op11_prefix_trie": trie.SQL,
    "op13_fill_in_middle": infill.SQL,
}
