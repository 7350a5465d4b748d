"""The registered queries of the numbered operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from tessera.llm import ann, bpe, chat, html, jaccard, mixing, packing, pii, quality, runs, tokenfiles, trie, urls

QUERIES = {
    "op1_mixing": mixing.query,
    "op2_quality": quality.query,
    "op3_pii": pii.query,
    "op4_chat": chat.query,
    "op5_bpe": bpe.query,
    "op6_html": html.query,
    "op7_urls": urls.query,
    "op8_ann": ann.query,
    "op9_tokenfiles": tokenfiles.query,
    "op10_jaccard": jaccard.query,
    "op11_trie": trie.query,
    "op12_runs": runs.query,
    "op13_packing": packing.query,
}
ORACLE_SQL: dict[str, str] = {
    "op4_chat": chat.SQL,
    "op7_urls": urls.SQL,
    "op11_trie": trie.SQL,
}
