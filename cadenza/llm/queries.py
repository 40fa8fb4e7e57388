"""The registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from . import decontaminate, mixing, pieces, prefix_trie, secrets, simhash, substring_dedup, token_records, topk, toxicity, url_filter, warc, whitening

QUERIES = {
    "op1_token_records": token_records.op1_token_records,
    "op2_mixing": mixing.op2_mixing,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_simhash": simhash.op4_simhash,
    "op5_secrets": secrets.op5_secrets,
    "op6_warc": warc.op6_warc,
    "op7_topk": topk.op7_topk,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_url_filter": url_filter.op9_url_filter,
    "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    "op11_sentencepiece": pieces.op11_sentencepiece,
    "op12_whitening": whitening.op12_whitening,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

ORACLE_SQL = {
    "op6_warc": warc.OP6_SQL,
    "op7_topk": topk.OP7_SQL,
    "op10_substring_dedup": substring_dedup.OP10_SQL,
    "op13_prefix_trie": prefix_trie.OP13_SQL,
}
