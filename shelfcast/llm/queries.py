"""The registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from shelfcast.llm import (
    embedding_dups,
    hard_negatives,
    hash_shards,
    maxent_lm,
    mixing,
    near_dups,
    robust_rules,
    sentence_pieces,
    token_files,
    toxicity,
    url_filter,
    va_search,
    whitening,
)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_token_files": token_files.op2_token_files,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_near_dups": near_dups.op4_near_dups,
    "op5_sentence_pieces": sentence_pieces.op5_sentence_pieces,
    "op6_maxent_lm": maxent_lm.op6_maxent_lm,
    "op7_hash_shards": hash_shards.op7_hash_shards,
    "op8_va_search": va_search.op8_va_search,
    "op9_robust_rules": robust_rules.op9_robust_rules,
    "op10_source_mix": mixing.op10_source_mix,
    "op11_whitening": whitening.op11_whitening,
    "op12_embedding_dups": embedding_dups.op12_embedding_dups,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}
ORACLES = {
    "op7_hash_shards": hash_shards.OP7_SQL,
    "op8_va_search": va_search.OP8_SQL,
    "op10_source_mix": mixing.OP10_SQL,
    "op12_embedding_dups": embedding_dups.OP12_SQL,
    "op13_hard_negatives": hard_negatives.OP13_SQL,
}
