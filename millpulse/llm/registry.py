"""All queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from millpulse.llm import (
    block_anchors,
    burst_trie,
    byte_cnn,
    chat_collapse,
    lexical_packing,
    line_dedup,
    pii_labels,
    quality_rules,
    ranked_search,
    simhash_dedup,
    soft_mixing,
    vector_tree,
    warc_fixity,
)

_MODULES = (
    line_dedup, warc_fixity, quality_rules, lexical_packing, soft_mixing, vector_tree, pii_labels, simhash_dedup,
    byte_cnn, chat_collapse, burst_trie, ranked_search, block_anchors,
)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
