"""The operators' queries over whole tables, and check SQL where SQL expresses them."""

from __future__ import annotations

from . import (licenses, line_dedup, mixing, neighbours, ngram_join, packing, phrases, quality, sharding, simhash, topk, toxicity,
               tries)

QUERIES = {f.__name__: f for f in (
    quality.op1_quality,
    line_dedup.op2_line_dedup,
    sharding.op3_feistel_shards,
    toxicity.op4_toxicity,
    neighbours.op5_projected_neighbours,
    simhash.op6_simhash_groups,
    packing.op7_packed_sequences,
    mixing.op8_mixed_sources,
    topk.op9_exact_top_products,
    licenses.op10_license_notices,
    tries.op11_prefix_trie,
    phrases.op12_phrases,
    ngram_join.op13_ngram_components,
)}

CHECKS = {
    "op2_line_dedup": line_dedup.op2_sql(),
    "op3_feistel_shards": sharding.op3_sql(),
    "op8_mixed_sources": mixing.op8_sql(),
    "op9_exact_top_products": topk.op9_sql(),
    "op11_prefix_trie": tries.op11_sql(),
    "op12_phrases": phrases.op12_sql(),
    "op13_ngram_components": ngram_join.op13_sql(),
}
