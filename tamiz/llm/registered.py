"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from tamiz.llm import (
    clustering,
    compression,
    fingerprints,
    hard_negatives,
    jaccard_join,
    language_model,
    lines,
    mixing,
    packing,
    rules,
    shards,
    substrings,
    warc,
)

QUERIES = {
    f.__name__: f
    for f in (
        compression.op1_compression_quality,
        shards.op2_minimax_shards,
        substrings.op3_collection_bwt,
        mixing.op4_pareto_mix,
        lines.op5_winnowed_lines,
        rules.op6_rule_ledger,
        jaccard_join.op7_set_relation_join,
        packing.op8_minimum_bin_slack,
        fingerprints.op9_minhash_fingerprints,
        language_model.op10_log_frequency_filter,
        clustering.op11_ns_bounds,
        warc.op12_transaction_assembly,
        hard_negatives.op13_str_tree_negatives,
    )
}
CHECK_SQL = {
    "op4_pareto_mix": mixing.OP4_SQL,
    "op6_rule_ledger": rules.OP6_SQL,
    "op11_ns_bounds": clustering.OP11_SQL,
    "op12_transaction_assembly": warc.OP12_SQL,
    "op13_str_tree_negatives": hard_negatives.OP13_SQL,
}
