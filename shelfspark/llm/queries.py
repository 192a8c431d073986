"""The queries of this subpackage, by the names the driver knows, and their SQL where SQL can say it."""

from __future__ import annotations

from shelfspark.llm import (
    bpe,
    conv_repair,
    decontam,
    exact_dups,
    kd_shards,
    kneser_ney,
    langid,
    line_dedup,
    simhash_dups,
    spelling,
    suffix_dedup,
    tool_chat,
    topk,
)

QUERIES = {
    "op1_language_id": langid.query,
    "op2_line_dedup": line_dedup.query,
    "op3_benchmark_decontamination": decontam.query,
    "op4_bpe_round_trip": bpe.query,
    "op5_kd_sharding": kd_shards.query,
    "op6_suffix_array_dedup": suffix_dedup.query,
    "op7_exact_top_k": topk.query,
    "op8_kneser_ney": kneser_ney.query,
    "op9_simhash_near_dedup": simhash_dups.query,
    "op10_tool_call_chat": tool_chat.query,
    "op11_conversation_repair": conv_repair.query,
    "op12_exact_dedup": exact_dups.query,
    "op13_spelling_variants": spelling.query,
}

ORACLE: dict[str, str] = {
    "op2_line_dedup": line_dedup.SQL,
    "op7_exact_top_k": topk.SQL,
    "op12_exact_dedup": exact_dups.SQL,
}
