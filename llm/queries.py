"""The queries of this subpackage and their DuckDB SQL, by name."""

from __future__ import annotations

from llm import avi_mjpeg, decontamination, line_dedup, near_dedup, pii, sentencepiece_unigram, sharding, token_counts, toxicity, url_filter

QUERIES = {
    "op1_minhash_near_dedup": near_dedup.op1_minhash_near_dedup,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_url_filters": url_filter.op4_url_filters,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_sharding": sharding.op6_sharding,
    "op7_media_columns": avi_mjpeg.op7_media_columns,
    "op8_pii": pii.op8_pii,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_sentencepiece": sentencepiece_unigram.op10_sentencepiece,
}

ORACLE: dict[str, str] = {
    "op1_minhash_near_dedup": near_dedup.OP1_SQL,
    "op2_line_dedup": line_dedup.OP2_SQL,
    "op4_url_filters": url_filter.OP4_SQL,
}
