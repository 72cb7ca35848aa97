"""The registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from loomline.llm import divergence, embedding_dedup, line_quality, media, minhash_dedup, mixing, packing, pii, secrets, substring_index, suffix_dedup, toxicity, vector_codes

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_mix": mixing.op2_mix,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_substring_index": substring_index.op4_substring_index,
    "op5_media": media.op5_media,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_minhash_dedup": minhash_dedup.op7_minhash_dedup,
    "op8_pack": packing.op8_pack,
    "op9_embedding_dedup": embedding_dedup.op9_embedding_dedup,
    "op10_secrets": secrets.op10_secrets,
    "op11_divergence": divergence.op11_divergence,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_line_quality": line_quality.op13_line_quality,
}
ORACLES = {
    "op2_mix": mixing.OP2_SQL,
    "op3_suffix_dedup": suffix_dedup.OP3_SQL,
    "op4_substring_index": substring_index.OP4_SQL,
    "op7_minhash_dedup": minhash_dedup.OP7_SQL,
    "op9_embedding_dedup": embedding_dedup.OP9_SQL,
    "op10_secrets": secrets.OP10_SQL,
    "op11_divergence": divergence.OP11_SQL,
    "op12_vector_codes": vector_codes.OP12_SQL,
}
