"""Queries of this subpackage by name, and the DuckDB SQL of those that SQL can express."""

from strikelake.llm import (bagminhash, decontaminate, divergence, fim, fixity, langid, licenses, mixing, pqindex, quality,
                            secrets, substrings, tokencounts)
from strikelake.llm.shipping import shipped

QUERIES = {
    "op1_crf_quality": quality.op1_crf_quality,
    "op2_merkle_fixity": fixity.op2_merkle_fixity,
    "op3_recompression_dedup": substrings.op3_recompression_dedup,
    "op4_offset_token_counts": tokencounts.op4_offset_token_counts,
    "op5_randomness_secrets": secrets.op5_randomness_secrets,
    "op6_prefix_decontaminate": decontaminate.op6_prefix_decontaminate,
    "op7_pq_near_duplicates": pqindex.op7_pq_near_duplicates,
    "op8_license_join": licenses.op8_license_join,
    "op9_bagminhash_duplicates": bagminhash.op9_bagminhash_duplicates,
    "op10_sainte_lague_mix": mixing.op10_sainte_lague_mix,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_fill_in_middle": fim.op12_fill_in_middle,
    "op13_kernel_langid": langid.op13_kernel_langid,
}
QUERIES = {name: shipped(run) for name, run in QUERIES.items()}

ORACLE_SQL = {
    "op2_merkle_fixity": fixity.SQL,
    "op3_recompression_dedup": substrings.SQL,
    "op6_prefix_decontaminate": decontaminate.SQL,
    "op8_license_join": licenses.SQL,
    "op10_sainte_lague_mix": mixing.SQL,
    "op11_source_divergence": divergence.SQL,
    "op12_fill_in_middle": fim.SQL,
}
