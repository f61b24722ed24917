"""The driver queries of this package."""

from omoplate.llm import (exact_dedup, merkle, multi_index, packing, periodic, prefix_counts, secrets, simhash, superkmer,
                          token_files, toxicity, url_filter, word_table)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_secrets": secrets.op2_secrets,
    "op3_token_files": token_files.op3_token_files,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_bpe": word_table.op5_bpe,
    "op6_packing": packing.op6_packing,
    "op7_neighbours": multi_index.op7_neighbours,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_substring_dedup": superkmer.op9_substring_dedup,
    "op10_simhash": simhash.op10_simhash,
    "op11_token_counts": prefix_counts.op11_token_counts,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_periodic_runs": periodic.op13_periodic_runs,
}
ORACLE_SQL = {
    **exact_dedup.ORACLE_SQL,
    **url_filter.ORACLE_SQL,
    **merkle.ORACLE_SQL,
    **periodic.ORACLE_SQL,
}
