"""The queries of this package and their SQL twins, by name."""

from quadrille.llm import bpe, decontamination, exact_dedup, html_text, licenses, near_dedup, sharding, token_counts, toxicity, url_filter

QUERIES = {
    "op1_bpe": bpe.op1_bpe,
    "op2_token_counts": token_counts.op2_token_counts,
    "op3_html_text": html_text.op3_html_text,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_license_scan": licenses.op6_license_scan,
    "op7_url_filter": url_filter.op7_url_filter,
    "op8_sharding": sharding.op8_sharding,
    "op9_decontamination": decontamination.op9_decontamination,
    "op10_near_dedup": near_dedup.op10_near_dedup,
}

SQL = {
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op6_license_scan": licenses.OP6_SQL,
    "op7_url_filter": url_filter.OP7_SQL,
    "op8_sharding": sharding.OP8_SQL,
}
