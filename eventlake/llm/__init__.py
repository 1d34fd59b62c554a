"""Operators for training-data pipelines, their queries and oracles."""

from eventlake.llm import (
    bpe,
    centroid_clustering,
    chat_format,
    decontamination,
    kneser_ney,
    near_dedup,
    prefix_join,
    quality_rules,
    recurrent_lm,
    site_tree,
    suffix_dedup,
    token_alignment,
    warc_archive,
)

QUERIES = {
    "op1_warc_archive": warc_archive.query,
    "op2_suffix_dedup": suffix_dedup.query,
    "op3_recurrent_lm": recurrent_lm.query,
    "op4_decontamination": decontamination.query,
    "op5_chat_format": chat_format.query,
    "op6_bpe": bpe.query,
    "op7_kneser_ney": kneser_ney.query,
    "op8_site_tree": site_tree.query,
    "op9_near_dedup": near_dedup.query,
    "op10_quality_rules": quality_rules.query,
    "op11_prefix_join": prefix_join.query,
    "op12_token_alignment": token_alignment.query,
    "op13_centroid_clustering": centroid_clustering.query,
}

ORACLES = {
    "op1_warc_archive": warc_archive.ORACLE,
    "op4_decontamination": decontamination.ORACLE,
    "op5_chat_format": chat_format.ORACLE,
    "op9_near_dedup": near_dedup.ORACLE,
    "op10_quality_rules": quality_rules.ORACLE,
    "op11_prefix_join": prefix_join.ORACLE,
    "op13_centroid_clustering": centroid_clustering.ORACLE,
}
