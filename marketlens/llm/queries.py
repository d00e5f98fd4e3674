"""Registered queries of this package and their SQL."""

from __future__ import annotations

from . import (
    archive,
    decontamination,
    divergence,
    fingerprints,
    importance,
    jaccard,
    langid,
    maxent,
    packing,
    pii,
    quality,
    sharding,
    threads,
)

QUERIES = {
    "op1_ngram_jaccard_join": jaccard.op1_ngram_jaccard_join,
    "op1_ngram_jaccard_links": jaccard.op1_ngram_jaccard_links,
    "op2_lpt_sharding": sharding.op2_lpt_sharding,
    "op3_quote_threads": threads.op3_quote_threads,
    "op4_kneser_ney_quality": quality.op4_kneser_ney_quality,
    "op5_vector_packing": packing.op5_vector_packing,
    "op6_winnowing_decontamination": decontamination.op6_winnowing_decontamination,
    "op7_maxent_lm": maxent.op7_maxent_lm,
    "op8_rank_order_langid": langid.op8_rank_order_langid,
    "op9_skipchain_crf_pii": pii.op9_skipchain_crf_pii,
    "op10_multiset_fingerprint": fingerprints.op10_multiset_fingerprint,
    "op11_importance_resampling": importance.op11_importance_resampling,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_warc_archive": archive.op13_warc_archive,
}

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": jaccard.ORACLE,
    "op1_ngram_jaccard_links": jaccard.LINKS_ORACLE,
    "op3_quote_threads": threads.ORACLE,
    "op6_winnowing_decontamination": decontamination.ORACLE,
    "op11_importance_resampling": importance.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
    "op13_warc_archive": archive.ORACLE,
}
