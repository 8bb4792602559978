"""The subpackage's named queries and their SQL twins."""

from __future__ import annotations

from tidemark.llm import (
    decontaminate,
    hard_negatives,
    jaccard,
    language,
    lexical,
    licenses,
    mixing,
    quality,
    revisits,
    secrets,
    simhash,
    token_files,
    toxicity,
)

QUERIES = {
    "op1_language_id": language.query,
    "op2_license_scan": licenses.query,
    "op3_ngram_jaccard": jaccard.query,
    "op4_mix_sources": mixing.query,
    "op5_decontaminate": decontaminate.query,
    "op6_revisits": revisits.query,
    "op7_quality_rules": quality.query,
    "op8_secret_scan": secrets.query,
    "op9_toxicity": toxicity.query,
    "op10_token_files": token_files.query,
    "op11_lexical_search": lexical.query,
    "op12_simhash": simhash.query,
    "op13_hard_negatives": hard_negatives.query,
}

ORACLE = {
    "op2_license_scan": licenses.SQL,
    "op3_ngram_jaccard": jaccard.SQL,
    "op4_mix_sources": mixing.SQL,
    "op5_decontaminate": decontaminate.SQL,
    "op6_revisits": revisits.SQL,
    "op11_lexical_search": lexical.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
