"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from . import (
    alignment,
    bpe,
    chat_format,
    decontaminate,
    hard_negatives,
    language_id,
    minhash,
    quality_classifier,
    quality_rules,
    secrets,
    suffix_dedup,
    url_rules,
    warc,
)

QUERIES = {
    "op1_url_rules": url_rules.query,
    "op2_bpe": bpe.query,
    "op3_warc": warc.query,
    "op4_quality_rules": quality_rules.query,
    "op5_language_id": language_id.query,
    "op6_chat_format": chat_format.query,
    "op7_secrets": secrets.query,
    "op8_near_duplicates": minhash.query,
    "op9_decontamination": decontaminate.query,
    "op10_suffix_dedup": suffix_dedup.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_alignment": alignment.query,
    "op13_quality_classifier": quality_classifier.query,
}
ORACLES = {
    "op3_warc": warc.SQL,
    "op4_quality_rules": quality_rules.SQL,
    "op6_chat_format": chat_format.SQL,
    "op8_near_duplicates": minhash.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
}
