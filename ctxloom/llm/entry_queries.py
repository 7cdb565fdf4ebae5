"""The queries of this subpackage and the SQL that they must equal, for the driver's entry file."""

import corpus_pipeline

from . import bpe, divergence, gif, hard_negatives, html_text, licenses, mixing, near_dup, quality_model, quality_rules, secrets, suffix_dedup, toxicity

QUERIES = {
    f.__name__: f
    for f in (
        bpe.op1_byte_bpe,
        toxicity.op2_toxicity,
        quality_model.op3_weak_quality,
        secrets.op4_secret_scan,
        licenses.op5_license_scan,
        mixing.op6_source_mixing,
        quality_rules.op7_quality_rules,
        gif.op8_gif_media,
        near_dup.op9_minhash_near_dup,
        suffix_dedup.op10_suffix_dedup,
        divergence.op11_source_divergence,
        hard_negatives.op12_hard_negatives,
        html_text.op13_html_text,
    )
} | {"pipeline": corpus_pipeline.run}
ORACLES = {
    "op4_secret_scan": secrets.ORACLE,
    "op5_license_scan": licenses.ORACLE,
    "op7_quality_rules": quality_rules.ORACLE,
    "op9_minhash_near_dup": near_dup.ORACLE,
    "op10_suffix_dedup": suffix_dedup.ORACLE,
    "op11_source_divergence": divergence.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
