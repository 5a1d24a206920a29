"""Queries of the training-text operators, and their SQL."""

from __future__ import annotations

from . import bpe, decontaminate, infill, lm, neardup, pieces, pii, quality, secrets, sharding, tokenfile, toxicity, whitening

QUERIES = {
    "op1_token_file": tokenfile.op1_token_file,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_lm_score": lm.op3_lm_score,
    "op4_near_duplicates": neardup.op4_near_duplicates,
    "op5_personal_data": pii.op5_personal_data,
    "op6_shuffle_shards": sharding.op6_shuffle_shards,
    "op7_quality": quality.op7_quality,
    "op8_secrets": secrets.op8_secrets,
    "op9_bpe": bpe.op9_bpe,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_whitening": whitening.op11_whitening,
    "op12_fill_in_middle": infill.op12_fill_in_middle,
    "op13_sentencepiece": pieces.op13_sentencepiece,
}

SQL = {"op2_decontaminate": decontaminate.OP2_SQL}
