"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from rosterlake.llm import (
    decontamination,
    manifest,
    mixing,
    quality,
    rules,
    secrets,
    simhash,
    spelling,
    substrings,
    suffixes,
    token_counts,
    token_files,
    toxicity,
)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_token_counts": token_counts.op2_token_counts,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_substrings": substrings.op4_substrings,
    "op5_decontamination": decontamination.op5_decontamination,
    "op6_quality": quality.op6_quality,
    "op7_rules": rules.op7_rules,
    "op8_token_files": token_files.op8_token_files,
    "op9_secrets": secrets.op9_secrets,
    "op10_simhash": simhash.op10_simhash,
    "op11_manifest": manifest.op11_manifest,
    "op12_suffixes": suffixes.op12_suffixes,
    "op13_spelling": spelling.op13_spelling,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_mixing": mixing.ORACLE,
    "op4_substrings": substrings.ORACLE,
    "op5_decontamination": decontamination.ORACLE,
    "op7_rules": rules.ORACLE,
    "op11_manifest": manifest.ORACLE,
    "op13_spelling": spelling.ORACLE,
} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
