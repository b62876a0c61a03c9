"""The registered queries of this subpackage."""

from __future__ import annotations

from cif_lake.llm import bpe, decontaminate, hard_negatives, language, language_model, mixing, periodic, quality_classifier, quality_rules, secrets, sharding, simhash, toxicity

QUERIES = {
    "op1_decontaminate": decontaminate.op1,
    "op2_quality_rules": quality_rules.op2,
    "op3_byte_bpe": bpe.op3,
    "op4_simhash": simhash.op4,
    "op5_language": language.op5,
    "op6_toxicity": toxicity.op6,
    "op7_language_model": language_model.op7,
    "op8_sharding": sharding.op8,
    "op9_secrets": secrets.op9,
    "op10_quality_classifier": quality_classifier.op10,
    "op11_mixing": mixing.op11,
    "op12_hard_negatives": hard_negatives.op12,
    "op13_periodic_runs": periodic.op13,
}
#: The others can't be told in SQL: trained models, byte-pair merges, transitive closures, places of matches, hashes DuckDB lacks.
ORACLES = {"op1_decontaminate": decontaminate.OP1_SQL, "op12_hard_negatives": hard_negatives.OP12_SQL}
