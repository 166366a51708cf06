"""The queries of this subpackage and, where SQL can express them, their DuckDB twins."""

from tidemark.llm import classifier, conversations, exact_dedup, harmonic, language, minhash, mixing, packing, quality, resampling, sharding, suffix_dedup, warc

QUERIES = {
    "op1_best_fit_packing": packing.op1,
    "op2_quality_rules": quality.op2,
    "op3_sharding": sharding.op3,
    "op4_suffix_dedup": suffix_dedup.op4,
    "op5_quality_classifier": classifier.op5,
    "op6_minhash_dedup": minhash.op6,
    "op7_exact_dedup": exact_dedup.op7,
    "op8_warc": warc.op8,
    "op9_language_id": language.op9,
    "op10_mixing": mixing.op10,
    "op11_importance_resampling": resampling.op11,
    "op12_harmonic_packing": harmonic.op12,
    "op13_conversation_repair": conversations.op13,
}

ORACLES = {
    "op7_exact_dedup": exact_dedup.OP7_SQL,
    "op8_warc": warc.OP8_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op11_importance_resampling": resampling.OP11_SQL,
    "op13_conversation_repair": conversations.OP13_SQL,
}
