"""Registered queries of the training-data operators and their SQL twins (none where SQL cannot express the operator)."""

from __future__ import annotations

from llm import ann, bpe, fingerprint, langid, mixing, near_dup, pii, quality, runs, sharding, spelling, urls, warc

QUERIES = {
    "op1_mix": mixing.op1_mix,
    "op2_byte_bpe": bpe.op2_byte_bpe,
    "op3_pii": pii.op3_pii,
    "op4_fingerprints": fingerprint.op4_fingerprints,
    "op5_language_id": langid.op5_language_id,
    "op6_warc": warc.op6_warc,
    "op7_quality": quality.op7_quality,
    "op8_multi_index": ann.op8_multi_index,
    "op9_url_templates": urls.op9_url_templates,
    "op10_minhash_near_dup": near_dup.op10_minhash_near_dup,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_sharding": sharding.op12_sharding,
    "op13_periodic_runs": runs.op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op1_mix": mixing.ORACLE_SQL,
    "op6_warc": warc.ORACLE_SQL,
    "op11_spelling_variants": spelling.ORACLE_SQL,
    "op12_sharding": sharding.ORACLE_SQL,
}
