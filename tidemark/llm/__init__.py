"""Operators of training-data pipelines, and the queries that apply them to whole tables.

Nothing else in the library imports this package. QUERIES holds functions `name(spark, sf_dir)`, SQL the texts that
some of them are checked against.
"""

from tidemark.llm import bpe, linededup, mixing, multiset, phrases, pii, quality, repair, repetition, simhash, spelling, template, warc

QUERIES = {
    "op1_line_dedup": linededup.op1_line_dedup,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_repetition": repetition.op3_repetition,
    "op4_fingerprint": multiset.op4_fingerprint,
    "op5_simhash": simhash.op5_simhash,
    "op6_pii": pii.op6_pii,
    "op7_extract": template.op7_extract,
    "op8_byte_bpe": bpe.op8_byte_bpe,
    "op9_warc": warc.op9_warc,
    "op10_quality": quality.op10_quality,
    "op11_phrases": phrases.op11_phrases,
    "op12_spelling": spelling.op12_spelling,
    "op13_token_files": repair.op13_token_files,
}
SQL = {
    "op1_line_dedup": linededup.OP1_SQL,
    "op2_mix_sources": mixing.OP2_SQL,
    "op9_warc": warc.OP9_SQL,
    "op11_phrases": phrases.OP11_SQL,
    "op12_spelling": spelling.OP12_SQL,
}
