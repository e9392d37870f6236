"""Queries of the training-data operators and their DuckDB SQL where SQL can express them."""

from . import collocations, ctw, decontam, filteraudit, kdshard, licenses, media, mixing, ngramjoin, quality, simhash, toxicity, warc

QUERIES = {
    "op1_toxicity": toxicity.query,
    "op2_warc_segments": warc.query,
    "op3_license_rules": licenses.query,
    "op4_progressive_jpeg": media.query,
    "op5_context_tree": ctw.query,
    "op6_kd_shards": kdshard.query,
    "op7_quality": quality.query,
    "op8_decontamination": decontam.query,
    "op9_source_mix": mixing.query,
    "op10_ngram_join": ngramjoin.query,
    "op11_simhash": simhash.query,
    "op12_filter_audit": filteraudit.query,
    "op13_collocations": collocations.query,
}

ORACLE_SQL = {
    "op2_warc_segments": warc.ORACLE,
    "op8_decontamination": decontam.ORACLE.replace("{documents}", "documents"),
    "op9_source_mix": mixing.ORACLE.replace("{documents}", "documents"),
    "op10_ngram_join": ngramjoin.ORACLE.replace("{documents}", "documents"),
    "op12_filter_audit": filteraudit.ORACLE.replace("{documents}", "documents"),
    "op13_collocations": collocations.ORACLE.replace("{documents}", "documents"),
}
