"""Queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from llm import ann, automata, collocations, katz, langid, licences, minhash, packing, suffixes, tandem, tiling, tokencounts, wrappers

QUERIES = {
    "op1_licences": licences.query,
    "op2_ann": ann.query,
    "op8_langid": langid.query,
    "op3_wrappers": wrappers.query,
    "op4_katz": katz.query,
    "op5_suffixes": suffixes.query,
    "op6_tiling": tiling.query,
    "op7_minhash": minhash.query,
    "op9_token_counts": tokencounts.query,
    "op10_pack": packing.query,
    "op11_collocations": collocations.query,
    "op12_bpe": automata.query,
    "op13_runs": tandem.query,
}

ORACLES: dict[str, str] = {
    "op1_licences": licences.oracle(),
    "op9_token_counts": tokencounts.ORACLE,
    "op11_collocations": collocations.oracle(),
}
