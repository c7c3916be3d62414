"""Queries of the operators and their SQL."""

from __future__ import annotations

from hourgrid.llm import collocations, decontaminate, dialogue, exactdedup, iblt, jaccard, linededup, packing, quality, rans, suffixtree, toxicity, warc

QUERIES = {
    "op1_warc_normalize": warc.query,
    "op2_rans_tokens": rans.query,
    "op3_iblt_fingerprints": iblt.query,
    "op4_suffix_tree_lm": suffixtree.query,
    "op5_vector_packing": packing.query,
    "op6_nb_svm_quality": quality.query,
    "op8_decontamination": decontaminate.query,
    "op9_line_dedup": linededup.query,
}
QUERIES["op10_toxicity_cnn"] = toxicity.query
QUERIES["op7_ngram_jaccard"] = jaccard.query
QUERIES["op11_conversation_repair"] = dialogue.query
QUERIES["op12_exact_dedup"] = exactdedup.query
QUERIES["op13_collocations"] = collocations.query
ORACLE_SQL = {
    "op1_warc_normalize": warc.SQL, "op8_decontamination": decontaminate.SQL, "op9_line_dedup": linededup.SQL,
    "op12_exact_dedup": exactdedup.SQL, "op13_collocations": collocations.SQL,
}
