"""The text operators over whole tables, with production parameters, and their SQL."""

from __future__ import annotations

import corpus_pipeline
from graticule.llm import chat, collocations, exact, fertility, jaccard, mixing, packing, passages, secrets, setsketch, sharding, spelling, toxicity

QUERIES = {
    "op1_hilbert_shards": sharding.query,
    "op2_toxicity_chain": toxicity.query,
    "op3_pack": packing.query,
    "op4_exact_dedup": exact.query,
    "op5_fertility": fertility.query,
    "op6_linked_secrets": secrets.query,
    "op7_jaccard_components": jaccard.query,
    "op8_soft_mixing": mixing.query,
    "op9_prefix_examples": chat.query,
    "op10_shared_passages": passages.query,
    "op11_collocations": collocations.query,
    "op12_setsketch_components": setsketch.query,
    "op13_spelling_variants": spelling.query,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op4_exact_dedup": exact.SQL,
    "op9_prefix_examples": chat.SQL,
    "op11_collocations": collocations.SQL,
}
