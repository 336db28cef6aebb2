"""The registered queries of the text operators, with their DuckDB twins
where SQL can state them."""

from __future__ import annotations

import os

from flowtally.llm import (alignment, importance, language, licences, mixing, neighbours, packing, pii, repeats,
                           secrets, simhash, spotsigs, toxicity)
from flowtally.llm.common import table

TOKENIZER_FOLDER = "/opt/tokenizers"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A vocabulary file of the public tokenizers."""
    try:
        import public_tokenizers
    except ImportError:
        return os.path.join(TOKENIZER_FOLDER, name)
    return str(public_tokenizers.path(name))


def op1_secrets(spark, sf_dir):
    return secrets.secret_digests(table(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity_scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op3_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.predict_language(docs, language.fit(docs))


def op4_pii(spark, sf_dir):
    return pii.pseudonym_report(table(spark, sf_dir, "documents"))


def op5_simhash(spark, sf_dir):
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op6_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=4096)


def op7_licences(spark, sf_dir):
    return licences.licence_report(table(spark, sf_dir, "documents"))


def op8_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_neighbours(spark, sf_dir):
    return neighbours.search(table(spark, sf_dir, "embeddings"), k=5, query_every=50)


def op10_spotsigs(spark, sf_dir):
    return spotsigs.fingerprint_report(table(spark, sf_dir, "documents"))


def op11_alignment(spark, sf_dir):
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                           tokenizer_path("piece_bpe_32k.model"))


def op12_repeats(spark, sf_dir):
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


def op13_importance(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


LLM_QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_toxicity": op2_toxicity,
    "op3_language": op3_language,
    "op4_pii": op4_pii,
    "op5_simhash": op5_simhash,
    "op6_packing": op6_packing,
    "op7_licences": op7_licences,
    "op8_mixing": op8_mixing,
    "op9_neighbours": op9_neighbours,
    "op10_spotsigs": op10_spotsigs,
    "op11_alignment": op11_alignment,
    "op12_repeats": op12_repeats,
    "op13_importance": op13_importance,
}

LLM_ORACLE: dict[str, str] = {
    "op8_mixing": mixing.ORACLE_SQL,
}
