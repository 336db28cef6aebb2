"""The corpus pipeline: documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and reread as the next one's documents.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from flowtally.llm import mixing, packing, pii, simhash, toxicity
from flowtally.llm.common import store, table
from flowtally.llm.queries import tokenizer_path


def drop_toxic(spark, docs, sf_dir):
    """Documents that score as toxic go; every other row stays as it is."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_near_copies(spark, docs, sf_dir):
    """Of every group of near copies the document of the smallest id stays."""
    return simhash.one_per_component(docs, shingle=3, max_bits=3)


def hide_personal_data(spark, docs, sf_dir):
    """Personal values give way to pseudonyms; n_chars follows the text."""
    return pii.pseudonymised_documents(docs)


def mix_sources(spark, docs, sf_dir):
    """Every document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark, docs, sf_dir):
    """The pieces of the documents with their sequence and offset."""
    return packing.pack(docs, tokenizer_path(), capacity=4096)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("pii", hide_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Scores, fingerprints, pseudonyms and tokens are beyond SQL: tests compare
# the stages with plain Python instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages over ``documents``, each one's result written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
