"""A training corpus from ``documents``: stages that each read what the one before has kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns rows with the columns of ``docs``; the last returns pieces.
``labels`` serves to train the quality stage. What nulls, empty texts and repeated rows give is said at the operators.
"""

import public_tokenizers

from newslake.llm import exact, packing, pii, quality, simhash
from newslake.llm.common import table
from newslake.llm.queries import pseudonym_key
from newslake.session import prepare, scratch_path


def quality_rules(spark, docs, sf_dir):
    """Documents that fail the base rules or whose lines are mostly boilerplate go."""
    field = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, field)


def exact_dedup(spark, docs, sf_dir):
    """One document of each group with the same text but for white space stays."""
    return exact.keep_one(docs)


def simhash_near_dedup(spark, docs, sf_dir):
    """One document of each component of near-duplicates stays."""
    return simhash.keep_one(docs)


def pii_pseudonyms(spark, docs, sf_dir):
    """Personal values become pseudonyms; all documents stay."""
    return pii.pseudonymise_documents(docs, pseudonym_key(spark), length_col="n_chars")


def pack_sequences(spark, docs, sf_dir):
    """Token ids in pieces of power-of-two length."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", simhash_near_dedup),
    ("pii", pii_pseudonyms),
    ("packing", pack_sequences),
]

# SQL has neither the field's Viterbi decoding nor XXH64, Feistel networks and BPE; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages on ``documents``; what goes from one to the next is written to the shared folder and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
