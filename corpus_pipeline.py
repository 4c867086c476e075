"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes all that the one before kept, written as Parquet and read again. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import bounded_batches, documents, drop_table, kept_as_table, table
from tidemark.llm.exact_dedup import without_copies
from tidemark.llm.mixing import mix
from tidemark.llm.packing import pack
from tidemark.llm.simhash import RADIUS, without_near_copies
from tidemark.llm.toxicity import without_toxic
from tidemark.llm.vocabulary import tokenizer_path

#: The mix takes this share of the tokens that are left, and no document twice.
MIX_SHARE, MIX_EPOCHS = 0.8, 1


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    The classifier is fitted on the labelled documents of its own input. Null and empty texts are scored as one
    empty word; with labels of one kind or none all documents have the same score. Repeated rows stay as often as
    they are there.
    """
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays.

    Null is equal to empty; a null id loses to any other; of rows of the id that stays, one.
    """
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest doc_id.

    Near copies are found by their SimHash fingerprints, through deletion variants as in ``op5_simhash``; texts that
    are alike by their shingles, but further apart than its radius, are linked by an exact index and join the groups.
    Texts without a word are alike; a null id loses to any other; of rows of the id that stays, one.
    """
    with bounded_batches(spark):
        return without_near_copies(docs, radius=RADIUS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each leaf of domain, language and source gives what its budget allows.

    Null languages and sources are leaves of their own; texts without a word cost nothing. Ties in a leaf's order
    go by id and then by the whole row.
    """
    return mix(docs, share=MIX_SHARE, max_epochs=MIX_EPOCHS, carry=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens; null and empty texts are one token, repeated rows are packed each."""
    return pack(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: Classifier, near copies and packing have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; a stage's table goes as soon as the next one is written. An empty table gives an empty result."""
    docs, before = documents(spark, sf_dir), None
    for _, stage in STAGES[:-1]:
        docs = kept_as_table(stage(spark, docs, sf_dir))
        if before is not None:
            drop_table(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
