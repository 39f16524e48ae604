"""Corpus pipeline: documents through toxicity, exact and near duplicates, secrets and packing.

Each stage is one operator of carespark.llm over all rows that its predecessor kept. In every
stage a null text counts as empty and, where rows stay, stays null; a null doc_id is a document
like any other, the last in order; repeated rows are documents each until the duplicate stages
leave one; further columns, whatever their names, pass unread; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carespark.llm import exact_dedup, jaccard, packing, secrets, toxicity
from carespark.llm.catalog import TOKENIZER
from carespark.llm.common import read_table, write_stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or score is below 0.7, by a model learned from the labels of those given.
    A null or empty text is one empty sentence; repeated rows stay or go together; without labels of
    both kinds the model is constant: all documents stay, or go where every label is toxic."""
    return toxicity.drop_toxic(docs, toxicity.learn(docs, read_table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, null ones counting as empty: the smallest doc_id, a
    null one only where there is no other. Of repeated rows one stays."""
    return exact_dedup.exact_duplicates(docs, keep_rows=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at a Jaccard likeness of 0.8: the smallest doc_id.
    Null, empty and wordless texts are linked with nothing and stay."""
    return jaccard.one_of_each_group(docs, words=5, percent=80)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets and linked credential parts replaced by their kinds; texts without any,
    null ones included, as they are. n_chars follows the text."""
    return secrets.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in sequences of at most 2048: a row for each piece. A null or empty text
    is its end id alone; a null doc_id stays null; an empty table gives no pieces."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", hide_secrets),
    ("packing", pack),
]

# A learned model and a tokenizer: not expressible in SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each one's rows written and read again before the next, so that a
    lost executor costs a stage's tasks at most. Odd rows are treated as the stages say."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
